"""Independent SQL for every registered query (DuckDB dialect, ANSI where possible).

Written from the definitions in the registry docstrings, not generated from the
Spark plans. Views available: the raw test tables (lineitem, events, supplier, part, ...).
"""

from __future__ import annotations

from ..functions.columns import SIG_TIERS
from ..schemas import CARRY_DAYS
from . import registry as R

N = R.N_MEMBERS


def sig(x: str, ref: str | None = None, digits: int = 9) -> str:
    """SQL twin of ``round_sig``; '+ 0.0' folds a rounded -0.0 to 0.0."""
    r = f"abs({ref if ref is not None else x})"
    arms = " ".join(f"WHEN {r} >= {10.0**k!r} THEN round({x}, {digits - 1 - k})" for k in SIG_TIERS)
    return f"(CASE {arms} ELSE round({x}, {digits + 12}) END + 0.0)"


def rnd(x: str, d: int) -> str:
    return f"(round({x}, {d}) + 0.0)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def f1_bars(name: str = "bars", key: str = "l_suppkey", prefix: str = "S") -> str:
    return f"""{name} AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         printf('{prefix}%06d', {key}) AS ticker,
         arg_min(l_extendedprice / l_quantity,
                 (CAST(l_shipdate AS DATE), l_extendedprice / l_quantity)) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
           / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close,
         CAST(CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS BIGINT) AS volume,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS market_cap
  FROM lineitem
  GROUP BY 1, 2)"""


def f2_bars(name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT CAST(ts AS DATE) AS date,
         printf('U%06d', user_id) AS ticker,
         arg_min(value, event_id) AS open,
         max(value) AS high,
         min(value) AS low,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS close,
         count(*) AS volume,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS market_cap
  FROM events
  GROUP BY 1, 2)"""


def members(n: int = N, bars: str = "bars", name: str = "members") -> list[str]:
    return [
        f"""{name}_rk AS (
  SELECT date, ticker, close AS price, market_cap,
         row_number() OVER (PARTITION BY date ORDER BY market_cap DESC NULLS LAST, ticker ASC) AS rk
  FROM {bars} WHERE close IS NOT NULL AND close > 0)""",
        f"""{name} AS (
  SELECT date, ticker, price, market_cap, CAST(rk AS BIGINT) AS rank,
         count(*) OVER (PARTITION BY date) AS n_members
  FROM {name}_rk WHERE rk <= {n})""",
    ]


def calendar(bars: str = "bars", name: str = "cal") -> str:
    return f"""{name} AS (
  SELECT date,
         lag(date) OVER (ORDER BY date) AS prev_date,
         lead(date) OVER (ORDER BY date) AS next_date,
         CAST(row_number() OVER (ORDER BY date) AS BIGINT) AS day_number
  FROM (SELECT DISTINCT date FROM {bars}) d)"""


def index_ctes(n: int = N, bars: str = "bars", p: str = "", notional: int = 1000000, carry: int | None = None) -> list[str]:
    """members, cal, reval, growth, perf, cons, prevpos, log (names prefixed by ``p``). ``carry``: days to look back for a price."""
    m, c = f"{p}members", f"{p}cal"
    own = f"LEFT JOIN {bars} b ON b.date = k.next_date AND b.ticker = m.ticker"
    if carry is not None:
        own = f"ASOF LEFT JOIN (SELECT * FROM {bars} WHERE close IS NOT NULL) b ON b.ticker = m.ticker AND k.next_date >= b.date"
    fresh = "" if carry is None else f"CASE WHEN k.next_date - b.date <= {carry} THEN b.close END AS close"
    return members(n, bars, m) + [
        calendar(bars, c),
        f"""{p}reval AS (
  SELECT k.next_date AS date, m.ticker, m.date AS prev_date, m.price AS prev_price,
         m.n_members AS prev_n, m.close AS cur_price,
         coalesce(m.close / nullif(m.price, 0), CAST(0 AS DOUBLE)) AS ratio
  FROM (SELECT m.*, k.next_date, {fresh or "b.close"} FROM {m} m JOIN {c} k ON k.date = m.date {own} WHERE k.next_date IS NOT NULL) m
  JOIN {c} k ON k.date = m.date)""",
        f"""{p}growth AS (
  SELECT date, sum(ratio) / count(*) AS growth, count(*) AS n_held,
         count(*) FILTER (WHERE cur_price IS NULL) AS n_missing
  FROM {p}reval GROUP BY date)""",
        f"""{p}perf0 AS (
  SELECT k.date, k.prev_date,
         CASE WHEN k.prev_date IS NULL THEN CAST(1 AS DOUBLE)
              ELSE coalesce(g.growth, CAST(0 AS DOUBLE)) END AS growth
  FROM {c} k LEFT JOIN {p}growth g ON g.date = k.date)""",
        f"""{p}perf1 AS (
  SELECT *, product(growth) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chain
  FROM {p}perf0)""",
        f"""{p}perf AS (
  SELECT date, prev_date, growth,
         CAST(1000 AS DOUBLE) * chain AS index_value,
         CAST({notional} AS DOUBLE) * chain AS total_notional,
         CASE WHEN prev_date IS NULL THEN CAST(0 AS DOUBLE)
              WHEN lag(chain) OVER (ORDER BY date) = 0 THEN NULL
              ELSE growth - CAST(1 AS DOUBLE) END AS daily_return
  FROM {p}perf1)""",
        f"""{p}cons AS (
  SELECT m.date, m.ticker,
         CAST(1 AS DOUBLE) / m.n_members AS weight,
         (f.total_notional * (CAST(1 AS DOUBLE) / m.n_members)) / m.price AS shares_held,
         m.price,
         f.total_notional * (CAST(1 AS DOUBLE) / m.n_members) AS notional,
         f.prev_date
  FROM {m} m JOIN {p}perf f ON f.date = m.date)""",
        f"""{p}prevpos AS (
  SELECT r.date, r.ticker,
         (f.total_notional * (CAST(1 AS DOUBLE) / r.prev_n)) / r.prev_price AS prev_shares,
         r.cur_price
  FROM {p}reval r JOIN {p}perf f ON f.date = r.prev_date)""",
        f"""{p}log AS (
  SELECT coalesce(t.date, q.date) AS date,
         coalesce(t.ticker, q.ticker) AS ticker,
         CASE WHEN t.ticker IS NOT NULL AND q.ticker IS NOT NULL THEN 'REBALANCE'
              WHEN t.ticker IS NOT NULL THEN 'ADD' ELSE 'REMOVE' END AS action_type,
         CASE WHEN t.ticker IS NOT NULL AND q.ticker IS NOT NULL THEN t.shares_held - q.prev_shares
              WHEN t.ticker IS NOT NULL THEN t.shares_held ELSE -q.prev_shares END AS shares_change,
         CASE WHEN t.ticker IS NOT NULL AND q.ticker IS NOT NULL THEN (t.shares_held - q.prev_shares) * t.price
              WHEN t.ticker IS NOT NULL THEN t.notional ELSE -(q.prev_shares * q.cur_price) END AS notional_change,
         CASE WHEN t.ticker IS NOT NULL THEN t.price ELSE q.cur_price END AS price
  FROM (SELECT * FROM {p}cons WHERE prev_date IS NOT NULL) t
  FULL OUTER JOIN {p}prevpos q ON q.date = t.date AND q.ticker = t.ticker)""",
    ]


BARS_COLS = "date, ticker, open, high, low, close, volume, market_cap"
PERF_COLS = (
    f"date, {sig('index_value')} AS index_value, {sig('total_notional')} AS total_notional, "
    f"{rnd('daily_return', 10)} AS daily_return"
)
CONS_COLS = f"date, ticker, weight, {sig('shares_held')} AS shares_held, price, {sig('notional')} AS notional"
LOG_COLS = (
    f"date, ticker, action_type, {sig('shares_change', digits=8)} AS shares_change, "
    f"{sig('notional_change', digits=8)} AS notional_change, price"
)


def d(s: str) -> str:
    return f"DATE '{s}'"


def v1_changes(align: str, bars: str = "bars", days: int | None = None) -> list[str]:
    prev = "date - INTERVAL 1 DAY" if align == "calendar" else "lag(date) OVER (ORDER BY date)"
    processed = f"SELECT DISTINCT date FROM {bars}"
    if days is not None:
        processed = (
            f"SELECT DISTINCT date FROM {bars} WHERE date BETWEEN "
            f"(SELECT max(date) FROM {bars}) - INTERVAL {days} DAY AND (SELECT max(date) FROM {bars})"
        )
    return members(N, bars, "vm") + [
        f"processed AS ({processed})",
        f"vcal AS (SELECT date, CAST({prev} AS DATE) AS prev_date FROM (SELECT DISTINCT date FROM {bars}) x)",
        """today AS (SELECT date, ticker FROM vm WHERE date IN (SELECT date FROM processed))""",
        """prevset AS (
  SELECT k.date, m.ticker FROM vm m JOIN vcal k ON k.prev_date = m.date
  WHERE k.date IN (SELECT date FROM processed))""",
        """changes AS (
  SELECT coalesce(t.date, p.date) AS date, coalesce(t.ticker, p.ticker) AS ticker,
         CASE WHEN t.ticker IS NOT NULL THEN 'added' ELSE 'removed' END AS action
  FROM today t FULL OUTER JOIN prevset p ON p.date = t.date AND p.ticker = t.ticker
  WHERE t.ticker IS NULL OR p.ticker IS NULL)""",
    ]


def upsert_sql() -> str:
    batch = f"""batch AS (
  SELECT date, ticker, open, high, low, high AS close, volume, market_cap, 0 AS seq
  FROM bars WHERE date >= {d(R.UPSERT_FROM)}
  UNION ALL
  SELECT date, ticker, CAST(NULL AS DOUBLE), high, low, low, volume, market_cap, 1
  FROM bars WHERE date = {d(R.UPSERT_LAST)}
  UNION ALL
  SELECT CAST(date + INTERVAL 1 DAY AS DATE), ticker, open, high, low, close, volume, market_cap, 1
  FROM bars WHERE date = {d(R.UPSERT_LAST)})"""
    allrows = """allrows AS (
  SELECT *, 0 AS src, 0 AS seq2 FROM bars
  UNION ALL
  SELECT date, ticker, open, high, low, close, volume, market_cap, 1, seq FROM batch)"""
    ranked = """merged AS (
  SELECT *, row_number() OVER (PARTITION BY date, ticker
      ORDER BY src DESC, seq2 DESC, open DESC NULLS LAST, high DESC NULLS LAST, low DESC NULLS LAST,
               close DESC NULLS LAST, volume DESC NULLS LAST, market_cap DESC NULLS LAST) AS rn
  FROM allrows)"""
    return with_(f2_bars(), batch, allrows, ranked) + f"SELECT {BARS_COLS} FROM merged WHERE rn = 1"


def refresh_sql() -> str:
    ctes = [
        f1_bars("landed"),
        "universe AS (SELECT printf('S%06d', s_suppkey) AS ticker FROM supplier)",
        "good AS (SELECT printf('S%06d', s_suppkey) AS ticker FROM supplier WHERE s_acctbal > 0)",
        f"""existing AS (SELECT * FROM landed WHERE date < {d(R.REFRESH_STORED_BEFORE)}
  AND ticker IN (SELECT ticker FROM good))""",
        "unseen AS (SELECT ticker FROM universe EXCEPT SELECT ticker FROM existing)",
        f"""batch AS (
  SELECT *, 0 AS seq FROM landed
  WHERE date > CAST({d(R.REFRESH_AS_OF)} - INTERVAL 1 MONTH AS DATE) AND date <= {d(R.REFRESH_AS_OF)}
    AND ticker IN (SELECT ticker FROM unseen)
  UNION ALL
  SELECT *, 1 FROM landed WHERE date = {d(R.REFRESH_AS_OF)} AND ticker IN (SELECT ticker FROM universe))""",
        """merged AS (
  SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY src DESC, seq DESC) AS rn
  FROM (SELECT *, 0 AS src, 0 AS seq FROM existing
        UNION ALL
        SELECT date, ticker, open, high, low, close, volume, market_cap, 1 AS src, seq FROM batch) u)""",
    ]
    return with_(*ctes) + f"SELECT {BARS_COLS} FROM merged WHERE rn = 1"


def long_sql() -> list[str]:
    return [
        f1_bars(),
        """grid AS (
  SELECT d.date, t.ticker FROM (SELECT DISTINCT date FROM bars) d CROSS JOIN (SELECT DISTINCT ticker FROM bars) t)""",
        """cells AS (
  SELECT g.date, g.ticker, b.open, b.high, b.low, b.close, CAST(b.volume AS DOUBLE) AS volume
  FROM grid g LEFT JOIN bars b ON b.date = g.date AND b.ticker = g.ticker)""",
        """long AS (
  SELECT date, 'Open' AS price_field, ticker, open AS value FROM cells
  UNION ALL SELECT date, 'High', ticker, high FROM cells
  UNION ALL SELECT date, 'Low', ticker, low FROM cells
  UNION ALL SELECT date, 'Close', ticker, close FROM cells
  UNION ALL SELECT date, 'Volume', ticker, volume FROM cells)""",
    ]


TIDY_SQL = with_(*long_sql()) + f"""SELECT {BARS_COLS} FROM (
  SELECT date, ticker, open, high, low, close, CAST(round_even(volume, 0) AS BIGINT) AS volume,
         close * volume AS market_cap
  FROM cells) x"""


def oracle_sql() -> dict[str, str]:
    ix1 = with_(f1_bars(), *index_ctes())
    ix2 = with_(f2_bars(), *index_ctes())
    q: dict[str, str] = {}
    q["bars_monthly"] = with_(f1_bars()) + f"SELECT {BARS_COLS} FROM bars"
    q["bars_daily"] = with_(f2_bars()) + f"SELECT {BARS_COLS} FROM bars"
    q["trading_calendar"] = with_(f1_bars(), calendar()) + "SELECT * FROM cal"
    q["day_slice"] = with_(f2_bars()) + f"SELECT {BARS_COLS} FROM bars WHERE date = {d(R.SLICE_DATE)}"
    q["range_slice"] = (
        with_(f2_bars())
        + f"SELECT {BARS_COLS} FROM bars WHERE date BETWEEN {d(R.RANGE_START)} AND {d(R.RANGE_END)}"
    )
    q["trailing_30d_as_of"] = (
        ix2 + f"SELECT {PERF_COLS} FROM perf WHERE date BETWEEN {d(R.AS_OF)} - INTERVAL 30 DAY AND {d(R.AS_OF)}"
    )
    q["trailing_30d_max"] = (
        with_(f1_bars())
        + f"SELECT {BARS_COLS} FROM bars WHERE date BETWEEN (SELECT max(date) FROM bars) - INTERVAL 30 DAY"
        + " AND (SELECT max(date) FROM bars)"
    )
    q["top_n_single_date"] = (
        with_(f2_bars())
        + f"""SELECT ticker, close AS price, market_cap FROM bars
WHERE date = {d(R.SLICE_DATE)} AND close IS NOT NULL AND close > 0
ORDER BY market_cap DESC NULLS LAST, ticker LIMIT {N}"""
    )
    q["ranked_single_date"] = (
        with_(f2_bars())
        + f"""SELECT ticker, close AS price, market_cap,
  CAST(row_number() OVER (ORDER BY market_cap DESC NULLS LAST, ticker) AS BIGINT) AS rank
FROM bars WHERE date = {d(R.SLICE_DATE)}"""
    )
    q["top_n_per_date"] = with_(f1_bars(), *members()) + "SELECT * FROM members"
    q["universe_semi"] = (
        with_(f1_bars())
        + f"""SELECT {BARS_COLS} FROM bars WHERE ticker IN (
  SELECT printf('S%06d', s_suppkey) FROM supplier WHERE s_acctbal > 0)"""
    )
    q["unseen_tickers_anti"] = (
        with_(f1_bars("pbars", "l_partkey", "P"))
        + f"""SELECT printf('P%06d', p_partkey) AS ticker FROM part
EXCEPT SELECT ticker FROM pbars WHERE date < {d(R.STORED_BEFORE)}"""
    )
    q["distinct_tickers"] = with_(f1_bars()) + "SELECT DISTINCT ticker FROM bars"
    q["wide_to_long"] = (
        with_(*long_sql())
        + f"""SELECT date, price_field, ticker,
  value FROM long"""
    )
    q["long_to_tidy"] = TIDY_SQL
    q["normalize_bars"] = TIDY_SQL
    q["vendor_bundles"] = TIDY_SQL + " WHERE close IS NOT NULL"
    q["vendor_bundles_range"] = q["vendor_bundles"] + f" AND date BETWEEN {d(R.BUNDLE_RANGE[0])} AND {d(R.BUNDLE_RANGE[1])}"
    q["upsert_bars"] = upsert_sql()
    q["upsert_by_date"] = (
        with_(f2_bars(), *index_ctes(N, "bars", "a_"), *index_ctes(N // 2, "bars", "b_"))
        + f"""SELECT {PERF_COLS} FROM (
  SELECT date, index_value, total_notional, daily_return FROM a_perf
  WHERE date <= {d(R.BY_DATE_EXISTING_TO)} AND date < {d(R.BY_DATE_SPLIT)}
  UNION ALL
  SELECT date, index_value, total_notional, daily_return FROM b_perf WHERE date >= {d(R.BY_DATE_SPLIT)}) u"""
    )
    q["delete_by_key"] = (
        ix1
        + f"""SELECT {BARS_COLS} FROM bars b WHERE NOT EXISTS (
  SELECT 1 FROM log l WHERE l.action_type = 'REMOVE' AND l.date = b.date AND l.ticker = b.ticker)"""
    )
    q["refresh_bars"] = refresh_sql()
    q["duplicate_keys"] = """SELECT printf('S%06d', l_suppkey) AS ticker,
  CAST(l_shipdate AS DATE) AS date, count(*) AS duplicate_count
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
    q["quality_report"] = (
        with_(f2_bars())
        + """SELECT date, CAST(sum(rows) AS BIGINT) AS n_bars, count(*) AS n_tickers,
  count(*) FILTER (WHERE rows > 1) AS n_duplicate_keys,
  CAST(sum(null_close) AS BIGINT) AS n_null_close,
  CAST(sum(nonpositive_close) AS BIGINT) AS n_nonpositive_close,
  CAST(sum(null_market_cap) AS BIGINT) AS n_null_market_cap
FROM (
  SELECT date, ticker, count(*) AS rows,
    count(*) FILTER (WHERE close IS NULL) AS null_close,
    count(*) FILTER (WHERE close <= 0) AS nonpositive_close,
    count(*) FILTER (WHERE market_cap IS NULL) AS null_market_cap
  FROM bars GROUP BY date, ticker) k
GROUP BY date"""
    )
    q["quality_observed"] = (
        with_(f2_bars())
        + f""", batch AS (
  SELECT date, ticker, close, market_cap FROM bars
  UNION ALL
  SELECT date, ticker, CASE volume % 3 WHEN 0 THEN 0.0 WHEN 1 THEN CAST('NaN' AS DOUBLE) END, CASE WHEN volume % 2 = 0 THEN market_cap END
  FROM bars WHERE date >= {d(R.UPSERT_FROM)})
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
  count(*) FILTER (WHERE date IS NULL OR ticker IS NULL) AS n_null_keys, CAST(sum(n1) AS BIGINT) AS n_null_close, CAST(sum(n2) AS BIGINT) AS n_nan_close,
  CAST(sum(n3) AS BIGINT) AS n_nonpositive_close, CAST(sum(n4) AS BIGINT) AS n_null_market_cap
FROM (SELECT date, ticker, count(*) AS n, count(*) FILTER (WHERE close IS NULL) AS n1, count(*) FILTER (WHERE isnan(close)) AS n2,
  count(*) FILTER (WHERE NOT isnan(close) AND close <= 0) AS n3, count(*) FILTER (WHERE market_cap IS NULL) AS n4 FROM batch GROUP BY date, ticker) k"""
    )
    q["initial_constituents"] = ix1 + f"SELECT {CONS_COLS} FROM cons WHERE prev_date IS NULL"
    q["constituents"] = ix1 + f"SELECT {CONS_COLS} FROM cons"
    q["daily_value"] = (
        ix1
        + f"""SELECT date, prev_date, {sig('held_value')} AS held_value, n_held, n_missing FROM (
  SELECT r.date, r.prev_date,
    coalesce(sum(((f.total_notional * (CAST(1 AS DOUBLE) / r.prev_n)) / r.prev_price) * r.cur_price),
             CAST(0 AS DOUBLE)) AS held_value,
    count(*) AS n_held, count(*) FILTER (WHERE r.cur_price IS NULL) AS n_missing
  FROM reval r JOIN perf f ON f.date = r.prev_date
  GROUP BY r.date, r.prev_date) x"""
    )
    q["performance"] = ix1 + f"SELECT {PERF_COLS} FROM perf"
    q["performance_daily"] = ix2 + f"SELECT {PERF_COLS} FROM perf"
    q["performance_sparse"] = (
        with_(f1_bars("bars", "l_partkey", "P"), *index_ctes(R.SPARSE_MEMBERS)) + f"SELECT {PERF_COLS} FROM perf"
    )
    sparse = with_(f1_bars("bars", "l_partkey", "P"), *index_ctes(R.SPARSE_MEMBERS, carry=CARRY_DAYS))
    q["performance_carry"] = sparse + f"SELECT {PERF_COLS} FROM perf"
    q["rebalancing_log_carry"] = sparse + f"SELECT {LOG_COLS} FROM log"
    q["asof_marks"] = (
        with_(f1_bars(), *members())
        + f""", prices AS (
  SELECT CAST(l_shipdate AS DATE) AS date, printf('S%06d', l_suppkey) AS ticker,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS close
  FROM lineitem GROUP BY 1, 2),
held AS (SELECT CAST(date + INTERVAL 1 MONTH AS DATE) AS date, ticker FROM members)
SELECT h.date, h.ticker, CASE WHEN h.date - p.date <= {R.MARK_LOOKBACK} THEN p.close END AS mark_price,
  CASE WHEN h.date - p.date <= {R.MARK_LOOKBACK} THEN p.date END AS mark_date
FROM held h ASOF LEFT JOIN prices p ON p.ticker = h.ticker AND h.date >= p.date"""
    )
    q["rebalancing_log"] = ix1 + f"SELECT {LOG_COLS} FROM log"
    q["rebalancing_log_daily"] = ix2 + f"SELECT {LOG_COLS} FROM log"
    q["additions"] = ix1 + f"SELECT {LOG_COLS} FROM log WHERE action_type = 'ADD'"
    q["removals"] = ix1 + f"SELECT {LOG_COLS} FROM log WHERE action_type = 'REMOVE'"
    q["survivors"] = ix1 + f"SELECT {LOG_COLS} FROM log WHERE action_type = 'REBALANCE'"
    q["change_days"] = (
        ix1
        + """SELECT count(DISTINCT date) AS change_days,
  count(DISTINCT CASE WHEN action_type IN ('ADD', 'REMOVE') THEN date END) AS composition_change_days FROM log"""
    )
    q["change_dates"] = ix1 + "SELECT DISTINCT date FROM log"
    q["summary_metrics"] = (
        ix2
        + f"""SELECT {rnd('(end_value / start_value - 1) * 100', 8)} AS cumulative_return,
  {rnd('avg_return * 100', 8)} AS avg_daily_return, change_days, composition_change_days
FROM (
  SELECT arg_min(index_value, date) AS start_value, arg_max(index_value, date) AS end_value,
         avg(daily_return) AS avg_return
  FROM perf WHERE date BETWEEN (SELECT max(date) FROM perf) - INTERVAL 30 DAY AND (SELECT max(date) FROM perf)) r,
(SELECT count(DISTINCT date) AS change_days,
  count(DISTINCT CASE WHEN action_type IN ('ADD', 'REMOVE') THEN date END) AS composition_change_days FROM log) c"""
    )
    q["price_average_index"] = (
        with_(f1_bars(), *members()) + f"SELECT date, {sig('avg(price)')} AS index_value FROM members GROUP BY date"
    )
    q["price_average_index_30d"] = (
        with_(f2_bars(), *members())
        + f"""SELECT date, {sig('avg(price)')} AS index_value FROM members
WHERE date BETWEEN (SELECT max(date) FROM bars) - INTERVAL 30 DAY AND (SELECT max(date) FROM bars)
GROUP BY date"""
    )
    q["composition_changes_calendar"] = with_(f1_bars(), *v1_changes("calendar")) + "SELECT * FROM changes"
    q["composition_changes_trading"] = with_(f1_bars(), *v1_changes("trading")) + "SELECT * FROM changes"
    q["composition_changes_30d"] = with_(f1_bars(), *v1_changes("calendar", days=30)) + "SELECT * FROM changes"
    q["change_counts"] = (
        with_(f1_bars(), *v1_changes("trading")) + "SELECT date, action, count(*) AS n FROM changes GROUP BY date, action"
    )
    q["summary_metrics_simple"] = (
        with_(
            f1_bars(),
            *members(),
            *v1_changes("trading"),
            "v1 AS (SELECT date, avg(price) AS index_value FROM members GROUP BY date)",
            "pct AS (SELECT date, index_value, index_value / lag(index_value) OVER (ORDER BY date) - 1 AS pct_change FROM v1)",
        )
        + f"""SELECT {rnd('(last_value - first_value) / first_value', 10)} AS cumulative_return,
  {rnd('avg_daily_return', 10)} AS avg_daily_return, num_changes
FROM (SELECT arg_min(index_value, date) AS first_value, arg_max(index_value, date) AS last_value,
             avg(pct_change) AS avg_daily_return FROM pct) s,
     (SELECT count(*) AS num_changes FROM changes) c"""
    )
    q["composition_on_date"] = (
        ix1
        + f"""SELECT ticker, weight, {sig('notional')} AS notional,
  format('{{:.2f}}%', weight * 100) AS weight_text,
  CASE WHEN notional IS NULL OR notional = 0 THEN '-' ELSE '$' || format('{{:,.2f}}', notional) END AS notional_text
FROM cons WHERE date = {d(R.F1_VIEW_DATE)}"""
    )
    q["recent_changes"] = (
        ix1
        + f"""SELECT date, ticker, action_type, {sig('notional_change', digits=8)} AS notional_change,
  CASE WHEN notional_change IS NULL OR notional_change = 0 THEN '-'
       ELSE '$' || format('{{:,.2f}}', notional_change) END AS notional_text,
  CASE WHEN action_type = 'ADD' THEN 'color: green' WHEN action_type = 'REMOVE' THEN 'color: red' ELSE '' END
    AS display_class
FROM log"""
    )
    q["performance_series"] = (
        ix2
        + f"""SELECT p.date, {sig('p.index_value')} AS index_value, {rnd('p.daily_return', 10)} AS daily_return,
  p.date IN (SELECT date FROM log) AS is_change_day
FROM perf p
WHERE p.date BETWEEN (SELECT max(date) FROM perf) - INTERVAL 30 DAY AND (SELECT max(date) FROM perf)"""
    )
    q["date_bounds"] = ix2 + "SELECT min(date) AS min_date, max(date) AS max_date FROM perf"
    q["index_report"] = (
        ix1
        + f"""SELECT p.date AS "Date", {rnd('p.daily_return', 10)} AS "IndexReturn", l.lst AS "Top100Stocks"
FROM perf p LEFT JOIN (
  SELECT date, string_agg(ticker, ', ' ORDER BY rank) AS lst FROM members GROUP BY date) l ON l.date = p.date"""
    )
    q["report_stored"] = q["index_report"]
    q["report_text"] = (
        ix1
        + """, report AS (
  SELECT p.date, p.daily_return, l.lst
  FROM perf p LEFT JOIN (
    SELECT date, string_agg(ticker, ', ' ORDER BY rank) AS lst FROM members GROUP BY date) l ON l.date = p.date)
SELECT 'Date: ' || strftime(date, '%Y-%m-%d') AS line FROM report
UNION ALL SELECT 'Index Return: ' || format('{:,.10f}', daily_return) FROM report
UNION ALL SELECT 'Top 100 Stocks: ' || coalesce(lst, '') FROM report"""
    )
    q["log_preview"] = ix1 + f"SELECT {LOG_COLS} FROM (SELECT * FROM log ORDER BY date, ticker LIMIT 10) x"
    q["csv_roundtrip"] = q["performance"]
    q["json_landing"] = with_(f2_bars()) + "SELECT ticker, date, open, close, market_cap FROM bars"
    q["table_upsert"] = q["upsert_bars"]
    q["performance_extended"] = q["performance"]
    q["universe_file"] = """SELECT DISTINCT printf('S%06d', s_suppkey) AS "Symbol" FROM supplier"""
    q["guarded_dates"] = (
        with_(f1_bars("bars0", "l_partkey", "P"), "bars AS (SELECT date, ticker, CASE WHEN month(date) <> 6 THEN close END AS close, market_cap FROM bars0)", *members())
        + """SELECT d.date, count(m.ticker) AS n_members, count(m.ticker) > 0 AS has_members
FROM (SELECT DISTINCT date FROM bars) d LEFT JOIN members m ON m.date = d.date GROUP BY d.date"""
    )
    q["store_inventory"] = """SELECT name AS table_name, name <> 'rebalancing_log' AS is_there, CAST(n AS BIGINT) AS n_columns,
  name = 'stock_data' AND (SELECT count(*) FROM events) > 0 AS has_rows
FROM (VALUES ('stock_data', 8), ('constituents', 6), ('performance', 4), ('rebalancing_log', 0), ('index_composition_log', 3), ('index_performance', 2)) AS t(name, n)"""
    dates = "count(*) AS n_rows, count(DISTINCT date) AS n_dates, min(date) AS first_date, max(date) AS last_date"
    total = lambda x: f"{sig(x, digits=7)} AS total"
    q["stored_tables"] = with_(f1_bars(), *index_ctes(), *v1_changes("trading"), "v1 AS (SELECT date, avg(price) AS index_value FROM members GROUP BY date)") + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {dates}, {total(x)} FROM {src}"
        for name, src, x in (
            ("stock_data", "bars", "CAST(sum(volume) AS DOUBLE)"),
            ("constituents", "cons", "sum(weight)"),
            ("performance", "perf", "sum(daily_return)"),
            ("rebalancing_log", "log", "sum(price)"),
            ("index_composition_log", "changes", "sum(CASE action WHEN 'added' THEN CAST(1 AS DOUBLE) ELSE -1 END)"),
            ("index_performance", "v1", "sum(index_value)"),
        )
    )
    q["payload_quarantine"] = (
        with_(f2_bars())
        + """SELECT ticker, date, open, close, market_cap, NULL::VARCHAR AS reason FROM bars WHERE volume % 6 < 3
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CASE WHEN volume % 6 = 3 THEN 'not JSON' WHEN volume % 6 = 5 THEN 'no records'
  WHEN volume % 12 = 4 THEN 'no ticker' ELSE 'no date' END FROM bars WHERE volume % 6 >= 3"""
    )
    window = f"date BETWEEN {d(R.SQL_AS_OF)} - INTERVAL {R.SQL_DAYS} DAY AND {d(R.SQL_AS_OF)}"
    q["sql_index_metrics"] = (
        ix1
        + f"""SELECT {rnd('(arg_max(index_value, date) / arg_min(index_value, date) - 1) * 100', 8)} AS cumulative_return,
  {rnd('avg(daily_return) * 100', 8)} AS avg_daily_return, (SELECT count(DISTINCT date) FROM log) AS change_days,
  (SELECT count(DISTINCT date) FROM log WHERE action_type IN ('ADD', 'REMOVE')) AS composition_change_days
FROM perf WHERE {window}"""
    )
    q["sql_performance_window"] = (
        ix1
        + f"""SELECT date, {sig('index_value')} AS index_value, {rnd('daily_return', 10)} AS daily_return,
  date IN (SELECT date FROM log) AS is_change_day FROM perf WHERE {window}"""
    )
    q["sql_composition_on"] = ix1 + f"SELECT ticker, weight, price, {sig('notional')} AS notional FROM cons WHERE date = DATE '1998-03-01'"
    q["sql_changes_between"] = ix1 + f"SELECT {LOG_COLS} FROM log WHERE date BETWEEN DATE '1997-11-01' AND DATE '1998-02-01'"
    touched = "date IN (" + ", ".join(map(d, R.LEGACY_TOUCHED)) + ")"
    changed = f"""bars AS (
  SELECT date, ticker, open, high, low, CASE WHEN {touched} THEN low ELSE close END AS close, volume,
    CASE WHEN {touched} THEN CAST(1e9 AS DOUBLE) / market_cap ELSE market_cap END AS market_cap FROM bars0)"""
    q["legacy_refreshed_log"] = with_(f1_bars("bars0"), changed, *v1_changes("trading")) + "SELECT * FROM changes"
    q["legacy_refreshed_index"] = with_(f1_bars("bars0"), changed, *members()) + f"SELECT date, {sig('avg(price)')} AS index_value FROM members GROUP BY date"
    later = f"date >= {d(R.EXTEND_FROM)}"
    q["run_manifest"] = ix1 + "UNION ALL ".join(
        f"""SELECT CAST({k} AS BIGINT) AS seq, '{kind}' AS kind, CAST({N} AS BIGINT) AS n, min(date) AS first_date, max(date) AS last_date, count(*) AS n_constituents,
  (SELECT count(*) FROM log WHERE {part}) AS n_log, (SELECT count(*) FROM perf WHERE {upto}) AS n_performance
FROM cons WHERE {part}
"""
        for k, kind, part, upto in ((1, "build", f"NOT {later}", f"NOT {later}"), (2, "extend", later, "true"))
    )
    corrected = f"""bars AS (
  SELECT date, ticker, open, high, low, CASE WHEN {later} THEN high ELSE close END AS close, volume, market_cap FROM bars0)"""
    q["performance_recomputed"] = with_(f1_bars("bars0"), corrected, *index_ctes()) + f"SELECT {PERF_COLS} FROM perf"
    # The reference values what it holds: a name back-filled later has no bars before it was landed.
    landed = f"""bars AS (
  SELECT * FROM bars0 WHERE date >= {d(R.EXTEND_FROM)}
     OR ticker <> (SELECT ticker FROM bars0 GROUP BY ticker ORDER BY sum(market_cap) DESC, ticker LIMIT 1))"""
    workflow = with_(f1_bars("bars0"), landed, *index_ctes(notional=int(R.WORKFLOW_NOTIONAL)))
    q["daily_workflow_extended"] = workflow + f"SELECT {PERF_COLS} FROM perf"
    q["daily_workflow_log"] = workflow + f"SELECT {LOG_COLS} FROM log"
    q["daily_workflow_constituents"] = workflow + f"SELECT {CONS_COLS} FROM cons"
    q["stream_upsert"] = q["upsert_bars"]
    closed = f"date < (SELECT max(date) FROM bars) - INTERVAL {R.EVENT_TIME_DELAY} DAY"
    q["stream_event_time"] = (
        with_(f2_bars())
        + f"""SELECT date, ticker, open, high, low, CASE WHEN {closed} THEN close ELSE low END AS close, volume, market_cap, NULL::VARCHAR AS reason FROM bars
UNION ALL SELECT date, ticker, open, high, low, low, volume, market_cap, 'late' FROM bars WHERE {closed}"""
    )
    q["ddl_lifecycle"] = (
        with_(f1_bars(), *index_ctes(), *v1_changes("trading"))
        + """SELECT 'constituents' AS table_name, count(*) AS row_count FROM cons
UNION ALL SELECT 'index_composition_log', count(*) FROM changes
UNION ALL SELECT 'performance', count(*) FROM perf
UNION ALL SELECT 'rebalancing_log', count(*) FROM log
UNION ALL SELECT 'stock_data', count(*) FROM bars"""
    )
    return q
