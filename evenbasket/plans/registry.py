"""Registered queries: one per operator, each (spark, sf_dir) -> DataFrame.

Fixtures (see FIXTURES.md): F1 = supplier-month bars from ``lineitem``,
F2 = user-day bars from ``events``, both with N = 20 members. Accumulated
doubles are rounded to ~9 significant digits (``round_sig``) so the result can
be compared with an independent SQL engine; exact single-division prices are
left untouched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import round_sig, ticker_code
from ..operators import metrics as M
from ..operators import price_average as V1
from ..operators.asof import asof_join
from ..operators.calendar import trading_calendar
from ..operators.equal_weight import equal_weight_index
from ..operators.quality import duplicate_keys, quality_report
from ..operators.report import export_report_text, index_report
from ..operators.reshape import BLOCK_TICKERS, bars_to_wide, long_to_tidy, normalize_bars, wide_to_long
from ..operators.selection import ranked_on_date, select_members, top_n_on_date
from ..operators.upsert import delete_by_key, refresh, unseen_tickers, upsert
from ..schemas import ACTION_ADD, ACTION_REBALANCE, ACTION_REMOVE, CARRY, PERFORMANCE, RUN_TABLES, TABLES
from ..session import reliable_checkpoint, scratch_path
from ..sources.bars import read_table, supplier_day_prices, supplier_month_bars, supplier_universe, user_day_bars
from ..sources.bundles import read_bundles, write_bundles
from ..sources.landing import land_payloads, read_json_days, read_universe, write_json_days
from ..sources.tables import TableStore, export_csv, read_csv_export
from ..streaming.ingest import ingest_available, ingest_event_time, read_refused
from .build import build_index_tables, build_legacy_tables, extend_index_tables, recompute_index_tables, refresh_legacy_tables, stored_report
from .sql import register_functions

# Fixed query parameters.
N_MEMBERS = 20
SLICE_DATE = "2024-01-15"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
AS_OF = "2024-01-20"
F1_VIEW_DATE = "2001-06-01"
STORED_BEFORE = "1996-01-01"
REFRESH_STORED_BEFORE = "2001-06-01"
REFRESH_AS_OF = "2001-11-01"
UPSERT_FROM = "2024-01-25"
UPSERT_LAST = "2024-01-30"
BY_DATE_SPLIT = "2024-01-15"
EVENT_TIME_CUT, EVENT_TIME_AGAIN, EVENT_TIME_DELAY = "2024-01-15", 3, 10
BUNDLES = 5
BUNDLE_RANGE = ("1996-03-01", "1997-09-01")
BY_DATE_EXISTING_TO = "2024-01-20"

Query = Callable[[SparkSession, str], DataFrame]


def f1(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_month_bars(read_table(spark, sf, "lineitem"))


def f2(spark: SparkSession, sf: str) -> DataFrame:
    return user_day_bars(read_table(spark, sf, "events"))


def f1_index(spark: SparkSession, sf: str, n: int = N_MEMBERS):
    return equal_weight_index(f1(spark, sf), n=n, materialize=True)


def f2_index(spark: SparkSession, sf: str, n: int = N_MEMBERS):
    return equal_weight_index(f2(spark, sf), n=n, materialize=True)


def kept_bars(bars: DataFrame) -> DataFrame:
    """Bars written once, for queries that read them several times besides the index."""
    return reliable_checkpoint(bars, "bars", large=True)


# -- output shaping ----------------------------------------------------------

def bars_out(df: DataFrame) -> DataFrame:
    return df.select("date", "ticker", "open", "high", "low", "close", "volume", "market_cap")


def perf_out(df: DataFrame) -> DataFrame:
    return df.select(
        "date",
        round_sig("index_value").alias("index_value"),
        round_sig("total_notional").alias("total_notional"),
        F.round("daily_return", 10).alias("daily_return"),
    )


def cons_out(df: DataFrame) -> DataFrame:
    return df.select(
        "date",
        "ticker",
        "weight",
        round_sig("shares_held").alias("shares_held"),
        "price",
        round_sig("notional").alias("notional"),
    )


def log_out(df: DataFrame) -> DataFrame:
    return df.select(
        "date",
        "ticker",
        "action_type",
        round_sig("shares_change", digits=8).alias("shares_change"),
        round_sig("notional_change", digits=8).alias("notional_change"),
        "price",
    )


# -- sources, calendar, slices -----------------------------------------------

def q_bars_monthly(spark, sf):
    return bars_out(f1(spark, sf))


def q_bars_daily(spark, sf):
    return bars_out(f2(spark, sf))


def q_trading_calendar(spark, sf):
    return trading_calendar(f1(spark, sf))


def q_day_slice(spark, sf):
    return bars_out(M.day_slice(f2(spark, sf), SLICE_DATE))


def q_range_slice(spark, sf):
    return bars_out(M.range_slice(f2(spark, sf), RANGE_START, RANGE_END))


def q_trailing_30d_as_of(spark, sf):
    return perf_out(M.trailing_window(f2_index(spark, sf).performance(), 30, AS_OF))


def q_trailing_30d_max(spark, sf):
    return bars_out(M.trailing_window(f1(spark, sf), 30, "max"))


# -- selection -----------------------------------------------------------------

def q_top_n_single_date(spark, sf):
    return top_n_on_date(f2(spark, sf), SLICE_DATE, N_MEMBERS)


def q_ranked_single_date(spark, sf):
    return ranked_on_date(f2(spark, sf), SLICE_DATE)


def q_top_n_per_date(spark, sf):
    return select_members(f1(spark, sf), N_MEMBERS)


def q_universe_file(spark, sf):
    """The universe list as a landed CSV with other columns, blanks and repeated symbols, read back."""
    path = _scratch(spark, "universe")
    symbols = supplier_universe(read_table(spark, sf, "supplier"))
    lines = symbols.select(F.concat(F.lit(" "), "Symbol").alias("Symbol"), F.length("Symbol").alias("Weight"))
    lines.unionByName(lines).unionByName(lines.limit(1).withColumn("Symbol", F.lit(None).cast("string"))).write.option("header", True).csv(path)
    return read_universe(spark, path)


def q_guarded_dates(spark, sf):
    """Dates on which anything can be held: a date with bars but no priced name selects nothing, and is no error."""
    bars = _part_bars(spark, sf)
    empty = F.month("date") == 6
    members = select_members(bars.withColumn("close", F.when(~empty, F.col("close"))), N_MEMBERS)
    held = members.groupBy("date").agg(F.count(F.lit(1)).alias("n_members"))
    return trading_calendar(bars).join(held, "date", "left").select("date", F.coalesce("n_members", F.lit(0)).alias("n_members"), F.col("n_members").isNotNull().alias("has_members"))


def q_store_inventory(spark, sf):
    """What a store has after bars were landed and one table dropped: whether each table exists, its columns, and whether it has rows."""
    store = _store(spark)
    store.overwrite("stock_data", f2(spark, sf))
    store.drop("rebalancing_log")
    rows = [(name, store.exists(name), len(spark.table(f"`{store.namespace}`.`{name}`").columns) if store.exists(name) else 0, store.exists(name) and not store.read(name).isEmpty()) for name in TABLES]
    return spark.createDataFrame(rows, "table_name string, is_there boolean, n_columns long, has_rows boolean")  # a row per table


def q_stored_tables(spark, sf):
    """Key figures of every table that the jobs write, read back: rows, dates, and a sum of its numbers."""
    store = _store(spark)
    store.overwrite("stock_data", f1(spark, sf))
    build_index_tables(store, n=N_MEMBERS)
    build_legacy_tables(store, n=N_MEMBERS, days=None, align="trading")
    figures = {"stock_data": F.sum("volume").cast("double"), "constituents": F.sum("weight"), "performance": F.sum("daily_return"), "rebalancing_log": F.sum("price"), "index_composition_log": F.sum(F.when(F.col("action") == "added", 1.0).otherwise(-1.0)), "index_performance": F.sum("index_value")}
    made = [store.read(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("date").alias("n_dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), round_sig(total, digits=7).alias("total")) for name, total in figures.items()]
    return reduce(DataFrame.unionByName, made)


# -- ticker sets ---------------------------------------------------------------

def q_universe_semi(spark, sf):
    universe = supplier_universe(read_table(spark, sf, "supplier").where(F.col("s_acctbal") > 0))
    return bars_out(f1(spark, sf).join(universe.select(F.col("Symbol").alias("ticker")), "ticker", "left_semi"))


def _part_bars(spark, sf):
    return supplier_month_bars(read_table(spark, sf, "lineitem"), key="l_partkey", prefix="P")


def q_unseen_tickers_anti(spark, sf):
    universe = read_table(spark, sf, "part").select(ticker_code("P", "p_partkey").alias("Symbol"))
    stored = _part_bars(spark, sf).where(F.col("date") < F.lit(STORED_BEFORE).cast("date"))
    return unseen_tickers(universe, stored)


def q_distinct_tickers(spark, sf):
    return f1(spark, sf).select("ticker").distinct()


# -- reshape -------------------------------------------------------------------

def _wide(spark, sf):
    return bars_to_wide(kept_bars(f1(spark, sf)), block=BLOCK_TICKERS)


def q_wide_to_long(spark, sf):
    long = wide_to_long(_wide(spark, sf))
    return long.select(
        F.col("Date").alias("date"),
        F.col("Price").alias("price_field"),
        F.col("Ticker").alias("ticker"),
        F.col("Value").alias("value"),
    )


def q_long_to_tidy(spark, sf):
    return bars_out(long_to_tidy(wide_to_long(_wide(spark, sf))))


def q_normalize_bars(spark, sf):
    return bars_out(normalize_bars(_wide(spark, sf)))


def _bundles(spark, sf):
    """Landed bundles of F1 bars: a folder of wide files for each group of suppliers, with tickers of its own."""
    root, bars = _scratch(spark, "bundles"), kept_bars(f1(spark, sf))
    for k in range(BUNDLES):
        part = bars.where(F.pmod(F.substring("ticker", -1, 1).cast("int"), F.lit(BUNDLES)) == k)
        write_bundles(bars_to_wide(part, block=BLOCK_TICKERS), f"{root}/bundle={k}")
    return root


def q_vendor_bundles(spark, sf):
    """All bars of bundles with tickers of their own, by each file's header; cells that a wide file lacks are no bars."""
    return bars_out(read_bundles(spark, _bundles(spark, sf)).where("close IS NOT NULL"))


def q_vendor_bundles_range(spark, sf):
    """The bundles' bars of a date range: lines of other dates are left in the files."""
    return bars_out(read_bundles(spark, _bundles(spark, sf), *BUNDLE_RANGE).where("close IS NOT NULL"))


# -- upsert family ---------------------------------------------------------------

def upsert_batch(bars: DataFrame) -> DataFrame:
    """Two landings: late bars re-priced at the day's high (seq 0), then the last
    day re-landed with close = low and open unknown (seq 1, NULL overwrite, in-batch
    duplicates of seq 0), plus that day copied forward one day (new keys)."""
    late = bars.where(F.col("date") >= F.lit(UPSERT_FROM).cast("date"))
    first = late.withColumn("close", F.col("high")).withColumn("_seq", F.lit(0))
    last_day = bars.where(F.col("date") == F.lit(UPSERT_LAST).cast("date"))
    second = (
        last_day.withColumn("close", F.col("low"))
        .withColumn("open", F.lit(None).cast("double"))
        .withColumn("_seq", F.lit(1))
    )
    new_day = last_day.withColumn("date", F.date_add("date", 1)).withColumn("_seq", F.lit(1))
    return first.unionByName(second).unionByName(new_day)


def q_upsert_bars(spark, sf):
    bars = f2(spark, sf)
    return bars_out(upsert(bars, upsert_batch(bars), order="_seq"))


def quality_batch(bars: DataFrame) -> DataFrame:
    """The bars, and those from UPSERT_FROM on once more with unknown, zero or no-number closes and unknown market caps."""
    close = F.when(F.col("volume") % 3 == 0, F.lit(0.0)).when(F.col("volume") % 3 == 1, F.lit(float("nan")))
    again = bars.where(F.col("date") >= F.lit(UPSERT_FROM).cast("date"))
    return bars.unionByName(again.withColumn("close", close).withColumn("market_cap", F.when(F.col("volume") % 2 == 0, F.col("market_cap"))))


def q_quality_observed(spark, sf):
    """What a keyed upsert measured of its batch while it was written: no job of its own."""
    store = _store(spark)
    store.upsert("stock_data", quality_batch(f2(spark, sf)), keys=["date", "ticker"])
    names = ["n_rows", "n_keys", "n_duplicate_keys", "n_null_keys", "n_null_close", "n_nan_close", "n_nonpositive_close", "n_null_market_cap"]
    seen = store.observed["stock_data"]
    return spark.createDataFrame([tuple(seen[k] for k in names)], ", ".join(f"{k} long" for k in names))  # one row of counts


def q_upsert_by_date(spark, sf):
    bars = kept_bars(f2(spark, sf))
    existing = equal_weight_index(bars, n=N_MEMBERS, materialize="derived").performance().where(
        F.col("date") <= F.lit(BY_DATE_EXISTING_TO).cast("date")
    )
    batch = equal_weight_index(bars, n=N_MEMBERS // 2, materialize="derived").performance().where(
        F.col("date") >= F.lit(BY_DATE_SPLIT).cast("date")
    )
    return perf_out(upsert(existing, batch, keys=["date"]))


def q_delete_by_key(spark, sf):
    bars = kept_bars(f1(spark, sf))
    removed = equal_weight_index(bars, n=N_MEMBERS, materialize="derived").rebalancing_log().where(F.col("action_type") == ACTION_REMOVE)
    return bars_out(delete_by_key(bars, removed))


def q_refresh_bars(spark, sf):
    landed = f1(spark, sf)
    universe = supplier_universe(read_table(spark, sf, "supplier"))
    good = supplier_universe(read_table(spark, sf, "supplier").where(F.col("s_acctbal") > 0))
    existing = landed.where(F.col("date") < F.lit(REFRESH_STORED_BEFORE).cast("date")).join(
        good.select(F.col("Symbol").alias("ticker")), "ticker", "left_semi"
    )
    return bars_out(refresh(existing, landed, universe, REFRESH_AS_OF))


# -- quality -------------------------------------------------------------------

def q_duplicate_keys(spark, sf):
    raw = read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date"), "l_suppkey")
    dups = duplicate_keys(raw, keys=("l_suppkey", "date"))
    return dups.select(ticker_code("S", "l_suppkey").alias("ticker"), "date", "duplicate_count")


def q_quality_report(spark, sf):
    return quality_report(f2(spark, sf))


# -- equal-weight index ------------------------------------------------------------

def q_initial_constituents(spark, sf):
    return cons_out(f1_index(spark, sf).initial_constituents())


def q_constituents(spark, sf):
    return cons_out(f1_index(spark, sf).constituents())


def q_daily_value(spark, sf):
    dv = f1_index(spark, sf).daily_value()
    return dv.select("date", "prev_date", round_sig("held_value").alias("held_value"), "n_held", "n_missing")


def q_performance(spark, sf):
    return perf_out(f1_index(spark, sf).performance())


SPARSE_MEMBERS = 100


def q_performance_sparse(spark, sf):
    """Stress case: part-month bars, 100 members; most held names have no price
    the next month, so the index decays toward zero (compare daily_return)."""
    ix = equal_weight_index(_part_bars(spark, sf), n=SPARSE_MEMBERS, materialize=True)
    return perf_out(ix.performance())


def q_performance_carry(spark, sf):
    """The stress case under the carry policy: unpriced names keep their last known price."""
    ix = equal_weight_index(_part_bars(spark, sf), n=SPARSE_MEMBERS, materialize=True, missing=CARRY)
    return perf_out(ix.performance())


def q_rebalancing_log_carry(spark, sf):
    """Names that leave without a price are sold at the last known one."""
    return log_out(equal_weight_index(_part_bars(spark, sf), n=SPARSE_MEMBERS, materialize=True, missing=CARRY).rebalancing_log())


MARK_LOOKBACK = 2


def q_asof_marks(spark, sf):
    """Each month's members at the last daily price on or before the next month's first day, at most MARK_LOOKBACK days old."""
    bars = f1(spark, sf)
    held = select_members(bars, N_MEMBERS).select(F.add_months("date", 1).alias("date"), "ticker")
    prices = supplier_day_prices(read_table(spark, sf, "lineitem"))
    return asof_join(held, prices, ["ticker"], "close", MARK_LOOKBACK, out="mark_price", out_on="mark_date")


def q_performance_daily(spark, sf):
    return perf_out(f2_index(spark, sf).performance())


def q_rebalancing_log(spark, sf):
    return log_out(f1_index(spark, sf).rebalancing_log())


def q_rebalancing_log_daily(spark, sf):
    return log_out(f2_index(spark, sf).rebalancing_log())


def _log_action(spark, sf, action):
    return log_out(f1_index(spark, sf).rebalancing_log().where(F.col("action_type") == action))


def q_additions(spark, sf):
    return _log_action(spark, sf, ACTION_ADD)


def q_removals(spark, sf):
    return _log_action(spark, sf, ACTION_REMOVE)


def q_survivors(spark, sf):
    return _log_action(spark, sf, ACTION_REBALANCE)


def q_change_days(spark, sf):
    return M.change_days(f1_index(spark, sf).rebalancing_log())


def q_change_dates(spark, sf):
    return M.change_dates(f1_index(spark, sf).rebalancing_log())


def q_summary_metrics(spark, sf):
    ix = f2_index(spark, sf)
    out = M.summary_metrics(ix.performance(), ix.rebalancing_log(), 30, "max")
    return out.select(
        F.round("cumulative_return", 8).alias("cumulative_return"),
        F.round("avg_daily_return", 8).alias("avg_daily_return"),
        "change_days",
        "composition_change_days",
    )


# -- legacy index --------------------------------------------------------------------

def q_price_average_index(spark, sf):
    out = V1.price_average_index(f1(spark, sf), N_MEMBERS)
    return out.select("date", round_sig("index_value").alias("index_value"))


def q_price_average_index_30d(spark, sf):
    out = V1.price_average_index(f2(spark, sf), N_MEMBERS, days=30)
    return out.select("date", round_sig("index_value").alias("index_value"))


def q_composition_changes_calendar(spark, sf):
    return V1.composition_changes(f1(spark, sf), N_MEMBERS, align="calendar")


def q_composition_changes_trading(spark, sf):
    return V1.composition_changes(f1(spark, sf), N_MEMBERS, align="trading")


def q_composition_changes_30d(spark, sf):
    """The legacy tracker as it ran: trailing 30 days before the last date, calendar alignment."""
    return V1.composition_changes(f1(spark, sf), N_MEMBERS, align="calendar", days=30)


def q_change_counts(spark, sf):
    return V1.change_counts(V1.composition_changes(f1(spark, sf), N_MEMBERS, align="trading"))


def q_summary_metrics_simple(spark, sf):
    v1 = V1.PriceAverageIndex(f1(spark, sf), N_MEMBERS, align="trading")
    out = V1.simple_metrics(v1.performance(), v1.changes())
    return out.select(
        F.round("cumulative_return", 10).alias("cumulative_return"),
        F.round("avg_daily_return", 10).alias("avg_daily_return"),
        "num_changes",
    )


# -- dashboard and report ---------------------------------------------------------------

def q_composition_on_date(spark, sf):
    out = M.composition_on_date(f1_index(spark, sf).constituents(), F1_VIEW_DATE)
    return out.select("ticker", "weight", round_sig("notional").alias("notional"), "weight_text", "notional_text")


def q_recent_changes(spark, sf):
    out = M.recent_changes(f1_index(spark, sf).rebalancing_log())
    return out.select(
        "date",
        "ticker",
        "action_type",
        round_sig("notional_change", digits=8).alias("notional_change"),
        "notional_text",
        "display_class",
    )


def q_performance_series(spark, sf):
    ix = f2_index(spark, sf)
    out = M.performance_series(ix.performance(), ix.rebalancing_log(), 30, "max")
    return out.select(
        "date",
        round_sig("index_value").alias("index_value"),
        F.round("daily_return", 10).alias("daily_return"),
        "is_change_day",
    )


def q_date_bounds(spark, sf):
    return M.date_bounds(f2_index(spark, sf).performance())


def q_index_report(spark, sf):
    ix = f1_index(spark, sf)
    out = index_report(ix.performance(), ix.members)
    return out.select("Date", F.round("IndexReturn", 10).alias("IndexReturn"), "Top100Stocks")


def q_report_text(spark, sf):
    """The report rendered as text lines, written and read back."""
    ix = f1_index(spark, sf)
    path = _scratch(spark, "report")
    export_report_text(index_report(ix.performance(), ix.members), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_report_stored(spark, sf):
    """The report of the stored tables, after the index was continued."""
    out = stored_report(_extended_store(spark, sf))
    return out.select("Date", F.round("IndexReturn", 10).alias("IndexReturn"), "Top100Stocks")


def q_log_preview(spark, sf):
    return log_out(M.log_preview(f1_index(spark, sf).rebalancing_log(), 10))


# -- sources and sinks on files (scratch folders under the checkpoint dir) ---------

def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def q_csv_roundtrip(spark, sf):
    path = _scratch(spark, "csv")
    export_csv(f1_index(spark, sf).performance(), path, order=["date"])
    return perf_out(read_csv_export(spark, path, PERFORMANCE))


def q_json_landing(spark, sf):
    path = _scratch(spark, "json")
    write_json_days(f2(spark, sf), path)
    return read_json_days(spark, path)


def payload_lines(bars: DataFrame) -> DataFrame:
    """Each bar as a vendor response of one of six shapes by its volume: three good ones, a broken line, a record that can't be used, and no record."""
    day = F.date_format("date", "yyyy-MM-dd").alias("date")
    record = F.struct("ticker", day, "open", "close", "market_cap")
    numbered = F.struct(F.col("open").cast("string").alias("1. open"), F.col("close").cast("string").alias("4. close"), F.col("market_cap").alias("Market_Cap"))
    bad = F.struct(F.when(F.col("volume") % 12 != 4, F.col("ticker")).alias("ticker"), F.lit("2024-13-01").alias("date"), "open", "close")
    whole = F.to_json(F.struct(F.array(record).alias("results")))
    line = (
        F.when(F.col("volume") % 6 == 0, whole)
        .when(F.col("volume") % 6 == 1, F.to_json(F.struct(record.alias("results"))))
        .when(F.col("volume") % 6 == 2, F.to_json(F.struct("ticker", F.create_map(F.date_format("date", "yyyy-MM-dd"), numbered).alias("series"))))
        .when(F.col("volume") % 6 == 3, F.substring(whole, 1, 40))
        .when(F.col("volume") % 6 == 4, F.to_json(F.struct(F.array(bad).alias("results"))))
        .otherwise(F.lit('{"results": []}'))
    )
    return bars.select(line.alias("value"))


def q_payload_quarantine(spark, sf):
    """Landed responses of all shapes: every line is a bar or a refused row with its reason."""
    path = _scratch(spark, "payloads")
    payload_lines(f2(spark, sf)).write.text(path)
    bars, refused = land_payloads(spark, path)
    names = ["ticker", "date", "open", "close", "market_cap"]
    lost = [F.lit(None).cast(t).alias(c) for c, t in zip(names, ("string", "date", "double", "double", "double"), strict=True)]
    return bars.select(*names, F.lit(None).cast("string").alias("reason")).unionByName(refused.select(*lost, "reason"))


SQL_AS_OF, SQL_DAYS = "1998-06-15", 120


def _sql_store(spark, sf):
    store = _extended_store(spark, sf)
    register_functions(store)
    return store


def q_sql_index_metrics(spark, sf):
    _sql_store(spark, sf)
    out = spark.sql(f"SELECT * FROM index_metrics(DATE'{SQL_AS_OF}', {SQL_DAYS})")
    return out.select(F.round("cumulative_return", 8).alias("cumulative_return"), F.round("avg_daily_return", 8).alias("avg_daily_return"), "change_days", "composition_change_days")


def q_sql_performance_window(spark, sf):
    _sql_store(spark, sf)
    out = spark.sql(f"SELECT * FROM performance_window(DATE'{SQL_AS_OF}', {SQL_DAYS})")
    return out.select("date", round_sig("index_value").alias("index_value"), F.round("daily_return", 10).alias("daily_return"), "is_change_day")


def q_sql_composition_on(spark, sf):
    _sql_store(spark, sf)
    out = spark.sql("SELECT * FROM composition_on(DATE'1998-03-01')")
    return out.select("ticker", "weight", "price", round_sig("notional").alias("notional"))


def q_sql_changes_between(spark, sf):
    _sql_store(spark, sf)
    return log_out(spark.sql("SELECT * FROM changes_between(DATE'1997-11-01', DATE'1998-02-01')"))


LEGACY_TOUCHED = ["1996-03-01", "1998-12-01"]


def _legacy_refreshed(spark, sf):
    """The v1 tables, brought up to date after the bars of two dates changed."""
    store = _store(spark)
    store.overwrite("stock_data", f1(spark, sf))
    build_legacy_tables(store, n=N_MEMBERS, days=None, align="trading")
    touched = F.col("date").isin([F.lit(d).cast("date") for d in LEGACY_TOUCHED])
    changed = store.read("stock_data").where(touched).withColumns({"market_cap": 1e9 / F.col("market_cap"), "close": F.col("low")})
    store.upsert("stock_data", changed, keys=["date", "ticker"])
    refresh_legacy_tables(store, store.observed["stock_data"]["dates"], n=N_MEMBERS, days=None, align="trading")
    return store


def q_legacy_refreshed_log(spark, sf):
    return _legacy_refreshed(spark, sf).read("index_composition_log")


def q_legacy_refreshed_index(spark, sf):
    return _legacy_refreshed(spark, sf).read("index_performance").select("date", round_sig("index_value").alias("index_value"))


def _store(spark):
    store = TableStore(spark, _scratch(spark, "store"), f"eb_{uuid.uuid4().hex[:12]}")
    store.create_all()
    return store


def q_ddl_lifecycle(spark, sf):
    store = _store(spark)
    bars = f1(spark, sf)
    store.overwrite("stock_data", bars)
    build_index_tables(store, n=N_MEMBERS)
    build_legacy_tables(store, n=N_MEMBERS, days=None, align="trading")
    store.drop("index_performance")
    names = [t.name for t in spark.catalog.listTables(store.namespace)]
    counts = [store.read(t).select(F.lit(t).alias("table_name")) for t in sorted(names)]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out.groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


EXTEND_FROM = "1998-01-01"


def _extended_store(spark, sf):
    """Index built on the bars before EXTEND_FROM, then continued after the later bars land."""
    store = _store(spark)
    bars = f1(spark, sf)
    cut = F.lit(EXTEND_FROM).cast("date")
    store.overwrite("stock_data", bars.where(F.col("date") < cut))
    build_index_tables(store, n=N_MEMBERS)
    store.upsert("stock_data", bars.where(F.col("date") >= cut), keys=["date", "ticker"])
    extend_index_tables(store, n=N_MEMBERS)
    return store


def q_performance_extended(spark, sf):
    """Must equal the full-history performance."""
    return perf_out(_extended_store(spark, sf).read("performance"))


def q_run_manifest(spark, sf):
    """The runs that make up a store's state after building and continuing: dates and row counts by run."""
    store = _store(spark)
    bars = f1(spark, sf)
    cut = F.lit(EXTEND_FROM).cast("date")
    store.overwrite("stock_data", bars.where(F.col("date") < cut))
    build_index_tables(store, n=N_MEMBERS)
    store.upsert("stock_data", bars.where(F.col("date") >= cut), keys=["date", "ticker"])
    states = [store.pinned().manifest]
    extend_index_tables(store)
    states.append(store.pinned().manifest)
    rows = [(m["seq"], m["kind"], m["parameters"]["n"], min(d), max(d), *(m["rows"][t] for t in RUN_TABLES)) for m in states if (d := m["dates"][m["run"]]["constituents"])]
    made = spark.createDataFrame(rows, "seq long, kind string, n long, first_date string, last_date string, n_constituents long, n_log long, n_performance long")
    return made.withColumns({c: F.to_date(c) for c in ("first_date", "last_date")})


def q_performance_recomputed(spark, sf):
    """Closes from EXTEND_FROM on are corrected after the index was built; it is computed anew from that date."""
    store = _store(spark)
    bars = f1(spark, sf)
    store.overwrite("stock_data", bars)
    build_index_tables(store, n=N_MEMBERS)
    fixed = bars.where(F.col("date") >= F.lit(EXTEND_FROM).cast("date")).withColumn("close", F.col("high"))
    store.upsert("stock_data", fixed, keys=["date", "ticker"])
    recompute_index_tables(store, EXTEND_FROM)
    return perf_out(store.read("performance"))


WORKFLOW_NOTIONAL = 5_000_000.0


def _daily_workflow(spark, sf):
    """Index built without the ticker of the greatest dollar volume; then a refresh
    back-fills it on the indexed dates and lands later bars; then the index goes on.

    What was held stays held: the new name enters on the first later date. The
    notional is not the default and is taken from what is stored.
    """
    store = _store(spark)
    bars = f1(spark, sf)
    cut = F.lit(EXTEND_FROM).cast("date")
    top = bars.groupBy("ticker").agg(F.sum("market_cap").alias("cap")).orderBy(F.desc("cap"), "ticker").limit(1).collect()[0].ticker
    early = bars.where(F.col("date") < cut)
    store.overwrite("stock_data", early.where(F.col("ticker") != top))
    build_index_tables(store, n=N_MEMBERS, notional=WORKFLOW_NOTIONAL)
    batch = early.where(F.col("ticker") == top).unionByName(bars.where(F.col("date") >= cut))
    store.upsert("stock_data", batch, keys=["date", "ticker"])
    extend_index_tables(store, n=N_MEMBERS)
    return store


def q_daily_workflow_extended(spark, sf):
    return perf_out(_daily_workflow(spark, sf).read("performance"))


def q_daily_workflow_log(spark, sf):
    return log_out(_daily_workflow(spark, sf).read("rebalancing_log"))


def q_daily_workflow_constituents(spark, sf):
    return cons_out(_daily_workflow(spark, sf).read("constituents"))


def q_table_upsert(spark, sf):
    store = _store(spark)
    bars = f2(spark, sf)
    store.overwrite("stock_data", bars)
    store.upsert("stock_data", upsert_batch(bars), keys=["date", "ticker"], order="_seq")
    return bars_out(store.read("stock_data"))


def q_stream_upsert(spark, sf):
    store = _store(spark)
    landing = _scratch(spark, "landing")
    bars = f2(spark, sf)
    bars.withColumn("seq", F.lit(-1).cast("bigint")).write.parquet(f"{landing}/drop=1")
    upsert_batch(bars).withColumnRenamed("_seq", "seq").withColumn("seq", F.col("seq").cast("bigint")).write.parquet(
        f"{landing}/drop=2"
    )
    ingest_available(spark, f"{landing}/*", store, _scratch(spark, "stream-ckpt"), max_files=None)
    return bars_out(store.read("stock_data"))


def q_stream_event_time(spark, sf):
    """Three landings under a watermark: bars up to a date, then the rest with the first ones' last days again, then all
    bars re-priced at the day's low: dates since the watermark are corrected, corrections of older ones are refused."""
    store, landing = _store(spark), _scratch(spark, "landing")
    ckpt, refused = _scratch(spark, "stream-ckpt"), _scratch(spark, "refused")
    bars = f2(spark, sf).withColumn("seq", F.lit(0).cast("bigint"))
    cut = F.lit(EVENT_TIME_CUT).cast("date")
    drops = [
        bars.where(F.col("date") <= cut),
        bars.where(F.col("date") > F.date_sub(cut, EVENT_TIME_AGAIN)),
        bars.withColumn("close", F.col("low")).withColumn("seq", F.lit(1).cast("bigint")),
    ]
    for k, drop in enumerate(drops):
        drop.write.parquet(f"{landing}/drop={k}")
        ingest_event_time(spark, f"{landing}/*", store, ckpt, refused, delay=f"{EVENT_TIME_DELAY} days")
    stored = bars_out(store.read("stock_data")).withColumn("reason", F.lit(None).cast("string"))
    late = read_refused(spark, refused)
    return stored.unionByName(late.select(*stored.columns))


def queries() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_") and callable(fn)}
