"""As-of join and the carry policy against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import D, SF_SMALL, make_bars
from evenbasket.operators.asof import asof_join
from evenbasket.operators.equal_weight import equal_weight_index
from evenbasket.sources.bars import read_table, supplier_month_bars

LEFT, RIGHT = "id int, date date, ticker string, venue string", "date date, ticker string, venue string, close double"


def plain_asof(left, right, lookback):
    out = []
    for i, day, ticker, venue in left:
        known = [(d, v) for d, t, w, v in right if v is not None and None not in (day, d, ticker, venue) and (t, w) == (ticker, venue) and 0 <= (day - d).days <= lookback]
        d, v = max(known, default=(None, None))
        out.append((i, day, ticker, venue, v, d))
    return sorted(out, key=str)


@pytest.mark.parametrize("lookback", [0, 1, 6, 45])
def test_asof_matches_a_scan_of_all_rows(spark, lookback):
    rnd = random.Random(lookback)
    day = lambda: D(1969, 12, 1) + dt.timedelta(days=rnd.randrange(90))  # noqa: E731  (around the epoch: negative days too)
    left = [(k, day(), rnd.choice("AB"), rnd.choice("xy")) for k in range(150)] + [(900, None, "A", "x"), (901, day(), None, "x"), (901, day(), None, "x")]
    keys = {(day(), rnd.choice("ABC"), rnd.choice("xy")) for _ in range(60)}
    right = [(*k, rnd.choice([None, 0.0, 1.5, 2.5])) for k in sorted(keys)] + [(None, "A", "x", 9.0), (D(1970, 1, 1), None, "x", 9.0)]
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["ticker", "venue"], "close", lookback)
    assert got.columns == ["id", "date", "ticker", "venue", "close", "asof_date"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_asof(left, right, lookback)


def test_asof_of_empty_sides_and_clashes(spark):
    left, right = spark.createDataFrame([(1, D(2025, 1, 2), "A", "x")], LEFT), spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in asof_join(left, right, ["ticker"], "close", 5).collect()] == [(1, D(2025, 1, 2), "A", "x", None, None)]
    assert asof_join(left.limit(0), right, ["ticker"], "close", 5).collect() == []
    with pytest.raises(ValueError, match="venue"):
        asof_join(left, right, ["ticker"], "close", 5, out="venue")
    with pytest.raises(ValueError, match="negative"):
        asof_join(left, right, ["ticker"], "close", -1)


def test_a_window_holds_one_key_over_two_buckets(spark):
    """Bars that no row asks for are dropped before the sort, and no window is over a ticker's history."""
    bars = spark.range(20_000).select(F.expr("date_add(date'2000-01-01', CAST(id % 5000 AS INT))").alias("date"), F.format_string("T%d", F.floor(F.col("id") / 5000)).alias("ticker"), F.col("id").cast("double").alias("close"))
    asked = spark.createDataFrame([(D(2005, 1, 1), "T1")], "date date, ticker string")
    joined = asof_join(asked, bars, ["ticker"], "close", 9)
    assert joined.first().close == 5000 + (D(2005, 1, 1) - D(2000, 1, 1)).days
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text
    window = next(line for line in text.splitlines() if "Window [" in line)
    assert "[_k0#" in window and "_bucket#" in window


CARRY_ROWS = [
    (D(2025, 1, 2), "A", 10.0, 100),
    (D(2025, 1, 2), "B", 20.0, 40),
    (D(2025, 1, 3), "A", 11.0, 100),  # B is halted
    (D(2025, 1, 3), "C", 5.0, 500),
    (D(2025, 1, 6), "A", 11.0, 100),
    (D(2025, 1, 6), "C", 0.0, 100),  # a price, and worth nothing
]


@pytest.mark.parametrize("materialize", [False, "derived", True])
def test_a_halted_name_keeps_its_last_price(spark, materialize):
    ix = equal_weight_index(make_bars(spark, CARRY_ROWS), n=2, materialize=materialize, missing="carry")
    perf = {str(r.date): r.index_value for r in ix.performance().collect()}
    assert perf == {"2025-01-02": 1000.0, "2025-01-03": pytest.approx(1050.0), "2025-01-06": pytest.approx(525.0)}
    gone = [r for r in ix.rebalancing_log().collect() if r.action_type == "REMOVE" and str(r.date) == "2025-01-03"]
    assert [(r.ticker, r.price, r.notional_change) for r in gone] == [("B", 20.0, pytest.approx(-500_000.0))]
    assert {str(r.date): r.n_missing for r in ix.daily_value().collect()} == {"2025-01-03": 0, "2025-01-06": 0}


def test_a_price_that_is_too_old_is_lost(spark):
    ix = equal_weight_index(make_bars(spark, CARRY_ROWS), n=2, missing="carry", lookback=0)
    assert {str(r.date): r.index_value for r in ix.performance().collect()}["2025-01-03"] == pytest.approx(550.0)
    with pytest.raises(ValueError, match="missing"):
        equal_weight_index(make_bars(spark, CARRY_ROWS), n=2, missing="keep")


def test_a_seed_is_carried_without_a_bar(spark):
    held = spark.createDataFrame([(D(2025, 1, 2), "A", 10.0), (D(2025, 1, 2), "B", 20.0)], "date date, ticker string, price double")
    ix = equal_weight_index(make_bars(spark, CARRY_ROWS[2:4]), n=2, held=held, missing="carry")
    assert [r.index_value for r in ix.performance().orderBy("date").collect()] == [1000.0, pytest.approx(1050.0)]


def test_carry_matches_a_day_by_day_simulation(spark):
    bars = supplier_month_bars(read_table(spark, SF_SMALL, "lineitem"), key="l_partkey")
    rows = {}
    for r in bars.collect():
        rows.setdefault(r.date, {})[r.ticker] = (r.close, r.market_cap)
    last, shares, total, want = {}, {}, None, {}
    for day in sorted(rows):
        last |= {t: p for t, (p, _) in rows[day].items()}
        total = 1e6 if total is None else sum(n * last[t] for t, n in shares.items())
        top = sorted(rows[day], key=lambda t: (-rows[day][t][1], t))[:30]
        shares = {t: total / len(top) / last[t] for t in top}
        want[day] = total
    got = {r.date: r.total_notional for r in equal_weight_index(bars, n=30, missing="carry").performance().collect()}
    assert got == {d: pytest.approx(v, rel=1e-11) for d, v in want.items()}
