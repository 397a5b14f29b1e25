"""Edge cases: zero/NULL prices, empty and thin days, ties, one date, empty windows."""

import pytest

from conftest import D, make_bars
from evenbasket.operators import metrics as M
from evenbasket.operators.equal_weight import equal_weight_index
from evenbasket.operators.selection import select_members


def perf(spark, rows, n=2):
    ix = equal_weight_index(make_bars(spark, rows), n=n)
    return [tuple(r) for r in ix.performance().orderBy("date").collect()], ix


def test_zero_and_null_price_never_selected(spark):
    rows = [
        (D(2025, 1, 1), "A", 0.0, 10**9),
        (D(2025, 1, 1), "B", None, 10**9),
        (D(2025, 1, 1), "C", 10.0, 1),
        (D(2025, 1, 1), "D", 5.0, 1),
    ]
    got = select_members(make_bars(spark, rows), 2).orderBy("rank").collect()
    assert [r.ticker for r in got] == ["C", "D"]
    assert all(r.n_members == 2 for r in got)


def test_held_name_priced_zero_loses_its_slice(spark):
    rows = [
        (D(2025, 1, 1), "A", 10.0, 100),
        (D(2025, 1, 1), "B", 10.0, 90),
        (D(2025, 1, 2), "A", 10.0, 100),
        (D(2025, 1, 2), "B", 0.0, 90),
    ]
    got, ix = perf(spark, rows)
    assert got[1][1] == pytest.approx(500.0)
    removed = ix.rebalancing_log().where("action_type = 'REMOVE'").collect()
    assert len(removed) == 1 and removed[0].price == 0.0 and removed[0].notional_change == 0.0


def test_all_prices_missing_kills_index(spark):
    rows = [
        (D(2025, 1, 1), "A", 10.0, 100),
        (D(2025, 1, 2), "Z", 10.0, 100),
        (D(2025, 1, 3), "Z", 11.0, 100),
    ]
    got, _ = perf(spark, rows, n=1)
    assert got[1][1:] == (0.0, 0.0, -1.0)
    assert got[2][1] == 0.0 and got[2][3] is None  # 0/0 return is undefined


def test_fewer_than_n_names(spark):
    rows = [(D(2025, 1, 1), "A", 10.0, 100), (D(2025, 1, 1), "B", 20.0, 100)]
    ix = equal_weight_index(make_bars(spark, rows), n=5)
    cons = ix.constituents().collect()
    assert len(cons) == 2 and all(r.weight == 0.5 for r in cons)


def test_ties_broken_by_ticker(spark):
    rows = [
        (D(2025, 1, 1), "B", 10.0, 10),
        (D(2025, 1, 1), "A", 10.0, 10),
        (D(2025, 1, 1), "C", 10.0, 10),
    ]
    got = select_members(make_bars(spark, rows), 2).orderBy("rank").collect()
    assert [r.ticker for r in got] == ["A", "B"]


def test_one_date_only(spark):
    got, ix = perf(spark, [(D(2025, 1, 1), "A", 10.0, 1)])
    assert got == [(D(2025, 1, 1), 1000.0, 1e6, 0.0)]
    assert ix.rebalancing_log().count() == 0


def test_empty_window_gives_null_returns(spark, f3_bars):
    ix = equal_weight_index(f3_bars, n=2)
    m = M.summary_metrics(ix.performance(), ix.rebalancing_log(), 30, "2030-01-01").first()
    assert m.cumulative_return is None and m.avg_daily_return is None
    assert m.change_days == 3


def test_scaling_one_ticker_leaves_index_unchanged(spark):
    rows = [
        (D(2025, 1, 1), "A", 10.0, 1000),
        (D(2025, 1, 1), "B", 20.0, 10),
        (D(2025, 1, 2), "A", 11.0, 1000),
        (D(2025, 1, 2), "B", 18.0, 10),
        (D(2025, 1, 3), "A", 12.0, 1000),
        (D(2025, 1, 3), "B", 19.0, 10),
    ]
    scaled = [(d, t, p * 7 if t == "B" else p, v) for d, t, p, v in rows]
    a, _ = perf(spark, rows)
    b, _ = perf(spark, scaled)
    for x, y in zip(a, b):
        assert x[1] == pytest.approx(y[1], rel=1e-12)


def test_wall_clock_window_is_empty_on_old_data(spark, f3_bars):
    ix = equal_weight_index(f3_bars, n=2)
    assert M.trailing_window(ix.performance(), 30, None).count() == 0  # as of today (2025 data is old)
    assert M.trailing_window(ix.performance(), 4, "2025-01-07").count() == 3  # 01-03 .. 01-07 inclusive


def test_hot_date_holding_most_rows(spark):
    """One date carries ~97% of all bars; results still match the loop, and the
    top-N keeps its partial limit before the shuffle."""
    from test_invariants import simulate

    from pyspark.sql import functions as F

    hot = spark.range(3000).select(
        F.lit(D(2025, 1, 3)).alias("date"),
        F.format_string("T%04d", "id").alias("ticker"),
        (F.col("id") % 97 + 1).cast("double").alias("close"),
        (F.col("id") % 13 + 1).alias("volume"),
    )
    thin = spark.createDataFrame(
        [(d, f"T{t:04d}", float(p), 5) for d in (D(2025, 1, 2), D(2025, 1, 6)) for t, p in ((1, 3), (2, 4), (3, 5), (50, 6))],
        "date date, ticker string, close double, volume long",
    )
    rows = [tuple(r) for r in hot.unionByName(thin).collect()]
    bars = make_bars(spark, rows).repartition(16)
    ix = equal_weight_index(bars, n=3)
    sim = simulate(bars.toPandas(), 3)
    got = {r.date: r for r in ix.performance().collect()}
    for d, (iv, tot, ret) in sim.items():
        assert got[d].total_notional == pytest.approx(tot, rel=1e-12)
    plan = ix.members._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
