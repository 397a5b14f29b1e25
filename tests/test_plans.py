"""Physical-plan checks: the operators must keep the shapes that scale."""

import re

from conftest import SF_MID
from evenbasket.operators.equal_weight import equal_weight_index
from evenbasket.operators.metrics import day_slice
from evenbasket.operators.selection import select_members
from evenbasket.operators.upsert import upsert
from evenbasket.sources.bars import daily_bars, monthly_bars


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_uses_partial_window_group_limit(spark):
    p = plan(select_members(monthly_bars(spark, SF_MID), 20))
    assert p.count("WindowGroupLimit") >= 2  # partial before the shuffle, final after


def test_large_n_is_cut_in_slices_first(spark):
    from pyspark.sql import functions as F

    bars = spark.range(5000).select(
        F.expr("date_add(date'2025-01-02', CAST(id % 1 AS INT))").alias("date"), F.format_string("T%05d", "id").alias("ticker"), F.lit(1.0).alias("close"), (F.col("id") % 37).cast("double").alias("market_cap")
    )
    df = select_members(bars, 1001)
    assert "hashpartitioning(date" in plan(df) and plan(df).count("Exchange") == 2
    want = sorted(((-(i % 37), f"T{i:05d}") for i in range(5000)))[:1001]
    got = sorted((-r.market_cap, r.ticker) for r in df.collect())
    assert got == want and {r.n_members for r in df.collect()} == {1001}


def test_bar_aggregations_hash_and_combine_before_the_shuffle(spark):
    for bars, shuffles in ((daily_bars(spark, SF_MID), 1), (monthly_bars(spark, SF_MID), 2)):
        p = plan(bars)
        assert "SortAggregate" not in p
        assert p.count("HashAggregate") == 2 * shuffles and p.count("Exchange") == shuffles
        lines = [line for line in p.splitlines() if "HashAggregate" in line or "Exchange" in line]
        assert ["partial_" in line for line in lines if "HashAggregate" in line] == [False, True] * shuffles
        assert ["Exchange" in line for line in lines] == [False, True, False] * shuffles


def test_scan_is_pruned_and_filter_pushed(spark):
    df = day_slice(spark.read.parquet(f"{SF_MID}/events.parquet").selectExpr("CAST(ts AS DATE) AS date", "value"), "2024-01-15")
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in p
    assert "PushedFilters" in p


def test_only_date_grain_windows_are_unpartitioned(spark):
    ix = equal_weight_index(monthly_bars(spark, SF_MID), n=20)
    text = ix.rebalancing_log()._jdf.queryExecution().optimizedPlan().toString()
    seen = 0
    for line in text.splitlines():
        if "Window [" in line and "windowspecdefinition(" in line:
            spec = line.split("windowspecdefinition(", 1)[1]
            if re.match(r"date#\d+ ASC", spec):
                # unpartitioned windows run over one row per date only
                assert "prev_date" in line or "day_number" in line or "chain" in line or "next_date" in line
                seen += 1
    assert seen


def test_upsert_leaves_existing_rows_where_they_are(spark, tmp_path):
    daily_bars(spark, SF_MID).write.parquet(f"{tmp_path}/t")
    bars = spark.read.parquet(f"{tmp_path}/t")
    merged = upsert(bars, bars.limit(10))
    merged.collect()
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text
    anti = [line for line in text.split("Initial Plan")[0].splitlines() if "LeftAnti" in line]
    assert anti and all("BroadcastHashJoin" in line for line in anti)


def test_global_row_number_matches_a_sort(spark):
    from pyspark.sql import functions as F

    from evenbasket.operators.selection import global_row_number, rank_order

    df = spark.range(5000).select(
        F.format_string("T%05d", "id").alias("ticker"), (F.col("id") % 37).cast("double").alias("market_cap")
    ).repartition(7)
    got = {r.ticker: r.rank for r in global_row_number(df, rank_order()).collect()}
    pdf = df.toPandas().sort_values(["market_cap", "ticker"], ascending=[False, True]).reset_index(drop=True)
    assert got == {t: i + 1 for i, t in enumerate(pdf["ticker"])}


def test_revaluation_streams_bars_past_the_held_side(spark):
    ix = equal_weight_index(monthly_bars(spark, SF_MID), n=20)
    text = ix.reval._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in text and "Inner" in text  # inner join onto bars, outer join of small sides
