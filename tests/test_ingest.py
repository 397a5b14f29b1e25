"""Normalisation, upsert, delete, refresh and quality checks."""

import pytest
from pyspark.sql import functions as F

from conftest import D, SF_SMALL
from evenbasket.operators.quality import duplicate_keys, quality_report
from evenbasket.operators.reshape import bars_to_wide, long_to_tidy, normalize_bars, wide_to_long
from evenbasket.operators.upsert import delete_by_key, refresh, unseen_tickers, upsert
from evenbasket.sources.bars import monthly_bars, supplier_universe, read_table

COLS = ["date", "ticker", "open", "high", "low", "close", "volume"]


def test_wide_round_trip(spark):
    bars = monthly_bars(spark, SF_SMALL)
    back = normalize_bars(bars_to_wide(bars)).where(F.col("close").isNotNull())
    assert sorted(map(tuple, back.select(COLS).collect())) == sorted(map(tuple, bars.select(COLS).collect()))
    mc = back.join(bars.select("date", "ticker", F.col("market_cap").alias("mc0")), ["date", "ticker"])
    for r in mc.collect():
        assert r.market_cap == pytest.approx(r.mc0, rel=1e-9)


def test_vendor_frame_details(spark):
    wide = spark.createDataFrame(
        [("2025-01-02 00:00:00", "10.5", "11", "10", "10.75", "2.5", "10.7", "x")],
        ["Datetime", "Open|AAA", "High|AAA", "Low|AAA", "Close|AAA", "Volume|AAA", "Adj Close|AAA", "Close|BBB"],
    )
    long = wide_to_long(wide)
    assert long.count() == 7
    assert long.where("Ticker = 'BBB'").first().Value is None  # non-numeric -> NULL
    tidy = {r.ticker: r for r in long_to_tidy(long).collect()}
    a = tidy["AAA"]
    assert (a.date, a.open, a.high, a.low, a.close) == (D(2025, 1, 2), 10.5, 11.0, 10.0, 10.75)
    assert a.volume == 2  # half-even
    assert a.market_cap == pytest.approx(10.75 * 2.5)
    assert "adj close" not in [c.lower() for c in long_to_tidy(long).columns]


def _bars(spark, rows):
    return spark.createDataFrame(rows, "date date, ticker string, close double, volume long")


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    old = _bars(spark, [(D(2025, 1, 1), "A", 1.0, 10), (D(2025, 1, 1), "B", 2.0, 20)])
    batch = _bars(spark, [(D(2025, 1, 1), "A", None, 11), (D(2025, 1, 2), "A", 3.0, 30)])
    once = upsert(old, batch)
    twice = upsert(once, batch)
    want = [(D(2025, 1, 1), "A", None, 11), (D(2025, 1, 1), "B", 2.0, 20), (D(2025, 1, 2), "A", 3.0, 30)]
    assert sorted(map(tuple, once.collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(want, key=str)


def test_upsert_batch_duplicates_are_deterministic(spark):
    old = _bars(spark, [(D(2025, 1, 1), "A", 1.0, 10)])
    batch = spark.createDataFrame(
        [(D(2025, 1, 1), "A", 5.0, 1, 0), (D(2025, 1, 1), "A", 4.0, 1, 1), (D(2025, 1, 1), "A", 9.0, 1, 1)],
        "date date, ticker string, close double, volume long, seq int",
    )
    got = upsert(old, batch, order="seq").collect()
    assert [tuple(r) for r in got] == [(D(2025, 1, 1), "A", 9.0, 1)]


def test_delete_by_key(spark):
    df = _bars(spark, [(D(2025, 1, 1), "A", 1.0, 1), (D(2025, 1, 1), "B", 1.0, 1), (D(2025, 1, 2), "A", 1.0, 1)])
    doomed = spark.createDataFrame([(D(2025, 1, 1), "A")], "date date, ticker string")
    assert sorted(r.ticker + str(r.date) for r in delete_by_key(df, doomed).collect()) == [
        "A2025-01-02",
        "B2025-01-01",
    ]


def test_refresh_backfills_only_unseen(spark):
    landed = monthly_bars(spark, SF_SMALL)
    universe = supplier_universe(read_table(spark, SF_SMALL, "supplier"))
    existing = landed.where("date < '2001-06-01' AND ticker <> 'S000001'")
    out = refresh(existing, landed, universe, "2001-11-01")
    assert unseen_tickers(universe, out.where("date < '2001-06-01'")).count() == 1
    new_rows = out.join(existing, ["date", "ticker"], "left_anti")
    dates = {(r.ticker, r.date) for r in new_rows.collect()}
    # monthly bars: the one-month back-fill window (10-01, 11-01] holds only 11-01
    assert {d for _, d in dates} == {D(2001, 11, 1)}
    assert {t for t, _ in dates} == {r.ticker for r in landed.where("date = '2001-11-01'").collect()}
    assert unseen_tickers(universe, out).count() == 0


def test_quality(spark):
    rows = [
        (D(2025, 1, 1), "A", 1.0, 1),
        (D(2025, 1, 1), "A", 2.0, 1),
        (D(2025, 1, 1), "B", None, 1),
        (D(2025, 1, 1), "C", 0.0, 1),
    ]
    df = _bars(spark, rows).withColumn("market_cap", F.col("close") * F.col("volume"))
    dups = duplicate_keys(df).collect()
    assert [(r.ticker, r.duplicate_count) for r in dups] == [("A", 2)]
    q = quality_report(df).first()
    assert (q.n_bars, q.n_tickers, q.n_duplicate_keys, q.n_null_close, q.n_nonpositive_close) == (4, 3, 1, 1, 1)
