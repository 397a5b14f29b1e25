"""Wide lines in blocks: the wide form of any number of tickers."""

import pytest
from pyspark.sql import functions as F

from conftest import D, SF_SMALL
from evenbasket.operators.reshape import bars_to_wide, long_to_tidy, normalize_bars, wide_to_long
from evenbasket.plans import registry as R

ROWS = [
    (D(2025, 1, 2), "A", 1.0, 2.0, 0.5, 1.5, 10),
    (D(2025, 1, 2), "B|x", None, 4.0, float("nan"), 3.5, 3),
    (D(2025, 1, 3), 'C,"q', 0.1, 1e300, -0.0, 7.0, None),
    (None, "A", 9.0, 9.0, 9.0, 9.0, 1 << 40),
    (D(2025, 1, 6), "é D", 5.0, 6.0, 4.0, 5.5, 8),
]


def bars_of(spark, rows=ROWS):
    return spark.createDataFrame(rows, "date date, ticker string, open double, high double, low double, close double, volume long")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_blocks_hold_the_cells_of_one_wide_frame(spark, block):
    """lines of any width give the long rows of the frame with a column for each cell."""
    bars = bars_of(spark)
    lines = bars_to_wide(bars, block=block)
    assert lines.columns == ["Date", "Block", "Columns", "Cells"]
    headers = {}
    for r in lines.collect():
        assert len(r.Columns) == len(r.Cells)
        assert headers.setdefault(r.Block, r.Columns) == r.Columns
    assert sorted(c for h in headers.values() for c in h) == sorted(bars_to_wide(bars).columns[1:])
    got = rows(wide_to_long(lines))
    assert len(got) == 4 * 4 * 5  # dates (one unknown), tickers, fields
    assert got == rows(wide_to_long(bars_to_wide(bars)))


def test_wide_to_long_makes_no_column_for_each_ticker(spark, monkeypatch):
    """the query's plan is as wide for two tickers a block as for all."""
    assert len(R._wide(spark, SF_SMALL).columns) == 4
    want = rows(R.q_wide_to_long(spark, SF_SMALL))
    monkeypatch.setattr(R, "BLOCK_TICKERS", 2)
    assert R._wide(spark, SF_SMALL).select("Block").distinct().count() > 1
    assert rows(R.q_wide_to_long(spark, SF_SMALL)) == want


def test_lines_without_names_or_with_odd_names_are_refused(spark):
    schema = "Date string, Columns array<string>, Cells array<string>"
    short = spark.createDataFrame([("2025-01-02", ["Open|A", "Close|A"], ["x"])], schema)
    assert [tuple(r) for r in wide_to_long(short).collect()] == [("2025-01-02", "Open", "A", None), ("2025-01-02", "Close", "A", None)]
    for names in (["Open|A", "Total"], ["Open|A"]):
        with pytest.raises(Exception, match="isn't 'Field|Ticker'"):
            wide_to_long(spark.createDataFrame([("2025-01-02", names, ["1", "2"])], schema)).collect()
    with pytest.raises(ValueError, match="all tickers"):
        bars_to_wide(bars_of(spark), ["A"], block=2)


def test_long_to_tidy_of_blocks_has_a_row_for_each_date_and_ticker(spark, monkeypatch):
    """bars that a ticker lacks on a date are rows without values; a repeated bar counts once, two different ones are refused."""
    again = bars_of(spark).unionByName(bars_of(spark, ROWS[:1]))
    got = {(r.date, r.ticker): r for r in long_to_tidy(wide_to_long(bars_to_wide(again, block=2))).collect()}
    assert len(got) == 16
    assert tuple(got[D(2025, 1, 2), "A"])[2:] == (1.0, 2.0, 0.5, 1.5, 10, 15.0)
    assert tuple(got[D(2025, 1, 6), "A"])[2:] == (None,) * 6
    assert got[D(2025, 1, 2), "B|x"].low is None and got[None, "A"].volume == 1 << 40
    other = again.unionByName(bars_of(spark, [(D(2025, 1, 2), "A", 1.0, 2.0, 0.5, 1.25, 10)]))
    with pytest.raises(Exception, match="two different bars"):
        long_to_tidy(wide_to_long(bars_to_wide(other, block=2))).collect()
    want = rows(R.q_long_to_tidy(spark, SF_SMALL))
    monkeypatch.setattr(R, "BLOCK_TICKERS", 3)
    assert rows(R.q_long_to_tidy(spark, SF_SMALL)) == want


def test_normalize_bars_of_thousands_of_tickers_in_blocks(spark):
    """no frame or line is as wide as the tickers are many."""
    n = 6000
    bars = spark.range(n).select(F.date_add(F.lit(D(2025, 1, 2)), (F.col("id") % 3).cast("int")).alias("date"), F.format_string("T%05d", "id").alias("ticker"), *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")], F.lit(2).cast("long").alias("volume"))
    lines = bars_to_wide(bars, block=100)
    assert lines.agg(F.max(F.size("Columns"))).first()[0] < 5 * 200
    tidy = normalize_bars(lines)
    got = tidy.agg(F.count(F.lit(1)), F.count("close"), F.count_distinct("ticker"), F.sum("market_cap")).first()
    assert tuple(got) == (3 * n, n, n, float(n * (n - 1)))
    assert tidy.where("close IS NOT NULL").select("date", "ticker", "open", "high", "low", "close", "volume").exceptAll(bars).isEmpty()
