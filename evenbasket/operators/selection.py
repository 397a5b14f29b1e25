"""Member selection: top N tickers per date by market cap.

`row_number() <= n` over `partitionBy(date)` is planned as a WindowGroupLimit:
a partial top-N runs on each map task before the shuffle, so at most
n rows per date per task cross the network even when one date is huge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_priced
from ..session import reliable_checkpoint


#: Spark's own bound for a partial top-N (spark.sql.optimizer.windowGroupLimitThreshold), and slices of a date beyond it.
GROUP_LIMIT, SLICES = 1000, 64


def rank_order() -> list[Column]:
    """Total order: market cap descending (missing last), ticker ascending."""
    return [F.col("market_cap").desc_nulls_last(), F.col("ticker").asc()]


def eligible(bars: DataFrame) -> DataFrame:
    """Bars that can be held: known, positive close."""
    return bars.where(is_priced("close"))


def _first_rows(rows: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """The first ``n`` rows of each date, with their ``rank``.

    Beyond ``GROUP_LIMIT`` Spark plans no partial limit, so a date is first cut to its
    first ``n`` in slices of tickers, and one task sees ``SLICES * n`` rows at most.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if n > GROUP_LIMIT:
        slice_ = Window.partitionBy("date", F.pmod(F.xxhash64("ticker"), F.lit(SLICES))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(slice_)).where(F.col("rank") <= n).drop("rank")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("date").orderBy(*order))).where(F.col("rank") <= n)


def select_members(bars: DataFrame, n: int) -> DataFrame:
    """(date, ticker, price, market_cap, rank, n_members) for the top ``n`` per date.

    ``n_members`` is the actual count (fewer than ``n`` on thin days).
    """
    rows = eligible(bars).select("date", "ticker", F.col("close").alias("price"), "market_cap")
    return _first_rows(rows, n, rank_order()).select(
        "date",
        "ticker",
        "price",
        "market_cap",
        F.col("rank").cast("bigint").alias("rank"),
        F.count(F.lit(1)).over(Window.partitionBy("date")).alias("n_members"),
    )


def members_and_dates(bars: DataFrame, n: int) -> DataFrame:
    """(date, ticker, price, is_member): the top ``n`` per date, and on dates with fewer eligible names
    some that can't be held, so that every date of ``bars`` has a row: members and calendar in one pass."""
    rows = bars.select("date", "ticker", F.col("close").alias("price"), "market_cap", is_priced("close").alias("is_member"))
    return _first_rows(rows, n, [F.col("is_member").desc(), *rank_order()]).select("date", "ticker", "price", "is_member")


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """1-based position of every row under a total ``order``, computed without
    moving all rows into one task.

    A range-partitioned sort places rows in order across partitions;
    ``monotonically_increasing_id`` then carries (partition, position) of each
    row; one row per partition is counted and turned into offsets (a window
    over partitions only), which are broadcast back. The tagged rows are
    written once to a reliable checkpoint, so the counts and the rows come from
    the same physical layout (ids depend on it).
    """
    ordered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    tagged = reliable_checkpoint(
        ordered.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
            "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "ranked",
        large=True,
    )
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    return (
        tagged.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, (F.coalesce("_off", F.lit(0)) + F.col("_pos") + 1).cast("bigint"))
        .drop("_mid", "_part", "_pos", "_off")
    )


def ranked_on_date(bars: DataFrame, date: str) -> DataFrame:
    """All tickers of one date in rank order with their rank (a listing, not a selection)."""
    day = bars.where(F.col("date") == F.lit(date).cast("date")).select(
        "ticker", F.col("close").alias("price"), "market_cap"
    )
    return global_row_number(day, rank_order())


def top_n_on_date(bars: DataFrame, date: str, n: int) -> DataFrame:
    """Top ``n`` of a single date (sorted). Planned as TakeOrderedAndProject."""
    day = bars.where(F.col("date") == F.lit(date).cast("date")).where(is_priced("close"))
    return day.select("ticker", F.col("close").alias("price"), "market_cap").orderBy(*rank_order()).limit(n)
