"""As-of join: the last known value at or before a date, no older than a bound.

Spark has no such join; an inequality join would pair every row with its whole
history. Here both sides become one union, sorted by date within a key, and the
last known value is carried forward. The bound cuts time into buckets longer
than it, so a row finds its value in its own bucket or the one before: right
rows go to their bucket and the next one, and a task's group is one key over two
buckets, never a key's history. Right rows whose (key, bucket) no left row asks
for are dropped before the shuffle that sorts (a semi join; AQE broadcasts the
asking side when it measures small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    value: str,
    lookback: int,
    on: str = "date",
    out: str | None = None,
    out_on: str = "asof_date",
) -> DataFrame:
    """``left`` rows with ``out`` (default: ``value``) and ``out_on``, from the row of ``right`` with the same ``by``
    and the greatest ``on`` in [left.on - lookback days, left.on] whose ``value`` is known; NULL without one.

    ``right`` has one row per (by, on); of several, the greatest value counts. A
    left row with a NULL key or date gets NULLs. Left rows may repeat.
    """
    if lookback < 0:
        raise ValueError("lookback must not be negative")
    out = out or value
    clash = {out, out_on} & set(left.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    day = F.datediff(F.col(on), F.lit("1970-01-01").cast("date"))
    bucket = F.floor(day / F.lit(lookback + 1))
    keys = [f"_k{k}" for k in range(len(by))]
    own_keys = [F.col(c).alias(k) for c, k in zip(by, keys, strict=True)]
    asked = left.select(*own_keys, bucket.alias("_bucket"), day.alias("_day"), F.struct(*left.columns).alias("_row"))
    known = right.where(F.col(value).isNotNull()).select(*own_keys, F.explode(F.array(bucket, bucket + 1)).alias("_bucket"), day.alias("_day"), F.struct(F.col(on).alias("on"), F.col(value).alias("value")).alias("_found"))
    known = known.join(asked.select(*keys, "_bucket").distinct(), [*keys, "_bucket"], "left_semi")
    both = known.unionByName(asked, allowMissingColumns=True)
    # A right row of the same date comes first; equal dates rise by value.
    before = Window.partitionBy(*keys, "_bucket").orderBy("_day", F.col("_row").isNotNull(), F.col("_found").getField("value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = both.withColumn("_last", F.last("_found", ignorenulls=True).over(before)).where(F.col("_row").isNotNull())
    fresh = F.datediff(F.col(f"_row.{on}"), F.col("_last.on")) <= lookback
    # Rows with a NULL key share a group of their own, in which nothing is known.
    return swept.select("_row.*", F.when(fresh, F.col("_last.value")).alias(out), F.when(fresh, F.col("_last.on")).alias(out_on))
