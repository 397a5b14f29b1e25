"""Legacy ("v1") index: plain average close of the day's top N, plus a
composition log of names added / removed against the previous day's top N.

The previous day is either the previous trading date or the previous calendar
day; under calendar alignment every date after a gap (a Monday) finds an empty
previous set, so all its members log as added and none as removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import DEFAULT_MEMBERS, TRAILING_DAYS, V1_ADDED, V1_REMOVED
from ..session import reliable_checkpoint
from .calendar import aligned_calendar, date_grain
from .selection import members_and_dates


def trailing_dates(dates: DataFrame, days: int | None) -> DataFrame:
    """Distinct dates within ``days`` of the last date (both ends inclusive)."""
    dates = dates.select("date").distinct()
    if days is None:
        return dates
    last = dates.select(F.max("date")).scalar()  # scalar subquery, evaluated once
    return dates.where(F.col("date").between(F.date_sub(last, days), last))


class PriceAverageIndex:
    """The legacy index and its composition log over ``bars``.

    ``days=30`` restricts both to the trailing month before the last date, as the
    legacy tracker did; ``None`` covers every date. Members, calendar and trailing
    dates all come from one frame of dates x ``n`` rows, which is checkpointed
    (unless ``materialize`` is False), so bars are read once.
    """

    def __init__(self, bars: DataFrame, n: int = DEFAULT_MEMBERS, align: str = "calendar", days: int | None = None, materialize: bool = True):
        self.align, self.days = align, days
        self.rows = members_and_dates(bars, n)
        if materialize:
            self.rows = reliable_checkpoint(self.rows)
        self.members = self.rows.where("is_member").drop("is_member")
        self.processed = trailing_dates(self.rows, days)

    def performance(self) -> DataFrame:
        """(date, index_value): mean close of the top ``n`` on each date."""
        out = self.members.groupBy("date").agg(F.avg("price").alias("index_value"))
        return out if self.days is None else out.join(date_grain(self.processed), "date", "left_semi")

    def changes(self, dates: DataFrame | None = None) -> DataFrame:
        """(date, ticker, action) with action 'added' or 'removed', on the trailing dates (or those of ``dates`` among them).

        One full outer join of today's set with the previous set moved forward to today.
        """
        processed = self.processed if dates is None else self.processed.join(date_grain(dates), "date", "left_semi")
        today = self.members.join(date_grain(processed), "date", "left_semi").select("date", "ticker")
        cal = aligned_calendar(self.rows, self.align)
        # previous set, keyed by the date on which it is compared
        moved = cal.select(F.col("prev_date").alias("date"), F.col("date").alias("cmp_date")).join(date_grain(processed.select(F.col("date").alias("cmp_date"))), "cmp_date", "left_semi")
        prev = self.members.join(date_grain(moved), "date").select(F.col("cmp_date").alias("date"), "ticker", F.lit(True).alias("was_member"))
        j = today.withColumn("is_member", F.lit(True)).join(prev, ["date", "ticker"], "full_outer")
        return j.where(F.col("is_member").isNull() | F.col("was_member").isNull()).select(
            "date",
            "ticker",
            F.when(F.col("is_member").isNotNull(), F.lit(V1_ADDED)).otherwise(F.lit(V1_REMOVED)).alias("action"),
        )


def price_average_index(bars: DataFrame, n: int = DEFAULT_MEMBERS, days: int | None = None) -> DataFrame:
    """(date, index_value) of the legacy index; one pass over ``bars``."""
    return PriceAverageIndex(bars, n, days=days, materialize=days is not None).performance()


def composition_changes(
    bars: DataFrame,
    n: int = DEFAULT_MEMBERS,
    align: str = "calendar",
    days: int | None = None,
) -> DataFrame:
    """(date, ticker, action) of the legacy composition log; logged only on dates present in ``bars``."""
    return PriceAverageIndex(bars, n, align, days).changes()


def change_counts(changes: DataFrame) -> DataFrame:
    """(date, action, n): per-date number of names added and removed."""
    return changes.groupBy("date", "action").agg(F.count(F.lit(1)).alias("n"))


def simple_metrics(index: DataFrame, changes: DataFrame) -> DataFrame:
    """One row: cumulative_return (last/first - 1, as a fraction), avg_daily_return
    (mean of day-over-day changes, first day excluded), num_changes (log rows)."""
    w = Window.orderBy("date")
    pct = index.withColumn("pct_change", F.col("index_value") / F.lag("index_value").over(w) - 1.0)
    stats = pct.agg(
        F.min_by("index_value", "date").alias("first_value"),
        F.max_by("index_value", "date").alias("last_value"),
        F.avg("pct_change").alias("avg_daily_return"),
    )
    n_changes = changes.select(F.count(F.lit(1))).scalar()
    return stats.select(
        ((F.col("last_value") - F.col("first_value")) / F.col("first_value")).alias("cumulative_return"),
        "avg_daily_return",
        n_changes.alias("num_changes"),
    )


__all__ = [
    "TRAILING_DAYS",
    "PriceAverageIndex",
    "change_counts",
    "composition_changes",
    "price_average_index",
    "simple_metrics",
    "trailing_dates",
]
