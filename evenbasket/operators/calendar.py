"""Trading calendar: the distinct dates that have bars, with neighbours.

The window here runs over one row per date (a calendar of a century of
trading days is ~25k rows), never over bars, so its single ordered partition
stays small however many tickers there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def date_grain(df: DataFrame) -> DataFrame:
    """Broadcast hint for a frame with at most one row per date.

    Its size is bounded by the calendar (366 rows a year), not by the number
    of tickers or bars, so shipping it to every task is always cheap.
    """
    return F.broadcast(df)


def trading_calendar(bars: DataFrame) -> DataFrame:
    """(date, prev_date, next_date, day_number) over the dates present in ``bars``.

    prev/next are the neighbouring *trading* dates, so a ticker missing on one
    day can never pick up a later day's price.
    """
    w = Window.orderBy("date")
    return (
        bars.select("date")
        .distinct()
        .select(
            "date",
            F.lag("date").over(w).alias("prev_date"),
            F.lead("date").over(w).alias("next_date"),
            F.row_number().over(w).cast("bigint").alias("day_number"),
        )
    )


def calendar_neighbours(dates: DataFrame) -> DataFrame:
    """(date, prev_date, next_date) where neighbours are calendar days."""
    return dates.select(
        "date",
        F.date_sub("date", 1).alias("prev_date"),
        F.date_add("date", 1).alias("next_date"),
    )


def aligned_calendar(bars: DataFrame, align: str = "trading") -> DataFrame:
    """Calendar under one of the two alignment modes: 'trading' or 'calendar'."""
    if align == "trading":
        return trading_calendar(bars).select("date", "prev_date", "next_date")
    if align == "calendar":
        return calendar_neighbours(bars.select("date").distinct())
    raise ValueError(f"align must be 'trading' or 'calendar', not {align!r}")
