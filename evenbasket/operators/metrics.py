"""Read-side queries over the index tables: summary metrics, composition on a
date, recent changes, the performance series with change markers.

All of them read date-grain tables (performance) or filter the (date, ticker)
tables by date first, so partition pruning applies when they are stored
partitioned by date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import action_display_class, currency_text, percent_text
from ..schemas import ACTION_ADD, ACTION_REMOVE, TRAILING_DAYS
from .calendar import date_grain


def as_of_column(df: DataFrame, as_of: str | None) -> Column:
    """Resolve an as-of anchor: a date literal, 'max' (last date of ``df``, a
    scalar subquery evaluated once) or None (today)."""
    if as_of is None:
        return F.current_date()
    if as_of == "max":
        return df.select(F.max("date")).scalar()
    return F.lit(as_of).cast("date")


def trailing_window(df: DataFrame, days: int = TRAILING_DAYS, as_of: str | None = None) -> DataFrame:
    """Rows with as_of - days <= date <= as_of."""
    anchor = as_of_column(df, as_of)
    return df.where(F.col("date").between(F.date_sub(anchor, days), anchor))


def day_slice(df: DataFrame, date: str) -> DataFrame:
    return df.where(F.col("date") == F.lit(date).cast("date"))


def range_slice(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def change_days(log: DataFrame) -> DataFrame:
    """One row: change_days (dates with any log row) and composition_change_days
    (dates with an ADD or REMOVE)."""
    return log.agg(
        F.countDistinct("date").alias("change_days"),
        F.countDistinct(F.when(F.col("action_type").isin(ACTION_ADD, ACTION_REMOVE), F.col("date"))).alias(
            "composition_change_days"
        ),
    )


def change_dates(log: DataFrame) -> DataFrame:
    return log.select("date").distinct()


def summary_metrics(perf: DataFrame, log: DataFrame, days: int = TRAILING_DAYS, as_of: str | None = None) -> DataFrame:
    """One row: cumulative_return and avg_daily_return (percent) over the
    trailing window, change counts over the whole log. An empty window gives
    NULL returns."""
    window = trailing_window(perf, days, as_of)
    returns = window.agg(
        F.min_by("index_value", "date").alias("start_value"),
        F.max_by("index_value", "date").alias("end_value"),
        F.avg("daily_return").alias("avg_return"),
    )
    changes = change_days(log)
    return returns.select(
        ((F.col("end_value") / F.col("start_value") - 1.0) * 100.0).alias("cumulative_return"),
        (F.col("avg_return") * 100.0).alias("avg_daily_return"),
        changes.select("change_days").scalar().alias("change_days"),
        changes.select("composition_change_days").scalar().alias("composition_change_days"),
    )


def composition_on_date(constituents: DataFrame, date: str) -> DataFrame:
    """(ticker, weight, notional, weight_text, notional_text) held on ``date``."""
    return day_slice(constituents, date).select(
        "ticker",
        "weight",
        "notional",
        percent_text("weight").alias("weight_text"),
        currency_text("notional").alias("notional_text"),
    )


def recent_changes(log: DataFrame) -> DataFrame:
    """Trade log listing, newest first, with display text and colour class."""
    return log.select(
        "date",
        "ticker",
        "action_type",
        "notional_change",
        currency_text("notional_change").alias("notional_text"),
        action_display_class("action_type").alias("display_class"),
    ).orderBy(F.col("date").desc(), F.col("ticker").asc())


def performance_series(perf: DataFrame, log: DataFrame, days: int = TRAILING_DAYS, as_of: str | None = None) -> DataFrame:
    """(date, index_value, daily_return, is_change_day) over the trailing window,
    ordered by date. The marker is a left join with the distinct log dates."""
    window = trailing_window(perf.select("date", "index_value", "daily_return"), days, as_of)
    marks = change_dates(log).withColumn("is_change_day", F.lit(True))
    return (
        window.join(date_grain(marks), "date", "left")
        .select("date", "index_value", "daily_return", F.coalesce("is_change_day", F.lit(False)).alias("is_change_day"))
        .orderBy("date")
    )


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def log_preview(log: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of the log under a total order (date, ticker)."""
    return log.orderBy("date", "ticker").limit(rows)
