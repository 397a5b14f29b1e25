"""Bar tables derived from the shared test tables.

Both adapters are partial/final hash aggregations over a fact table, grouped
by the integer key (the monthly one over days first): the map side combines rows per (date, key) before
the shuffle, so a hot ticker or date costs one combined row per map task, not
its raw rows. Money is summed as whole cents (BIGINT), which is exact and keeps
the aggregation on the fixed-width hash path; ticker symbols are formatted
after the aggregation, once per bar instead of once per fact row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import cents_sum, ticker_code


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def supplier_month_bars(lineitem: DataFrame, key: str = "l_suppkey", prefix: str = "S") -> DataFrame:
    """Fixture F1: one bar per (month of ship date, supplier).

    close = VWAP (exact sums), high/low = extreme unit price,
    open = lowest unit price on the month's first ship date, volume = units,
    market_cap = dollar volume. ``key='l_partkey'`` gives the sparse variant.
    Days are combined first: every buffer then has a fixed width (a first
    shipment by a struct of keys would sort all rows), and a hot key of a month
    is spread over its days.
    """
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    days = (
        lineitem.select(
            F.trunc(F.to_date("l_shipdate"), "MM").alias("date"),
            F.col(key).alias("_key"),
            F.to_date("l_shipdate").alias("day"),
            "l_extendedprice",
            "l_quantity",
            unit.alias("unit_price"),
        )
        .groupBy("date", "_key", "day")
        .agg(
            F.min("unit_price").alias("low"),
            F.max("unit_price").alias("high"),
            cents_sum("l_extendedprice").alias("cap_cents"),
            F.sum(F.rint("l_quantity").cast("bigint")).alias("volume"),
        )
    )
    bars = days.groupBy("date", "_key").agg(
        F.min_by("low", "day").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("cap_cents").alias("cap_cents"),
        F.sum("volume").alias("volume"),
    )
    market_cap = F.col("cap_cents").cast("double") / 100.0
    return bars.select(
        "date",
        ticker_code(prefix, "_key").alias("ticker"),
        "open",
        "high",
        "low",
        (market_cap / F.col("volume").cast("double")).alias("close"),
        "volume",
        market_cap.alias("market_cap"),
    )


def supplier_day_prices(lineitem: DataFrame) -> DataFrame:
    """(date, ticker, close): a supplier's mean unit price on each ship date (exact sums); days without shipments have none."""
    days = lineitem.select(F.to_date("l_shipdate").alias("date"), "l_suppkey", "l_extendedprice", "l_quantity")
    days = days.groupBy("date", "l_suppkey").agg(cents_sum("l_extendedprice").alias("cents"), F.sum(F.rint("l_quantity").cast("bigint")).alias("units"))
    return days.select("date", ticker_code("S", "l_suppkey").alias("ticker"), (F.col("cents").cast("double") / 100.0 / F.col("units").cast("double")).alias("close"))


def user_day_bars(events: DataFrame) -> DataFrame:
    """Fixture F2: one bar per (day, user) of the event stream.

    market_cap = exact sum of values, volume = event count, close = mean value,
    open = value of the first event of the day (lowest event_id).
    """
    bars = (
        events.select(F.to_date("ts").alias("date"), "user_id", "event_id", "value")
        .groupBy("date", "user_id")
        .agg(
            F.min_by("value", "event_id").alias("open"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            cents_sum("value").alias("cap_cents"),
            F.count(F.lit(1)).alias("volume"),
        )
    )
    market_cap = F.col("cap_cents").cast("double") / 100.0
    return bars.select(
        "date",
        ticker_code("U", "user_id").alias("ticker"),
        "open",
        "high",
        "low",
        (market_cap / F.col("volume").cast("double")).alias("close"),
        "volume",
        market_cap.alias("market_cap"),
    )


def supplier_universe(supplier: DataFrame) -> DataFrame:
    """Index universe (one `Symbol` column) from the supplier dimension."""
    return supplier.select(ticker_code("S", "s_suppkey").alias("Symbol"))


def monthly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_month_bars(read_table(spark, sf_dir, "lineitem"))


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_day_bars(read_table(spark, sf_dir, "events"))
