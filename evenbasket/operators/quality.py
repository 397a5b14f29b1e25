"""Data-quality checks on bars (the reference's duplicate-key probe, plus the
price conditions that change index results)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STOCK_DATA_KEY


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """(keys..., duplicate_count) for keys that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def price_counts() -> dict[str, Column]:
    """Aggregates over bars that count the prices which change index results."""
    close = F.col("close").cast("double")
    return {
        "n_null_close": F.count_if(F.col("close").isNull()),
        "n_nan_close": F.count_if(F.isnan(close)),
        "n_nonpositive_close": F.count_if(~F.isnan(close) & (close <= 0)),
        "n_null_market_cap": F.count_if(F.col("market_cap").isNull()),
    }


def quality_report(bars: DataFrame, keys: Sequence[str] = STOCK_DATA_KEY) -> DataFrame:
    """Per date: n_bars, n_tickers, n_duplicate_keys, n_null_close,
    n_nonpositive_close, n_null_market_cap. Two partial aggregations, no join of raw rows."""
    per_key = bars.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("close").isNull()).alias("null_close"),
        F.count_if(F.col("close") <= 0).alias("nonpositive_close"),
        F.count_if(F.col("market_cap").isNull()).alias("null_market_cap"),
    )
    return per_key.groupBy("date").agg(
        F.sum("rows").alias("n_bars"),
        F.count(F.lit(1)).alias("n_tickers"),
        F.count_if(F.col("rows") > 1).alias("n_duplicate_keys"),
        F.sum("null_close").alias("n_null_close"),
        F.sum("nonpositive_close").alias("n_nonpositive_close"),
        F.sum("null_market_cap").alias("n_null_market_cap"),
    )
