"""Keyed upsert (last writer wins, whole-row replace), delete by key, refresh.

The batch is reduced to one row a key: every row carries a version (batch
sequence, then all values) and the greatest wins. `max(struct)` aggregates
partially on the map side, so a key repeated many times in a batch is combined
before the shuffle instead of landing whole in one task (a row_number window
would not). Existing rows whose key is in the batch give way (anti join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import BACKFILL_MONTHS, STOCK_DATA_KEY


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = STOCK_DATA_KEY,
    order: str | Column | None = None,
) -> DataFrame:
    """Rows of ``existing`` replaced by / extended with rows of ``batch`` on ``keys``.

    Every non-key column is overwritten, NULLs included. Inside the batch the
    row with the greatest ``order`` wins; on an exact tie the greatest row by
    all columns wins, so the result never depends on partitioning. ``existing``
    has one row a key and is not aggregated: with a small batch, AQE broadcasts
    its keys and existing rows never move.
    """
    return replace_keys(existing, last_rows(batch, existing.columns, keys, order), keys)


def replace_keys(existing: DataFrame, new: DataFrame, keys: Sequence[str] = STOCK_DATA_KEY) -> DataFrame:
    """``existing`` without the keys of ``new``, and ``new`` (one row a key)."""
    cols = existing.columns
    return existing.join(new.select(*keys), list(keys), "left_anti").select(*cols).unionByName(new.select(*cols))


def last_rows(
    batch: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = STOCK_DATA_KEY,
    order: str | Column | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """The winning row of each key of a batch, with ``counts`` (aggregates over all rows of the key) beside it."""
    values = [c for c in cols if c not in keys]
    seq = F.lit(0).cast("bigint") if order is None else (F.col(order) if isinstance(order, str) else order).cast("bigint")
    version = F.struct(seq.alias("_seq"), *[F.col(c).alias(c) for c in values])
    counts = counts or {}
    last = batch.groupBy(*keys).agg(F.max(version).alias("_w"), *[c.alias(name) for name, c in counts.items()])
    kept = {c: F.col(c) if c in keys else F.col(f"_w.{c}").alias(c) for c in cols}
    return last.select(*kept.values(), *counts)


def delete_by_key(df: DataFrame, doomed: DataFrame, keys: Sequence[str] = STOCK_DATA_KEY) -> DataFrame:
    """Rows of ``df`` whose key is not in ``doomed`` (DELETE ... WHERE key IN ...)."""
    return df.join(doomed.select(*keys).distinct(), list(keys), "left_anti")


def unseen_tickers(universe: DataFrame, stored: DataFrame) -> DataFrame:
    """(ticker) in the universe's `Symbol` column but never stored."""
    return (
        universe.select(F.col("Symbol").alias("ticker"))
        .distinct()
        .join(stored.select("ticker").distinct(), "ticker", "left_anti")
    )


def refresh_batch(
    existing: DataFrame,
    landed: DataFrame,
    universe: DataFrame,
    as_of: str,
    backfill_months: int = BACKFILL_MONTHS,
) -> DataFrame:
    """The rows a daily refresh writes, with a `_seq` column (0 back-fill, 1 daily).

    Back-fill: the last ``backfill_months`` of bars for universe tickers never
    stored. Daily: the ``as_of`` bars of every universe ticker.
    """
    day = F.lit(as_of).cast("date")
    fresh = unseen_tickers(universe, existing)
    backfill = (
        landed.where((F.col("date") > F.add_months(day, -backfill_months)) & (F.col("date") <= day))
        .join(fresh, "ticker", "left_semi")
        .withColumn("_seq", F.lit(0))
    )
    members = universe.select(F.col("Symbol").alias("ticker")).distinct()
    daily = landed.where(F.col("date") == day).join(members, "ticker", "left_semi").withColumn("_seq", F.lit(1))
    return backfill.unionByName(daily)


def refresh(
    existing: DataFrame,
    landed: DataFrame,
    universe: DataFrame,
    as_of: str,
    backfill_months: int = BACKFILL_MONTHS,
) -> DataFrame:
    """Daily refresh: back-fill unseen tickers, then the day's bars, upserted."""
    batch = refresh_batch(existing, landed, universe, as_of, backfill_months)
    return upsert(existing, batch, order="_seq")
