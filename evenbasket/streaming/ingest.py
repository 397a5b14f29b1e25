"""Incremental bar ingest with Structured Streaming.

Landed bar files (tidy rows, one or more drops per day) are picked up by a
file-source stream and merged into the stored `stock_data` table by a keyed
upsert per micro-batch. The upsert is idempotent, so a micro-batch replayed
after a failure leaves the same table (at-least-once delivery, exactly-once
effect). `availableNow` processes everything landed so far and stops, which is
how the reference's hand-run daily refresh maps onto a scheduled job.

Recency: inside one micro-batch the row with the greatest `seq` wins (ties:
greatest row); across micro-batches the later batch wins, i.e. files are
applied in arrival (modification-time) order, last writer wins.

Late or corrected bars are just rows for an old date: the upsert rewrites that
date's partition, and a rebuilt index picks them up. Where old dates are closed,
``ingest_event_time`` keeps a watermark on the bars' dates instead: rows behind
it are refused with their reason, and a row landed before is dropped by keyed state.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..schemas import STOCK_DATA, STOCK_DATA_KEY
from ..session import scratch_path
from ..sources.tables import TableStore

# Why a landed row is refused.
LATE, NO_KEY = "late", "no date or ticker"
DAY_MS = 86_400_000
# Groups that hold the state of landed rows, whatever their keys.
LOTS = 4096
REFUSED = T.StructType([*STOCK_DATA.fields, T.StructField("seq", T.LongType()), T.StructField("reason", T.StringType())])


def landed_bars_stream(spark: SparkSession, landing_dir: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Streaming DataFrame of landed stock_data rows plus an optional `seq`
    column (later drops carry a larger seq; absent means 0)."""
    schema = T.StructType(STOCK_DATA.fields + [T.StructField("seq", T.LongType())])
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(landing_dir).withColumn("seq", F.coalesce("seq", F.lit(0)))


def ingest_available(
    spark: SparkSession,
    landing_dir: str,
    store: TableStore,
    checkpoint_location: str,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> None:
    """Merge every landed file not yet ingested into `stock_data`, then stop."""

    def merge(batch: DataFrame, epoch_id: int) -> None:
        store.upsert("stock_data", batch, keys=STOCK_DATA_KEY, order="seq")

    query = (
        landed_bars_stream(spark, landing_dir, fmt, max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def admit(landed: DataFrame, delay: str, lots: int = LOTS) -> DataFrame:
    """Landed rows and why they are refused (``reason``, NULL for admitted ones); replays are dropped.

    The watermark is the greatest date of the earlier micro-batches, less ``delay`` ("30 days"). A row before
    it is late, a row without date or ticker has no key; both are kept with that reason, in any number of copies.
    Of equal rows (all columns, ``seq`` too) on other dates the first to come is kept, so a correction back to an
    earlier value needs a ``seq`` of its own. A date far ahead closes all dates before it: its refused rows are not lost.

    Rows are dealt to ``lots`` groups by their content, so no ticker or date is a hot key. The state of a lot is the
    hashes (64 bits) of its rows since the watermark: it grows with ``delay``, not with time. Only these and the row as
    text go through Python; the row comes back as it was.
    """
    key_known = F.col("date").isNotNull() & F.col("ticker").isNotNull()
    day = F.when(key_known, F.unix_date("date"))
    rows = landed.select(
        F.timestamp_seconds(day.cast("bigint") * 86_400).alias("_at"),
        day.alias("_day"),
        F.xxhash64(*landed.columns).alias("_row"),
        F.to_json(F.struct(*landed.columns), {"ignoreNullFields": "false"}).alias("_landed"),
    )
    rows = rows.withColumn("_lot", F.pmod("_row", F.lit(lots))).withWatermark("_at", delay)

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bound = -(-state.getCurrentWatermarkMs() // DAY_MS)  # the first day that is not before the watermark
        days, hashes = state.get if state.exists else ([], [])
        seen = {h: d for d, h in zip(days, hashes, strict=True) if d >= bound}
        for rows in frames:
            no_key, late = rows["_day"].isna(), rows["_day"] < bound
            new = ~(no_key | late | rows["_row"].duplicated() | rows["_row"].isin(list(seen)))
            seen.update(zip(rows.loc[new, "_row"].tolist(), rows.loc[new, "_day"].astype("int64").tolist(), strict=True))
            reason = pd.Series(np.select([no_key, late], [NO_KEY, LATE], ""), index=rows.index)
            yield pd.DataFrame({"_landed": rows["_landed"], "reason": reason})[no_key | late | new]
        state.update((list(seen.values()), list(seen)))

    judged = rows.groupBy("_lot").applyInPandasWithState(
        judge, "_landed string, reason string", "days array<int>, hashes array<bigint>", "append", GroupStateTimeout.NoTimeout
    )
    return judged.select(F.from_json("_landed", landed.schema).alias("r"), F.nullif("reason", F.lit("")).alias("reason")).select("r.*", "reason")


def ingest_event_time(
    spark: SparkSession,
    landing_dir: str,
    store: TableStore,
    checkpoint_location: str,
    refused_dir: str,
    delay: str = "30 days",
    fmt: str = "parquet",
    max_files: int | None = None,
) -> None:
    """Merge every landed file not yet ingested into `stock_data` but for what ``admit`` refuses, then stop.

    Refused rows go to ``refused_dir``, a folder for each micro-batch that a replay overwrites. The
    watermark and the state are in ``checkpoint_location``, so they hold over the runs of a scheduled job. A
    micro-batch is judged once, into the checkpoint folder, and both sides are read from there.
    """

    def merge(batch: DataFrame, epoch_id: int) -> None:
        stage = scratch_path(spark, f"landed-{uuid.uuid4().hex}")
        batch.withColumn("refused", F.col("reason").isNotNull()).write.partitionBy("refused").parquet(stage)
        judged = spark.read.schema(T.StructType([*REFUSED.fields, T.StructField("refused", T.BooleanType())])).parquet(stage)
        judged.where("refused").drop("refused").write.mode("overwrite").parquet(f"{refused_dir.rstrip('/')}/epoch={epoch_id}")
        store.upsert("stock_data", judged.where("NOT refused"), keys=STOCK_DATA_KEY, order="seq")
        store.remove_path(stage)

    query = (
        admit(landed_bars_stream(spark, landing_dir, fmt, max_files), delay)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_refused(spark: SparkSession, refused_dir: str) -> DataFrame:
    """All refused rows: stock_data's columns, ``seq``, ``reason`` and the micro-batch (``epoch``)."""
    return spark.read.schema(T.StructType([*REFUSED.fields, T.StructField("epoch", T.LongType())])).parquet(refused_dir)
