"""Session helpers.

The library never creates a session on its own; operators take DataFrames.
These helpers are for tests, the benchmark and command-line jobs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "evenbasket", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured the way tests and the benchmark expect."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is read
    from the session. Only a local-mode session without one (tests, the
    benchmark) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    scratch = tempfile.mkdtemp(prefix="evenbasket-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables next to the session's checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def reliable_checkpoint(df: DataFrame, name: str = "frame", large: bool = False) -> DataFrame:
    """Persist ``df`` reliably in the session's checkpoint folder and continue from it.

    Cuts lineage: later stages (and retries after a lost executor) start from
    the written files instead of re-running the scan and shuffles behind them.
    ``large=True`` writes a parquet table and reads it back (compressed,
    column-pruned re-reads, real file sizes for join planning); small frames
    use ``Dataset.checkpoint``, which costs less per write.
    """
    if not large:
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
