"""Table store: DDL, appends, keyed upserts and exports for the index tables.

Every write measures what it writes (rows, dates, doubtful prices) by an
observation on the written frame itself, so nothing is evaluated a second time;
``TableStore.observed`` has the last write's figures by table.

Tables are parquet folders under one root (a shared folder on a cluster),
partitioned by ``date`` where they are (date, ticker) grain, and registered in
the session catalog under a namespace so SQL can reach them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import price_counts
from ..operators.upsert import last_rows, replace_keys
from ..schemas import RUN_TABLES, TABLES
from ..session import scratch_path
from .runs import Snapshot


def _for_write(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rebalance on the partition columns before a partitioned write: AQE merges
    small outputs into few files and splits a hot date over several tasks."""
    return df.hint("rebalance", *parts) if parts else df


def ddl_columns(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class TableStore:
    """Index tables under ``root``, registered as ``namespace.<table>``."""

    def __init__(self, spark: SparkSession, root: str, namespace: str = "evenbasket"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self.observed: dict[str, dict] = {}

    # -- DDL -------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create_all(self, names: Sequence[str] | None = None) -> None:
        """CREATE DATABASE / TABLE IF NOT EXISTS for the known tables."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.namespace}`")
        for name in names or TABLES:
            if not self.exists(name):
                self._create(name)
                self.sync(name)  # partitions that the folder has already

    def _create(self, name: str) -> None:
        schema, parts = TABLES[name]
        self.make_folder(self.path(name))  # an empty table reads as zero rows
        part = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{self.namespace}`.`{name}` ({ddl_columns(schema)}) "
            f"USING parquet{part} LOCATION '{self.path(name)}'"
        )

    def exists(self, name: str | None = None) -> bool:
        if name is None:
            return self.spark.catalog.databaseExists(self.namespace)
        return self.spark.catalog.tableExists(f"{self.namespace}.{name}")

    def drop(self, name: str | None = None) -> None:
        """Drop one table, or the whole namespace, with the rows. Explicit opt-in only."""
        if name is None:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.namespace}` CASCADE")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.namespace}`.`{name}`")
        # The tables have a LOCATION, so the catalog leaves their folders.
        for table in TABLES if name is None else [name]:
            self.remove_path(self.path(table))
            if table in RUN_TABLES:
                self.remove_path(self.runs_path(table))
        if name is None:
            self.remove_path(f"{self.root}/manifest")

    # -- reads / writes ------------------------------------------------------
    def read(self, name: str) -> DataFrame:
        """Rows of a table. An index table is read as of the last published run; to read several
        as of the same one, use ``pinned().read``. Partitions of other tables come from the catalog,
        so nothing is listed but what a query asks for."""
        if name in RUN_TABLES and (now := self.pinned()).manifest:
            return now.read(name)
        schema, _ = TABLES[name]
        if self.exists(name):
            return self.spark.table(f"`{self.namespace}`.`{name}`").select(*schema.fieldNames())
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.fieldNames())

    def dates(self, name: str) -> list[str]:
        """The dates that a partitioned table has, in order, from its partitions (no rows are read)."""
        part = TABLES[name][1][0]
        if name in RUN_TABLES and (now := self.pinned()).manifest:
            return sorted(now.dates(name))
        folders = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS `{self.namespace}`.`{name}`").collect()] if self.exists(name) else self.list_folder(self.path(name))
        return sorted(f.removeprefix(f"{part}=") for f in folders if f.startswith(f"{part}="))

    def pinned(self) -> Snapshot:
        """The state that the last published run left."""
        files = self.manifest_files()
        return Snapshot(self, json.loads(self.file_text(files[-1])) if files else None)

    def write_files(self, df: DataFrame, name: str, path: str, dynamic: bool = False, mode: str = "overwrite", measure: dict[str, Column] | None = None) -> dict:
        """Write rows of a table to a folder, and return what was measured on the way: n_rows, the dates of a
        partitioned table (one value a date), and ``measure``. The measuring stands directly before the writer,
        in the last stage, whose tasks count once however often they are tried."""
        _, parts = TABLES[name]
        seen = Observation()
        figures = {"n_rows": F.count(F.lit(1)), **({"dates": F.collect_set(parts[0])} if parts else {}), **(measure or {})}
        w = _for_write(df, parts).observe(seen, *[c.alias(k) for k, c in figures.items()]).write.mode(mode)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
        (w.partitionBy(*parts) if parts else w).parquet(path)
        return dict(seen.get)

    def _put(self, name: str, df: DataFrame, **how) -> dict:
        if name in RUN_TABLES and self.manifest_files():
            raise ValueError(f"{name} is written by runs (see sources/runs.py)")
        cols = TABLES[name][0].fieldNames()
        self.observed[name] = seen = self.write_files(df.select(*cols), name, self.path(name), measure=self._measures(name), **how)
        return seen

    @staticmethod
    def _measures(name: str) -> dict[str, Column]:
        return price_counts() if name == "stock_data" else {}

    def append(self, name: str, df: DataFrame) -> None:
        self.refresh(name, self._put(name, df, mode="append").get("dates"))

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace the whole table (idempotent full recompute)."""
        self._put(name, df)
        self.sync(name)

    def put_partitions(self, name: str, df: DataFrame) -> None:
        """Replace exactly the partitions present in ``df`` (dynamic overwrite);
        re-running with the same rows gives the same table."""
        if not TABLES[name][1]:
            raise ValueError(f"{name} is not partitioned")
        self.refresh(name, self._put(name, df, dynamic=True)["dates"])

    def replace_dates(self, name: str, df: DataFrame, dates: Sequence[str]) -> None:
        """Make ``df`` all the rows that a partitioned table has on ``dates``; its rows are of these dates, and dates without any go."""
        written = {str(d) for d in self._put(name, df, dynamic=True)["dates"]}
        self.refresh(name, sorted(written))
        self._drop_dates(name, [d for d in dates if d not in written])

    def _drop_dates(self, name: str, dates: Sequence) -> None:
        parts = TABLES[name][1]
        for day in dates:
            self.remove_path(f"{self.path(name)}/{parts[0]}={day}")
        specs = [self._spec(d, parts) for d in dates]
        if self.exists(name):
            for k in range(0, len(specs), 500):
                self.spark.sql(f"ALTER TABLE `{self.namespace}`.`{name}` DROP IF EXISTS {', '.join(specs[k : k + 500])}")
            self.spark.catalog.refreshTable(f"{self.namespace}.{name}")

    def upsert(self, name: str, batch: DataFrame, keys: Sequence[str], order: str | None = None, keep_stage: bool = False) -> str:
        """Keyed upsert into a stored table; returns the staging path used (deleted after the swap unless ``keep_stage``).

        The batch is reduced to its winning rows and staged first, so it is
        evaluated once; what it holds (rows, duplicate and NULL keys, doubtful
        prices, over all its rows) is measured on the way (``observed``), and a
        NULL in a key is refused. Only the partitions the batch touches are read
        (their dates are known then, so the scan is pruned); the merged partitions
        are staged in the checkpoint folder, then swapped in with a dynamic
        partition overwrite. A failed swap names the staged copy, from which
        ``swap_in`` completes it. Tables without partitions are rewritten whole
        from the staged copy.
        """
        if name in RUN_TABLES and self.manifest_files():
            raise ValueError(f"{name} is written by runs (see sources/runs.py)")
        schema, parts = TABLES[name]
        cols = schema.fieldNames()
        given = scratch_path(self.spark, f"batch-{name}-{uuid.uuid4().hex}")
        counts = {"n_rows": F.count(F.lit(1)), **self._measures(name)}
        reduced = last_rows(batch, cols, keys, order, {f"_{k}": c for k, c in counts.items()})
        null_key = reduce(or_, [F.col(k).isNull() for k in keys])
        figures = {
            **{k: F.coalesce(F.sum(f"_{k}"), F.lit(0)) for k in counts},
            "n_keys": F.count(F.lit(1)),
            "n_duplicate_keys": F.count_if(F.col("_n_rows") > 1),
            "n_null_keys": F.coalesce(F.sum(F.when(null_key, F.col("_n_rows"))), F.lit(0)),
            **({"dates": F.collect_set(parts[0])} if parts else {}),
        }
        seen = Observation()
        reduced.observe(seen, *[c.alias(k) for k, c in figures.items()]).select(*cols).write.parquet(given)
        measured = dict(seen.get)
        if measured["n_null_keys"]:
            self.remove_path(given)
            raise ValueError(f"{name}: the batch has NULL in its key ({', '.join(keys)})")
        new = self.spark.read.schema(schema).parquet(given)
        current = self.read(name)
        if parts:
            current = current.where(F.col(parts[0]).isin(measured["dates"]))
        merged = replace_keys(current, new, keys)
        stage = scratch_path(self.spark, f"stage-{name}-{uuid.uuid4().hex}")
        self.write_files(merged.select(*cols), name, stage)
        self.remove_path(given)
        self.observed[name] = measured
        try:
            self.swap_in(name, stage, measured.get("dates"))
        except Exception as error:
            error.add_note(f"the merged rows are staged in {stage}; swap_in({name!r}, that path) completes the upsert")
            raise
        if not keep_stage:
            self.remove_path(stage)
        return stage

    def swap_in(self, name: str, stage: str, dates: list | None = None) -> None:
        """Move a staged merge into the table: the touched partitions of a
        partitioned table (dynamic overwrite), or the whole table otherwise.
        Idempotent, so it also completes an upsert whose swap failed."""
        schema, parts = TABLES[name]
        staged = self.spark.read.schema(schema).parquet(stage).select(*schema.fieldNames())
        seen = self.write_files(staged, name, self.path(name), dynamic=bool(parts))
        self.refresh(name, dates or seen.get("dates"))

    def delete(self, name: str, doomed: DataFrame, keys: Sequence[str]) -> None:
        """DELETE rows whose key is in ``doomed``; rewrites only the touched partitions."""
        if name in RUN_TABLES and self.manifest_files():
            raise ValueError(f"{name} is written by runs (see sources/runs.py)")
        schema, parts = TABLES[name]
        cols = schema.fieldNames()
        current = self.read(name)
        touched = doomed.select(*parts).distinct() if parts else None
        scope = current.join(touched, list(parts), "left_semi") if parts else current
        kept = scope.join(doomed.select(*keys).distinct(), list(keys), "left_anti")
        stage = scratch_path(self.spark, f"stage-{name}-{uuid.uuid4().hex}")
        left = self.write_files(kept.select(*cols), name, stage).get("dates")
        staged = self.spark.read.schema(schema).parquet(stage).select(*cols)
        if parts:
            # partitions emptied by the delete are removed
            self._drop_dates(name, [r[0] for r in touched.where(~F.col(parts[0]).isin(left)).collect()])  # at most the touched dates
        self.write_files(staged, name, self.path(name), dynamic=bool(parts))
        self.refresh(name)
        self.remove_path(stage)

    # -- files ---------------------------------------------------------------
    def runs_path(self, name: str) -> str:
        return f"{self.root}/runs/{name}"

    def manifest_files(self) -> list[str]:
        """Published states, the last one at the end."""
        return [f"{self.root}/manifest/{f}" for f in sorted(self.list_folder(f"{self.root}/manifest")) if f.endswith(".json")]

    def list_folder(self, path: str) -> list[str]:
        fs, p = self._fs_path(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def file_text(self, path: str) -> str:
        fs, p = self._fs_path(path)
        stream = fs.open(p)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new_file(self, path: str, text: str) -> None:
        """Write a small file and move it into place at once; refused if there is one already."""
        fs, target = self._fs_path(path)
        fs.mkdirs(target.getParent())
        _, part = self._fs_path(f"{self.root}/manifest/_{uuid.uuid4().hex}")
        stream = fs.create(part)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        sc = self.spark.sparkContext
        files = sc._jvm.org.apache.hadoop.fs
        try:  # without the option to overwrite
            files.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(target), sc._gateway.new_array(files.Options.Rename, 0))
        except Exception as error:
            fs.delete(part, False)
            if fs.exists(target):
                raise RuntimeError(f"{path} exists: another run was published meanwhile; run again") from error
            raise

    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(conf), p

    def make_folder(self, path: str) -> None:
        fs, p = self._fs_path(path)
        fs.mkdirs(p)

    def remove_path(self, path: str) -> None:
        fs, p = self._fs_path(path)
        fs.delete(p, True)

    @staticmethod
    def _spec(value, parts: Sequence[str]) -> str:
        return f"PARTITION (`{parts[0]}` = '{value}')"

    # -- catalog ---------------------------------------------------------------
    def sync(self, name: str) -> None:
        """Make the catalog's partitions those of the last published run, or those that the table's folder has (lists the whole folder)."""
        if name in RUN_TABLES and (now := self.pinned()).manifest:
            self.register(name, now)
        elif self.exists(name):
            if TABLES[name][1]:
                self.spark.sql(f"MSCK REPAIR TABLE `{self.namespace}`.`{name}` SYNC PARTITIONS")
            self.spark.catalog.refreshTable(f"{self.namespace}.{name}")

    def register(self, name: str, now: Snapshot, before: Snapshot | None = None) -> None:
        """Point the catalog's table at the folders of a state (only those that changed since ``before``)."""
        if not self.exists(name):
            return
        full, parts = f"`{self.namespace}`.`{name}`", TABLES[name][1]
        if not parts:
            self.spark.sql(f"ALTER TABLE {full} SET LOCATION '{self.runs_path(name)}/run={now.manifest['run']}'")
        else:
            old, new = before.dates(name) if before and before.manifest else {}, now.dates(name)
            if not old:  # nothing known of the catalog's partitions
                self.spark.sql(f"DROP TABLE {full}")
                self._create(name)
            gone = [self._spec(d, parts) for d, place in old.items() if new.get(d) != place]
            come = [f"{self._spec(d, parts)} LOCATION '{place}'" for d, place in new.items() if old.get(d) != place]
            for k in range(0, len(gone), 500):
                self.spark.sql(f"ALTER TABLE {full} DROP IF EXISTS {', '.join(gone[k : k + 500])}")
            for k in range(0, len(come), 500):
                self.spark.sql(f"ALTER TABLE {full} ADD IF NOT EXISTS {' '.join(come[k : k + 500])}")
        self.spark.catalog.refreshTable(f"{self.namespace}.{name}")

    def refresh(self, name: str, dates: Sequence | None = None) -> None:
        """Register the partitions of the written ``dates``; nothing else is listed."""
        if not self.exists(name):
            return
        parts = TABLES[name][1]
        specs = [self._spec(d, parts) for d in dates or []] if parts else []
        for k in range(0, len(specs), 500):
            self.spark.sql(f"ALTER TABLE `{self.namespace}`.`{name}` ADD IF NOT EXISTS {' '.join(specs[k : k + 500])}")
        self.spark.catalog.refreshTable(f"{self.namespace}.{name}")


def export_csv(df: DataFrame, path: str, order: Sequence[str] | None = None) -> None:
    """Write a report as CSV with a header (the reference's spreadsheet/PDF exports).

    List columns are joined with ', ' (CSV has no arrays). Rows stay in their
    partitions; ``order`` range-partitions the output so the part files
    concatenate in that order.
    """
    types = dict(df.dtypes)
    flat = df.select(
        *[F.array_join(c, ", ").alias(c) if types[c].startswith("array") else F.col(c) for c in df.columns]
    )
    out = flat.orderBy(*order) if order else flat
    out.write.mode("overwrite").option("header", True).csv(path)


def read_csv_export(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)
