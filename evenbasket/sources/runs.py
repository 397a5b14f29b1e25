"""Runs: several tables written as one.

A run writes its rows of the index tables into folders of its own and then
publishes a manifest, which is one file moved into place: until then readers see
the state before, in all tables, and afterwards the new one. A manifest names the
runs that make up the state, in order, and the date from which a later run
replaces an earlier one; it also has the parameters, the dates and the row
counts. Folders of runs that died are never read.

    <root>/runs/<table>/run=<id>/date=<day>/...      rows
    <root>/manifest/<number>.json                    states, the last one counts
"""

from __future__ import annotations

import json
import uuid
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RUN_TABLES, TABLES

if TYPE_CHECKING:
    from .tables import TableStore


class Snapshot:
    """The index tables as of one published manifest (empty ones before the first)."""

    def __init__(self, store: TableStore, manifest: dict | None):
        self.store, self.manifest = store, manifest

    @property
    def parameters(self) -> dict:
        return self.manifest["parameters"] if self.manifest else {}

    def segments(self, name: str) -> list[dict]:
        """(run, until) whose rows count, in order. A table without partitions is written whole by each run."""
        if not self.manifest:
            return []
        return self.manifest["segments"] if TABLES[name][1] else [{"run": self.manifest["run"], "until": None}]

    def read(self, name: str) -> DataFrame:
        """Rows of an index table; every call reads the same state."""
        schema, _ = TABLES[name]
        spark, live = self.store.spark, self.segments(name)
        if not live:
            return spark.createDataFrame([], schema)
        base = self.store.runs_path(name)
        files = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])).option("basePath", base)
        rows = files.parquet(*[f"{base}/run={s['run']}" for s in live])
        for s in live:
            if s["until"] is not None:  # replaced from that date on by a later run
                rows = rows.where((F.col("run") != s["run"]) | (F.col("date") < F.lit(s["until"]).cast("date")))
        return rows.select(*schema.fieldNames())

    def dates(self, name: str) -> dict[str, str]:
        """The folder of each date of a partitioned table."""
        out = {}
        for s in self.segments(name):
            for day in self.manifest["dates"][s["run"]][name]:
                if s["until"] is None or day < s["until"]:
                    out[day] = f"{self.store.runs_path(name)}/run={s['run']}/date={day}"
        return out


class Run:
    """Rows of the index tables that become visible together, or never.

    ``since``: the first date that the run replaces (``None``: all). Rows of
    earlier dates stay those of the state before.
    """

    def __init__(self, store: TableStore, kind: str, parameters: dict, since: str | None = None):
        self.store, self.kind, self.parameters, self.since = store, kind, parameters, since
        self.before = store.pinned()
        self.id = uuid.uuid4().hex
        self.rows: dict[str, int] = {}
        self.dates: dict[str, list[str]] = {}

    def write(self, name: str, df: DataFrame) -> None:
        schema, parts = TABLES[name]
        path = f"{self.store.runs_path(name)}/run={self.id}"
        seen = self.store.write_files(df.select(*schema.fieldNames()), name, path)
        self.store.make_folder(path)  # a run may have no rows
        self.rows[name], self.dates[name] = seen["n_rows"], sorted(str(d) for d in seen.get("dates", []))

    def manifest(self) -> dict:
        old = self.before.manifest or {"seq": 0, "segments": [], "dates": {}}
        segments = []
        for s in old["segments"] if self.since is not None else []:
            until = self.since if s["until"] is None else min(s["until"], self.since)
            own = [d for days in old["dates"][s["run"]].values() for d in days]
            if any(d < until for d in own):
                replaced = any(d >= until for d in own)
                segments.append(s | {"until": until if replaced else s["until"]})
        dates = {s["run"]: old["dates"][s["run"]] for s in segments} | {self.id: self.dates}
        segments.append({"run": self.id, "until": None})
        return {"seq": old["seq"] + 1, "run": self.id, "kind": self.kind, "since": self.since, "parameters": self.parameters, "rows": self.rows, "segments": segments, "dates": dates}

    def publish(self) -> Snapshot:
        """Make the run the state that readers see. Refused if tables are missing, or another run was published meanwhile."""
        missing = [t for t in RUN_TABLES if t not in self.rows]
        if missing:
            raise ValueError(f"the run has not written {', '.join(missing)}")
        manifest = self.manifest()
        self.store.put_new_file(f"{self.store.root}/manifest/{manifest['seq']:09d}.json", json.dumps(manifest))
        done = Snapshot(self.store, manifest)
        for name in RUN_TABLES:
            self.store.register(name, done, self.before)
        return done


def compact(store: TableStore) -> Snapshot:
    """The same state as one run (after many small ones)."""
    now = store.pinned()
    run = Run(store, "compact", now.parameters)
    for name in RUN_TABLES:
        run.write(name, now.read(name))
    return run.publish()


def vacuum(store: TableStore, keep: int = 2) -> list[str]:
    """Delete the folders of runs that none of the last ``keep`` states reads, and older manifests; the deleted run ids.

    Not to be called while a run is being written: its folder is in no state yet.
    """
    states = [json.loads(store.file_text(p)) for p in store.manifest_files()]
    used = {s["run"] for m in states[-keep:] for s in [*m["segments"], m]}
    gone = set()
    for name in RUN_TABLES:
        for folder in store.list_folder(store.runs_path(name)):
            if folder.startswith("run=") and folder[4:] not in used:
                store.remove_path(f"{store.runs_path(name)}/{folder}")
                gone.add(folder[4:])
    for path in store.manifest_files()[:-keep]:
        store.remove_path(path)
    return sorted(gone)
