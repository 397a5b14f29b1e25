"""Helpers shared by the operators: Arrow passes over texts, and tables kept between steps."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from evenbasket.llm.tokens import chunks
from evenbasket.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def add_columns(df: DataFrame, text: str, keep: list[str], added: str, make: Callable[[], Callable[[pa.Array], list]]) -> DataFrame:
    """``keep`` columns of ``df`` and columns that a function derives from the ``text`` column.

    ``make`` runs once a task and returns a function from an Arrow string array
    to the added columns (``added`` is their DDL). A kept column with the name of
    an added one is left out. One pass, no shuffle.
    """
    extra = StructType.fromDDL(added)
    keep = [c for c in keep if c.lower() not in {n.lower() for n in extra.names}]
    ship_package(df.sparkSession)
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("__text"))
    out = StructType(source.schema.fields[:-1] + extra.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        derive = make()
        types = [f.type for f in to_arrow_schema(extra)]
        for batch in batches:
            made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(derive(batch.column(len(keep))), types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], names=out.names)

    return source.mapInArrow(run, out)


def derive_columns(df: DataFrame, text: str, keep: list[str], added: str, make: Callable[[], Callable[..., list]], given: tuple[Column, ...] = ()) -> DataFrame:
    """``keep`` columns of ``df`` and columns made from its texts, a chunk of texts at a time.

    ``make`` runs once a task and returns a function of a chunk's bytes, the
    offsets of its texts in them, and the ``given`` columns as Arrow arrays; it
    returns the added columns (``added`` is their DDL). A kept column with the
    name of an added one is left out. A null text is empty. One pass, no shuffle.
    """
    extra = StructType.fromDDL(added)
    made = {n.lower() for n in extra.names}
    keep = [c for c in keep if c.lower() not in made]
    ship_package(df.sparkSession)
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    out = StructType(kept.schema.fields + extra.fields)
    columns = [F.col(f"`{c}`") for c in keep] + [*given, F.col(f"`{text}`")]
    source = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        derive = make()
        types = [f.type for f in to_arrow_schema(extra)]
        for batch in batches:
            for row, to, data, offsets in chunks(batch.column(batch.num_columns - 1)):
                others = [c.slice(row, to - row) for c in batch.columns[:-1]]
                found = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(derive(data, offsets, *others[n:]), types, strict=True)]
                yield pa.RecordBatch.from_arrays([*others[:n], *found], names=out.names)

    return source.mapInArrow(run, out)


#: Different texts of one id that a labelled sample takes.
TEXTS_OF_ID = 4


def drawn_texts(source: DataFrame, drawn: DataFrame) -> DataFrame:
    """Rows (__id, __t) of ``source`` with the columns of ``drawn`` (a bounded sample of ids), and __h, the text's hash.

    An id may repeat: it gives at most ``TEXTS_OF_ID`` different texts, those of
    least hash, once each, so the rows are bounded by the sample's size.
    """
    hashed = source.join(F.broadcast(drawn), "__id").withColumn("__h", F.xxhash64(F.coalesce("__t", F.lit(""))))
    first = Window.partitionBy("__id").orderBy("__h")
    chosen = hashed.select("__id", "__h").distinct().withColumn("__k", F.row_number().over(first)).where(F.col("__k") <= TEXTS_OF_ID)
    return hashed.join(F.broadcast(chosen.select("__id", "__h")), ["__id", "__h"]).dropDuplicates(["__id", "__h"])


class Scratch:
    """Parquet tables between the steps of one run, in the session's shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.n = 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and go on from the written table (cuts the lineage)."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame)))
            path.getFileSystem(conf).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package (what ``--py-files`` does), once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_evenbasket_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="evenbasket-py-"), "evenbasket.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "evenbasket")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    sc._evenbasket_shipped = True
