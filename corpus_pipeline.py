"""The training-data pipeline: stages over documents, each written as Parquet and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenbasket.llm import toxicity
from evenbasket.llm.decontamination import find_contamination
from evenbasket.llm.near_dedup import NEAR_80, drop_near_duplicates
from evenbasket.llm.packing import pack_documents
from evenbasket.llm.pii import sanitise
from evenbasket.llm.queries import remainder
from evenbasket.llm.tables import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go. The grammar learns from the labelled documents of the input that aren't held out."""
    docs = docs.select(COLUMNS)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), remainder(3) != 1)
    return toxicity.score_toxicity(docs, model, COLUMNS).where("predicted = 0").select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 or more) stays."""
    return drop_near_duplicates(docs.select(COLUMNS), near=NEAR_80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return find_contamination(docs, table(spark, sf_dir, "benchmark"), COLUMNS).where("NOT contaminated").select(COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and terms that disclose it, are replaced by marks; all documents stay."""
    clean = sanitise(docs.select(COLUMNS))
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).cast("long")).select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_filter),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", pii),
    ("best_fit_packing", packing),
]

#: SQL expresses neither the learned toxicity grammar nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "corpus-pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.keep(docs)
            if before is not None:
                scratch.drop(before)
            before = docs
    return docs
