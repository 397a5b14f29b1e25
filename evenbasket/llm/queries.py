"""The registered queries of the operators, one for each, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenbasket.llm import oracle, toxicity
from evenbasket.llm.chat import format_conversations, loss_text
from evenbasket.llm.decontamination import find_contamination
from evenbasket.llm.fill_in_middle import fill_in_middle, restored
from evenbasket.llm.language_model import score_documents
from evenbasket.llm.near_dedup import near_duplicates
from evenbasket.llm.packing import pack_documents
from evenbasket.llm.periodic_runs import find_runs
from evenbasket.llm.piece_tokenizer import encode_texts
from evenbasket.llm.pii import KINDS, find_spans, span_list
from evenbasket.llm.quality import score_quality, train
from evenbasket.llm.quality_rules import judge_quality
from evenbasket.llm.tables import table
from evenbasket.llm.url_rules import apply_rules


def remainder(modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(modulus))


def op1_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    digest = F.sha2(span_list(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, span_list(F.concat("base", "terms")).alias("spans"))


def op2_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("SELECT -7L AS conv_id, CAST(turn AS BIGINT) AS turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    formatted = format_conversations(given).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = train(documents, table(spark, sf_dir, "labels"), "quality", remainder(5) != 0)
    scored = score_quality(documents, weights, ["doc_id"], threshold=0.3)
    return scored.select("doc_id", (remainder(5) == 0).alias("held_out"), "score", "predicted")


def op6_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels"), remainder(3) != 1)
    scored = toxicity.score_toxicity(documents, model, ["doc_id"], threshold=0.7)
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(
        "SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow') AS t(host, path, verdict)"
    )
    return apply_rules(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), remainder(5) == 1)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def periodised(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which one in ten, by the id's crc32, repeats a stretch of its words up to its end."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split(F.col("text"), r"[ \t-\r]+", -1), lambda w: w != "")
    own = documents.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    own = own.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    own = own.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    block = "slice(w, a + 1, p)"
    repeated = F.expr(f"array_join(concat(slice(w, 1, a), flatten(array_repeat({block}, CAST((n - a) DIV p AS INT))), slice(w, a + 1, (n - a) % p)), ' ')")
    return own.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(periodised(table(spark, sf_dir, "documents")), ["doc_id"])
    found = found.withColumn("longest", F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, start, period = F.col("longest.length"), -F.col("longest.start"), -F.col("longest.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * longest.length DIV -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_piece_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"), ["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"), ["doc_id"])
    back = restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, fn in globals().items() if name.startswith("op") and callable(fn)}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, sql in oracle.SQL.items() if name in queries()}
