"""Quality scores: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Features are one- and two-word n-grams of the lower-cased words and of their
shapes (runs of upper, lower, digit, other letters and each symbol), hashed
into ``2**BITS`` slots, and whether a word repeats the one before it. A text's
vector has its n-gram counts over the text's length. A score is the sparse dot
product with the weights.

The weights are learned on a bounded, documented sample of labelled rows
(``SAMPLE_ROWS``, drawn by a hash of the id), in one task; scoring is one pass
over all texts and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, add_columns, drawn_texts, ship_package
from evenbasket.llm.tokens import NOT_SPACE, Words, chunks, mix, split_words

BITS = 18
SAMPLE_ROWS = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.002, 0.1
SCALE = 8.0

#: Classes of bytes in a shape: upper, lower, digit, beyond ASCII; a symbol is its own class.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 2
_CODE = np.random.default_rng(496).integers(1, 2**64 - 1, 256, np.uint64)


def shape_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """Hash of each word's sequence of byte classes, equal neighbours taken once."""
    if not len(words.start):
        return np.zeros(0, np.uint64)
    kind = _CLASS[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[words.start] = True
    at = np.flatnonzero(new)
    first, last = np.searchsorted(at, words.start), np.searchsorted(at, words.end)
    # Long shapes need no more than their first runs to be told from others.
    out = np.zeros(len(words.start), np.uint64)
    for k in range(6):
        has = first + k < last
        out = np.where(has, mix(out ^ _CODE[kind[at[np.minimum(first + k, len(at) - 1)]]]), out)
    return out


def feature_slots(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of consecutive texts and the texts' limits in them.

    A text's n-grams lie together: four for each word (a two-word n-gram at the
    first word reads a mark in place of the word before it).
    """
    mask = np.uint64((1 << BITS) - 1)
    word, shape = words.hash, shape_hashes(data, words)
    before_w, before_s = np.roll(word, 1), np.roll(shape, 1)
    first = words.first[:-1][np.diff(words.first) > 0]
    before_w[first] = before_s[first] = 0
    same = before_w == word
    slots = np.stack(
        [
            mix(word + np.uint64(1)),
            np.where(same, mix(np.full(1, 77, np.uint64)), mix(before_w * np.uint64(0x9E3779B97F4A7C15) ^ word)),
            mix(shape + np.uint64(3)),
            mix(before_s * np.uint64(0xC2B2AE3D27D4EB4F) ^ (shape + np.uint64(5))),
        ],
        1,
    )
    return (slots & mask).astype(np.int32).ravel(), words.first * 4


class FollowTheLeader:
    """FTRL-proximal logistic regression with per-coordinate rates; slot ``size`` is the bias (not regularised to zero)."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.size = size

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        small = np.abs(z) - np.where(np.asarray(at) == self.size, 0, L1)
        return np.where(small > 0, -np.sign(z) * small / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] = grown


def _vectors():
    def derive(column: pa.Array) -> list:
        slots, values = [], []
        for row, to, data, offsets in chunks(column):
            words = split_words(data, offsets, NOT_SPACE)
            all_slots, limits = feature_slots(data, words)
            for k in range(to - row):
                at, n = np.unique(all_slots[limits[k] : limits[k + 1]], return_counts=True)
                slots.append(at.astype(np.int32))
                values.append((n * (SCALE / max(1, limits[k + 1] - limits[k]))).astype(np.float32))
        return [slots, values]

    return derive


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for order, own, y, at, x in zip(*(batch.column(k) for k in range(5)), strict=True):
            rows.append(((order.as_py(), own.as_py()), y.as_py(), at.values.to_numpy(), x.values.to_numpy()))
    rows.sort(key=lambda r: r[0])
    size = 1 << BITS
    model = FollowTheLeader(size)
    for _ in range(EPOCHS):
        for _, y, at, x in rows:
            model.learn(np.append(at, size), np.append(x, 1.0), y)
    yield pa.RecordBatch.from_arrays([pa.array([model.weights(np.arange(size + 1)).astype("<f4").tobytes()])], names=["weights"])


def train(documents: DataFrame, labels: DataFrame, target: str, learns, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights of the hashed n-grams (the last is the bias), learned where ``learns`` (a boolean column of ``documents``) holds.

    Rows with a null id, a null label or no label teach nothing; an id with
    several labels has the largest, and one with several texts teaches a few of
    them, once each (``drawn_texts``). Equal hashes of ids are ordered by id. Without
    any labelled row, as with an empty table, all weights are 0. Other columns,
    whatever their names, are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "quality-sample")
    label = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max(target).cast("int").alias("__y")).where("__y IS NOT NULL")
    source = documents.where(learns).select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__t"))
    labelled = label.join(source.select("__id").distinct(), "__id").withColumn("__order", F.xxhash64(F.col("__id").cast("string")))
    drawn = scratch.keep(labelled.orderBy("__order", "__id").limit(sample_rows))
    vectors = add_columns(drawn_texts(source, drawn), "__t", ["__order", "__h", "__y"], "slots array<int>, x array<float>", _vectors)
    blob = vectors.repartition(1).mapInArrow(_train, "weights binary").first()
    return np.frombuffer(bytes(blob[0]), "<f4").astype(np.float64) if blob is not None else np.zeros((1 << BITS) + 1)


def _scorer(shared):
    def make():
        weights = shared.value
        bias = weights[-1]

        def derive(column: pa.Array) -> list:
            out = []
            for _, _, data, offsets in chunks(column):
                words = split_words(data, offsets, NOT_SPACE)
                slots, limits = feature_slots(data, words)
                sums = np.concatenate(([0.0], np.cumsum(weights[slots])))
                n = np.diff(limits)
                logit = bias + (sums[limits[1:]] - sums[limits[:-1]]) * SCALE / np.maximum(n, 1)
                out.append(1 / (1 + np.exp(-np.clip(logit, -35, 35))))
            return [np.concatenate(out) if out else np.zeros(0)]

        return derive

    return make


def score_quality(documents: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``keep`` columns with score (0 to 1) and predicted (score >= threshold). A null or empty text has the bias alone.

    Texts are read whole, whatever their length; equal texts get equal scores, and
    an empty table gives no rows. A kept column with the name of a made one is
    left out.
    """
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(weights)  # 2**BITS numbers at any input size
    keep = [c for c in keep if c.lower() != "predicted"]
    scored = add_columns(documents, text, keep, "score double", _scorer(shared))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
