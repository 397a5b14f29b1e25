"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of consecutive words of the benchmark items. A shift
table over blocks of two words tells how far the search may jump; where it may
not, the bucket of the block (the pattern's suffix) selects patterns, and a
comparison of the words themselves confirms an occurrence.

One pass over the documents and no shuffle. The benchmark is cut into parts of
at most ``PART_CHARS`` characters (a checked bound for what is collected and
broadcast); with more parts than one, the documents are passed once for each,
and hits are carried along, so that the result is exact at any benchmark size.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, add_columns, ship_package
from evenbasket.llm.tokens import ALNUM, chunks, ngram_hashes, split_words

WINDOW = 10
PART_CHARS = 8 << 20
SHIFT_BITS = 20


class PatternSet:
    """Wu-Manber tables of the patterns of one length (in words)."""

    def __init__(self, length: int, patterns: dict[bytes, set[str]]):
        self.length = length
        self.block = min(2, length)
        keys = sorted(patterns)
        joined = [k.split(b" ") for k in keys]
        data = b"".join(keys)
        offsets = np.cumsum([0, *map(len, keys)])
        words = split_words(np.frombuffer(data, np.uint8), offsets, ALNUM)
        blocks = _block_hashes(words.hash, self.block)
        jump = length - self.block + 1
        self.shift = np.full(1 << SHIFT_BITS, jump, np.uint8 if jump < 256 else np.uint32)
        self.bucket: dict[int, list[tuple[bytes, list[str]]]] = {}
        for k, (key, parts) in enumerate(zip(keys, joined, strict=True)):
            assert len(parts) == length
            at = words.first[k]
            own = blocks[at : at + jump]
            slots = own >> np.uint64(64 - SHIFT_BITS)
            np.minimum.at(self.shift, slots, np.arange(jump - 1, -1, -1).astype(self.shift.dtype))
            self.bucket.setdefault(int(own[-1]), []).append((key, sorted(patterns[key])))

    def search(self, words, hit: np.ndarray, found: list[set[str]]) -> None:
        """Mark the words inside occurrences and note the items, text by text."""
        if len(words.hash) < self.length:
            return
        blocks = _block_hashes(words.hash, self.block)  # of the block that starts at a word
        shifts = self.shift[blocks >> np.uint64(64 - SHIFT_BITS)]
        shifts = shifts.tobytes() if shifts.dtype == np.uint8 else shifts.tolist()
        back = self.length - self.block  # from the block's first word to the window's first
        for doc in np.flatnonzero(np.diff(words.first) >= self.length).tolist():
            at, end = int(words.first[doc]) + back, int(words.first[doc + 1]) - self.block
            while at <= end:
                jump = shifts[at]
                if jump:
                    at += jump
                    continue
                bucket = self.bucket.get(int(blocks[at]))
                if bucket:
                    first = at - back
                    here = b" ".join([words.text(i) for i in range(first, first + self.length)])
                    for key, items in bucket:
                        if key == here:
                            hit[first : first + self.length] = True
                            found[doc].update(items)
                at += 1


def _block_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    return ngram_hashes(hashes, size)


def benchmark_windows(rows: list[tuple[str | None, str | None]], window: int) -> dict[int, dict[bytes, set[str]]]:
    """Windows of (item, text) rows by their length in words, with the items that hold them."""
    out: dict[int, dict[bytes, set[str]]] = {}
    items = [r[0] or "" for r in rows]
    column = pa.array([r[1] for r in rows], pa.large_string())
    for row, to, data, offsets in chunks(column):
        words = split_words(data, offsets, ALNUM)
        for k in range(to - row):
            a, b = int(words.first[k]), int(words.first[k + 1])
            own = [words.text(i) for i in range(a, b)]
            n = min(window, len(own))
            for i in range(len(own) - n + 1 if n else 0):
                out.setdefault(n, {}).setdefault(b" ".join(own[i : i + n]), set()).add(items[row + k])
    return out


def _searcher(sets, previous: bool):
    def make():
        loaded = sets.value

        def derive(column: pa.Array) -> list:
            texts, old_hits, old_items = (column.field(0), column.field(1), column.field(2)) if previous else (column, None, None)
            n_words, n_hit, hits, items = [], [], [], []
            for row, to, data, offsets in chunks(texts):
                words = split_words(data, offsets, ALNUM)
                hit = np.zeros(len(words.hash), bool)
                found: list[set[str]] = [set() for _ in range(to - row)]
                for patterns in loaded:
                    patterns.search(words, hit, found)
                for k in range(to - row):
                    own = hit[words.first[k] : words.first[k + 1]]
                    if previous:
                        own = own | np.unpackbits(np.frombuffer(old_hits[row + k].as_py(), np.uint8), count=len(own)).astype(bool)
                        found[k].update(old_items[row + k].as_py())
                    n_words.append(len(own))
                    n_hit.append(int(own.sum()))
                    hits.append(np.packbits(own).tobytes())
                    items.append(sorted(found[k]))
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            return [n_words, n_hit, [len(x) for x in items], digests, [x > 0 for x in n_hit], hits, items]

        return derive

    return make


ADDED = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, hit_words binary, items array<string>"


def find_contamination(documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", window: int = WINDOW, part_chars: int = PART_CHARS) -> DataFrame:
    """``keep`` columns of each document and what of it occurs in the benchmark.

    Added: n_words; n_hit (words inside occurrences of windows); n_items and
    ``items`` (sorted ids, as strings) of the items with occurring windows;
    items_sha256; contaminated (n_hit > 0); hit_words (a bit for each word).

    Null and empty texts have no words and are clean. A benchmark row without
    words has no window; a null item_id counts as the item ''; rows that repeat
    an item_id add to its windows. An empty benchmark leaves all documents
    clean. Other columns of either table are not read.
    """
    spark = documents.sparkSession
    ship_package(spark)
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / part_chars))
    source = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    if parts > 1:
        source = source.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    scratch = Scratch(spark, "decontamination")
    state, previous = documents, None
    for part in range(parts):
        rows = (source.where(F.col("part") == part).drop("part") if parts > 1 else source).collect()
        windows = benchmark_windows([(r[0], r[1]) for r in rows], window)
        sets = spark.sparkContext.broadcast([PatternSet(n, windows[n]) for n in sorted(windows)])
        if part:
            state = state.withColumn("__in", F.struct(F.col(f"`{text}`"), "hit_words", "items")).drop(*ADDED_NAMES)
        carried = list(dict.fromkeys([*keep, text])) if part < parts - 1 else keep
        state = add_columns(state, "__in" if part else text, carried, ADDED, _searcher(sets, part > 0))
        if part < parts - 1:
            state = scratch.keep(state)
            if previous is not None:
                scratch.drop(previous)
            previous = state
    return state


ADDED_NAMES = [x.split()[0] for x in ADDED.split(", ")]
