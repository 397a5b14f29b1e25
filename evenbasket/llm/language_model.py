"""Language-model scores by deleted interpolation of n-gram estimates.

Tokens are the words of a text and one end. The model mixes the maximum-
likelihood estimates of the word after its context, of the word alone, and a
uniform one; the weights depend on how often the context was seen (a bucket for
each power of two) and are learned by expectation-maximisation on counts of
training documents held out for it.

Counts are exact and never gathered in one place. Texts are cut into blocks; a
block sends its distinct n-grams with their counts to the reducers, hashed by
n-gram, and gets the corpus counts back in the same order, so only distinct
n-grams are shuffled, as sorted 64-bit hashes in six or so bytes each. Each block
is then scored by array look-ups, one block at a time: a block of 4 MiB holds
some 60 MB of arrays, and about 130 MB while they are built.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, ship_package
from evenbasket.llm.tokens import NOT_SPACE, mix, word_spans

#: Bytes of text in a block and n-grams for a reducer's group (about).
BLOCK_BYTES, GROUP_NGRAMS = 4 << 20, 1 << 20
#: Training documents of which one in so many is held out for the weights.
DELETED = 10
CONTEXT_BUCKETS = 33
#: Steps of the binned estimates, per power of two.
BINS = 8
ROUNDS, TOLERANCE = 200, 1e-9

#: What a block's tokens are made from, and the result's columns.
_PARTS = ["n_bytes", "folds", "offsets", "states", "rows", "contexts", "packed"]
_SCORES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
_END = np.uint64(0x6A09E667F3BCC909)
_CODEC = "zstd"
TRAIN, DELETED_FOLD, HELD_OUT = 0, 1, 2
#: Tokens and distinct words in training; the same without the documents held out for the weights.
TOTALS = ["tokens", "kinds", "main_tokens", "main_kinds"]


# -- blocks ------------------------------------------------------------------


#: Whether a part of a text begins it, and ends it (a whole text does both).
_BEGINS, _ENDS = 1, 2


def text_parts(raw: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Byte ranges of a text of about ``limit`` bytes each, cut behind white space; a longer word stays whole."""
    at = 0
    while len(raw) - at > limit:
        space = np.flatnonzero(~NOT_SPACE[raw[at : at + limit]])
        if len(space):
            end = at + int(space[-1]) + 1
        else:
            end = at + limit
            while end < len(raw):
                space = np.flatnonzero(~NOT_SPACE[raw[end : end + limit]])
                if len(space):
                    end += int(space[0]) + 1
                    break
                end += limit
        if end >= len(raw):
            break
        yield at, end
        at = end
    yield at, len(raw)


def _whole(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """State, row number (none) and context of ``n`` whole texts."""
    return np.full(n, _BEGINS | _ENDS, np.uint8), np.full(n, -1, np.int64), np.full(n, _END, np.uint64)


def _blocks(limit: int):
    """Rows (doc_id, fold, text) -> a row per block; the documents held out for the weights have blocks of their own (odd numbers).

    A text longer than a block is cut into parts, each with the word before it as
    its context and the number of its row, by which the parts' scores are added up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, cut = TaskContext.get().partitionId(), 0, 0
        held: dict[int, list] = {0: [], 1: []}  # (ids, folds, texts, states, rows, contexts) of slices
        size = {0: 0, 1: 0}

        def block(odd: int) -> pa.RecordBatch:
            nonlocal made
            ids, folds, texts = (pa.chunked_array([s[k] for s in held[odd]]).combine_chunks() for k in range(3))
            states, rows, contexts = (np.concatenate([s[k] for s in held[odd]]) for k in range(3, 6))
            held[odd], size[odd] = [], 0
            offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            data = texts.buffers()[2]
            raw = data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes() if data is not None else b""
            number = ((task << 28) + made) * 2 + odd
            made += 1
            packed = pa.compress(raw, codec=_CODEC, asbytes=True) if raw else b""
            blobs = (folds.to_numpy(zero_copy_only=False).astype(np.uint8), offsets - offsets[0], states, rows, contexts)
            columns = [
                pa.array([number], pa.int64()),
                pa.array([len(raw)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                *(pa.array([x.tobytes()], pa.binary()) for x in blobs),
                pa.array([packed], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "n_bytes", "ids", "folds", "offsets", "states", "rows", "contexts", "packed"])

        def add(odd: int, ids: pa.Array, folds: pa.Array, texts: pa.Array, *about: np.ndarray) -> Iterator[pa.RecordBatch]:
            """A slice of texts, cut where the block is full."""
            lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)) if len(texts) else []
            start = 0
            for k, n in enumerate(lengths):
                size[odd] += int(n) + 1
                if size[odd] >= limit:
                    held[odd].append(tuple(x[start : k + 1] if isinstance(x, np.ndarray) else x.slice(start, k + 1 - start) for x in (ids, folds, texts, *about)))
                    start = k + 1
                    yield block(odd)
            if start < len(lengths):
                held[odd].append(tuple(x[start:] if isinstance(x, np.ndarray) else x.slice(start) for x in (ids, folds, texts, *about)))

        for batch in batches:
            folds = batch.column(1).to_numpy(zero_copy_only=False)
            texts = batch.column(2).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
            long = np.diff(offsets) > limit
            for odd in (0, 1):
                own = (folds == DELETED_FOLD) == bool(odd)
                rows = pa.array(np.flatnonzero(own & ~long))
                yield from add(odd, *(c.take(rows) for c in (batch.column(0), batch.column(1), texts)), *_whole(len(rows)))
                for k in np.flatnonzero(own & long).tolist():
                    raw = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[k] : offsets[k + 1]]
                    context = _END
                    for a, b in text_parts(raw, limit):
                        part = raw[a:b]
                        about = np.array([_BEGINS * (a == 0) | _ENDS * (b == len(raw))], np.uint8), np.array([(task << 32) + cut]), np.array([context], np.uint64)
                        yield from add(odd, batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([part.tobytes()], pa.large_binary()).cast(pa.large_string()), *about)
                        words = word_spans(part, np.array([0, len(part)]), NOT_SPACE)
                        context = words.hash[-1] if len(words.hash) else context
                    cut += 1
        for odd in (0, 1):
            if held[odd]:
                yield block(odd)

    return run


class _Block:
    """Tokens of a block and its distinct n-grams. A unigram's key is odd, a bigram's is even."""

    def __init__(self, row: dict, groups: int):
        n_bytes = row["n_bytes"].as_py()
        data = pa.decompress(row["packed"].as_buffer(), n_bytes, _CODEC) if n_bytes else b""
        data = np.frombuffer(data, np.uint8)
        offsets, self.fold, state, self.rows, contexts = (np.frombuffer(row[c].as_buffer(), t) for c, t in (("offsets", np.int64), ("folds", np.uint8), ("states", np.uint8), ("rows", np.int64), ("contexts", np.uint64)))
        words = word_spans(data, offsets, NOT_SPACE)
        data = None
        own = np.diff(words.first)
        ends = (state & _ENDS) > 0
        size = own + ends
        self.last = np.cumsum(size)  # behind each part's last token
        first = self.last - size
        tokens = np.full(int(self.last[-1]), _END, np.uint64)
        # A word moves on by the ends of the parts before its own.
        tokens[np.arange(len(words.hash)) + np.repeat(first - words.first[:-1], own)] = words.hash
        words = None
        self.some = np.flatnonzero(size)  # parts with tokens
        self.first = first[self.some]
        self.part = np.repeat(np.arange(len(size), dtype=np.int32), size)
        before = np.empty(len(tokens), np.uint64)
        before[1:] = tokens[:-1]
        before[self.first] = contexts[self.some]
        pair = mix((before * np.uint64(0x9E3779B97F4A7C15)) ^ (tokens + np.uint64(0x7F4A7C15)))
        n = len(tokens)
        # The context of a part may stand in another block only, so it is asked for too.
        both = np.concatenate((tokens | np.uint64(1), pair & ~np.uint64(1), contexts[self.some] | np.uint64(1)))
        tokens = before = pair = None
        self.keys, where = np.unique(both, return_inverse=True)
        both = None
        where = where.astype(np.int32)
        self.word, self.pair = where[:n], where[n : 2 * n]
        self.context = np.empty(n, np.int32)
        self.context[1:] = self.word[:-1]
        self.context[self.first] = where[2 * n :]
        group = ((self.keys >> np.uint64(1)) % np.uint64(groups)).astype(np.int32)
        self.order = np.argsort(group, kind="stable").astype(np.int32)  # by group, then by key
        self.groups, self.cuts = np.unique(group[self.order], return_index=True)

    def counts(self, fold_weight: np.ndarray) -> np.ndarray:
        """How often each key stands in the block, in parts with a weight of 1."""
        size = len(self.keys)
        taken = fold_weight.astype(bool)[self.fold][self.part]
        return np.bincount(self.word[taken], minlength=size) + np.bincount(self.pair[taken], minlength=size)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Rising 64-bit numbers as differences in as many bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps[1:].max()).bit_length() + 7) // 8) if len(steps) > 1 else 1
    body = np.ascontiguousarray(steps[1:]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + steps[:1].astype("<u8").tobytes() + body.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    width = blob[0]
    first = np.frombuffer(blob, "<u8", 1, 1)
    body = np.frombuffer(blob, np.uint8, -1, 9).reshape(-1, width)
    steps = np.zeros((len(body), 8), np.uint8)
    steps[:, :width] = body
    return np.cumsum(np.concatenate((first, steps.view("<u8").ravel())), dtype=np.uint64)


def pack_counts(*counts: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate(counts).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_counts(blob: bytes, n: int) -> list[np.ndarray]:
    raw = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T
    return list(np.ascontiguousarray(raw).view("<u8").ravel().astype(np.int64).reshape(n, -1))


# -- corpus counts -----------------------------------------------------------


def _ask(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number = batch.column("block")[k].as_py()
                own = _Block({c: batch.column(c)[k] for c in _PARTS}, groups)
                keys = own.keys[own.order]
                train = own.counts(np.array([1, 1, 0]))[own.order]
                deleted = own.counts(np.array([0, 1, 0]))[own.order]
                ends = [*own.cuts[1:].tolist(), len(keys)]
                blobs, counts = [], []
                for a, b in zip(own.cuts.tolist(), ends, strict=True):
                    blobs.append(pack_sorted(keys[a:b]))
                    counts.append(pack_counts(train[a:b], deleted[a:b]))
                columns = [pa.array(own.groups.astype(np.int64)), pa.array(np.full(len(blobs), number, np.int64)), pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())]
                own = keys = train = deleted = blobs = counts = None  # before the next block is built
                yield pa.RecordBatch.from_arrays(columns, names=["grp", "block", "ngrams", "counts"])

    return run


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of a group's n-grams, for each block that asked; the first row has the group's totals."""
    keys = [unpack_sorted(x) for x in asked["ngrams"]]
    distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
    each = [unpack_counts(x, 2) for x in asked["counts"]]
    train, deleted = (np.bincount(where, np.concatenate([x[k] for x in each]), len(distinct)).astype(np.int64) for k in (0, 1))
    cuts = np.cumsum([0, *map(len, keys)])
    replies = [pack_counts(train[w], deleted[w]) for w in (where[a:b] for a, b in zip(cuts, cuts[1:], strict=False))]
    word = (distinct & np.uint64(1)) == 1
    main = train - deleted
    totals = np.array([train[word].sum(), (train[word] > 0).sum(), main[word].sum(), (main[word] > 0).sum()], np.int64)
    out = asked[["grp", "block"]].assign(reply=replies)
    for k, name in enumerate(TOTALS):
        out[name] = 0
        out.loc[out.index[0], name] = totals[k]  # once for a group
    return out


# -- the model ---------------------------------------------------------------


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the count's whole binary logarithm."""
    return np.where(count > 0, np.frexp(count.astype(float))[1], 0)


def estimates(word: np.ndarray, pair: np.ndarray, context: np.ndarray, tokens: int, kinds: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Maximum-likelihood estimates after the context and alone, and the uniform one."""
    return pair / np.maximum(context, 1), word / max(tokens, 1), 1 / (kinds + 1)


def learn_weights(bucket: np.ndarray, n: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float) -> np.ndarray:
    """Weights (bucket, order 0..2) by expectation-maximisation on ``n`` held-out tokens of each kind; buckets without any use the rest's."""
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    parts = np.stack([np.full(len(p1), p0), p1, p2], 1)

    def fit(rows: np.ndarray) -> np.ndarray:
        w, likelihood = np.full(3, 1 / 3), -math.inf
        for _ in range(ROUNDS):
            mixed = parts[rows] * w
            total = mixed.sum(1)
            now = float((n[rows] * np.log(total)).sum())
            w = (mixed / total[:, None] * n[rows, None]).sum(0)
            w /= w.sum()
            if now - likelihood < TOLERANCE * abs(now):
                break
            likelihood = now
        return w

    if len(n):
        weights[:] = fit(np.arange(len(n)))
        for b in range(CONTEXT_BUCKETS):
            rows = np.flatnonzero(bucket == b)
            if len(rows):
                weights[b] = fit(rows)
    weights = np.maximum(weights, 1e-7)  # no estimate is ruled out
    weights[0, 2] = 0  # an unseen context has no estimate
    return weights / weights.sum(1, keepdims=True)


def _looked_up(batches: Iterator[pa.RecordBatch], groups: int):
    """(block's ids, _Block, corpus counts of its keys in training, of those deleted). The caller lets go of a block before it asks for the next."""
    for batch in batches:
        for k in range(batch.num_rows):
            own = _Block({c: batch.column(c)[k] for c in _PARTS}, groups)
            replies = batch.column("replies")[k].values  # structs (grp, reply) of this block
            order = np.argsort(replies.field("grp").to_numpy())
            assert replies.field("grp").to_numpy()[order].tolist() == own.groups.tolist()
            counts = [np.empty(len(own.keys), np.int64), np.empty(len(own.keys), np.int64)]
            cuts = [*own.cuts.tolist(), len(own.keys)]
            for j, at in enumerate(order.tolist()):
                to = own.order[cuts[j] : cuts[j + 1]]
                for one, got in zip(counts, unpack_counts(replies.field("reply")[at].as_buffer(), 2), strict=True):
                    one[to] = got
            ids = batch.column("ids")[k].values
            row = (ids, own, *counts)
            own = counts = one = got = replies = to = order = ids = None
            yield row
            row = None


def _gather(groups: int, tokens: int, kinds: int):
    """Held-out tokens, counted by bucket and binned estimates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for looked_up in _looked_up(batches, groups):
            _, own, train, deleted = looked_up
            looked_up = None
            main = train - deleted
            context = main[own.context]
            p2, p1, _ = estimates(main[own.word], main[own.pair], context, tokens, kinds)
            low = -2.0**15
            bins = [np.round(BINS * np.log2(p, out=np.full(len(p), low), where=p > 0)).astype(np.int64) for p in (p2, p1)]
            cells = np.stack([context_bucket(context).astype(np.int64), *bins], 1)
            distinct, where = np.unique(cells, axis=0, return_inverse=True)
            where = where.ravel()
            size = len(distinct)
            columns = [*(pa.array(distinct[:, k]) for k in range(3)), *(pa.array(np.bincount(where, w, size)) for w in (np.ones(len(where)), p2, p1))]
            own = train = deleted = main = context = p2 = p1 = bins = cells = distinct = where = None
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "bin2", "bin1", "n", "s2", "s1"])

    return run


def _score(groups: int, tokens: int, kinds: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for looked_up in _looked_up(batches, groups):
            ids, own, train, _ = looked_up
            looked_up = None
            word, context = train[own.word], train[own.context]
            p2, p1, p0 = estimates(word, train[own.pair], context, tokens, kinds)
            w = weights[context_bucket(context)]
            model = np.log10(w[:, 2] * p2 + w[:, 1] * p1 + w[:, 0] * p0)
            w = p2 = p1 = None
            base = np.log10((word + 0.5) / (tokens + 0.5 * (kinds + 1)))
            parts = len(own.last)
            sums = []
            for x in (np.ones(len(word), np.int64), (word > 0).astype(np.int64), base, model):
                one = np.zeros(parts, x.dtype)
                one[own.some] = np.add.reduceat(x, own.first) if len(x) else 0
                sums.append(one)
            columns = [ids, pa.array(own.fold == HELD_OUT), *map(pa.array, sums[:2]), pa.array(np.full(parts, tokens, np.int64)), *map(pa.array, sums[2:]), pa.array(own.rows)]
            own = train = word = context = model = base = None
            yield pa.RecordBatch.from_arrays(columns, names=[*_SCORES, "part_of"])

    return run


def score_documents(documents: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, group_ngrams: int = GROUP_NGRAMS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each document.

    ``held_out`` is a boolean column: such documents are scored but teach
    nothing. base_score is the add-half unigram score, score the model's log10
    probability of the text. A null or empty text is one end token. A null
    doc_id is scored like others (``held_out`` null: it teaches). An empty table
    gives no rows; without training documents all words are unknown. Rows that
    repeat are counted as often as they occur. Other columns are not read. A text
    longer than ``block_bytes`` is cut into parts whose scores are added up, so no
    text needs more memory than its bytes and a block.
    """
    spark = documents.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "language-model")
    out = F.coalesce(held_out, F.lit(False))
    deleted = F.pmod(F.xxhash64(F.col(f"`{doc_id}`").cast("string")), F.lit(DELETED)) == 0
    fold = F.when(out, HELD_OUT).when(deleted, DELETED_FOLD).otherwise(TRAIN)
    source = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), fold.cast("byte").alias("fold"), F.col(f"`{text}`").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    blocks = scratch.keep(source.mapInArrow(_blocks(block_bytes), f"block long, n_bytes long, ids array<{id_type}>, " + ", ".join(f"{c} binary" for c in _PARTS[1:])))
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    groups = max(1, math.ceil(total / 4 / group_ngrams))

    asked = blocks.mapInArrow(_ask(groups), "grp long, block long, ngrams binary, counts binary")
    replies = scratch.keep(asked.groupBy("grp").applyInPandas(_answer, "grp long, block long, reply binary, " + ", ".join(f"{c} long" for c in TOTALS)))
    tokens, kinds, main_tokens, main_kinds = (x or 0 for x in replies.agg(*(F.sum(c) for c in TOTALS)).first())

    def joined(odd: int | None) -> DataFrame:
        own, got = blocks, replies
        if odd is not None:
            own, got = own.where(F.col("block") % 2 == odd), got.where(F.col("block") % 2 == odd)
        got = got.groupBy("block").agg(F.collect_list(F.struct("grp", "reply")).alias("replies"))
        return own.join(got, "block").drop("block")

    cells = joined(1).mapInArrow(_gather(groups, main_tokens, main_kinds), "bucket long, bin2 long, bin1 long, n double, s2 double, s1 double")
    cells = cells.groupBy("bucket", "bin2", "bin1").agg(*(F.sum(c).alias(c) for c in ("n", "s2", "s1"))).toPandas()  # bounded by the number of bins
    cells = cells.sort_values(["bucket", "bin2", "bin1"])
    n = cells["n"].to_numpy()
    weights = learn_weights(cells["bucket"].to_numpy(), n, cells["s2"].to_numpy() / n, cells["s1"].to_numpy() / n, 1 / (main_kinds + 1))
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, part_of long"
    scored = scratch.keep(joined(None).mapInArrow(_score(groups, tokens, kinds, weights), schema))
    scratch.drop(blocks, replies)
    # Parts of long texts are added up; all other rows are whole already.
    first = [F.first(c).alias(c) for c in ("doc_id", "held_out", "train_tokens")]
    parts = scored.where("part_of >= 0").groupBy("part_of").agg(*first, *(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    return scored.where("part_of < 0").select(_SCORES).unionByName(parts.select(_SCORES))
