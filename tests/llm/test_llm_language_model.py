"""Deleted interpolation against a plain version, and texts longer than a block."""

import math
import random
import sys
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from evenbasket.llm import language_model as lm  # noqa: E402
from evenbasket.llm.language_model import score_documents, text_parts  # noqa: E402
from evenbasket.llm.queries import remainder  # noqa: E402

END = None


def plain_em(cells):
    """Weights (uniform, word, pair) of cells (n, p2, p1, p0), as many rounds as the operator allows."""
    w, before = [1 / 3] * 3, -math.inf
    for _ in range(lm.ROUNDS):
        now, share = 0.0, [0.0] * 3
        for n, p2, p1, p0 in cells:
            mixed = [w[0] * p0, w[1] * p1, w[2] * p2]
            total = sum(mixed)
            now += n * math.log(total)
            share = [s + n * m / total for s, m in zip(share, mixed, strict=True)]
        w = [s / sum(share) for s in share]
        if now - before < lm.TOLERANCE * abs(now):
            break
        before = now
    return w


def plain_scores(rows, held_out, deleted):
    """log10 probability of each (id, text) row: pairs, words and a uniform estimate, mixed by the context's count."""
    tokens = [[*brute.words(t), END] for _, t in rows]
    pairs = lambda own: list(zip([END, *own], own, strict=False))

    def counts(use):
        words, both = Counter(), Counter()
        for k, own in enumerate(tokens):
            if use(k):
                words.update(own)
                both.update(pairs(own))
        return words, both, sum(words.values()), len(words)

    def parts(a, b, c):
        words, both, total, kinds = c
        return both[a, b] / max(words[a], 1), words[b] / max(total, 1), 1 / (kinds + 1)

    bucket = lambda n: math.frexp(n)[1] if n else 0
    main = counts(lambda k: not held_out[k] and not deleted[k])
    cells = defaultdict(list)
    for k, own in enumerate(tokens):
        if deleted[k] and not held_out[k]:
            for a, b in pairs(own):
                p2, p1, p0 = parts(a, b, main)
                at = [round(lm.BINS * math.log2(p)) if p else -(2**15) for p in (p2, p1)]
                cells[bucket(main[0][a]), *at].append((p2, p1, p0))
    mean = {c: (len(x), *(sum(p[j] for p in x) / len(x) for j in range(3))) for c, x in cells.items()}
    rest = plain_em(list(mean.values())) if mean else [1 / 3] * 3
    weights = {}
    for b in range(lm.CONTEXT_BUCKETS):
        own = [v for c, v in mean.items() if c[0] == b]
        w = [max(x, 1e-7) for x in (plain_em(own) if own else rest)]
        if b == 0:
            w[2] = 0
        weights[b] = [x / sum(w) for x in w]
    train = counts(lambda k: not held_out[k])
    out = []
    for own in tokens:
        score = 0.0
        for a, b in pairs(own):
            p2, p1, p0 = parts(a, b, train)
            w = weights[bucket(train[0][a])]
            score += math.log10(w[0] * p0 + w[1] * p1 + w[2] * p2)
        out.append(score)
    return out


def corpus(n=220):
    rnd = random.Random(8)
    words = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(400)]
    rows = [(k, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 60)))) for k in range(n)]
    return rows + [(None, "w1 w2 w3"), (7, rows[7][1]), (500, ""), (501, None), (502, "  \n "), (503, "W1 w1\tw1")]


@pytest.mark.parametrize("block_bytes, group_ngrams", [(4 << 20, 1 << 20), (700, 100), (40, 30)])
def test_scores_match_a_plain_interpolation(spark, block_bytes, group_ngrams):
    """Also with blocks shorter than most texts: parts carry their context and add up."""
    rows = corpus()
    folds = spark.createDataFrame(enumerate([i for i, _ in rows]), "k long, doc_id long")
    pick = F.coalesce(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(lm.DELETED)) == 0, F.lit(False))
    folds = sorted(folds.select("k", (remainder(5) == 1).alias("held"), pick.alias("deleted")).collect())
    held, deleted = [r.held for r in folds], [r.deleted for r in folds]
    want = plain_scores(rows, held, deleted)
    base = brute.base_scores(rows, lambda i: brute.remainder(i, 5) == 1)
    got = score_documents(brute.documents(spark, rows), remainder(5) == 1, block_bytes=block_bytes, group_ngrams=group_ngrams).collect()
    key = lambda r: (r[0] is None, r[0] or 0, round(r[-1], 4))
    wanted = sorted(((i, h, *b, s) for (i, _), h, b, s in zip(rows, held, base, want, strict=True)), key=key)
    assert len(got) == len(rows)
    for r, w in zip(sorted(map(tuple, got), key=key), wanted, strict=True):
        assert r[:5] == w[:5] and r[5:] == (pytest.approx(w[5], rel=1e-9), pytest.approx(w[6], rel=1e-6))


def test_parts_are_cut_behind_white_space():
    rnd = random.Random(1)
    for _ in range(300):
        raw = np.frombuffer("".join(rnd.choice("aé \n") for _ in range(rnd.randrange(60))).encode(), np.uint8)
        for limit in (1, 4, 9):
            parts = list(text_parts(raw, limit))
            assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == len(raw)
            assert sum((bytes(raw[a:b]).split() for a, b in parts), []) == bytes(raw).split()
            assert all(b - a <= limit or len(bytes(raw[a:b]).split()) <= 1 for a, b in parts)


def test_a_text_of_50_megabytes(spark):
    """In a corpus of which it is nearly all; it becomes parts of the size of a block."""
    words = " ".join(f"word{k % 5000}" for k in range(100_000))
    times = 50_000_000 // len(words) + 1
    table = spark.createDataFrame([(1, words), (2, words[:500]), (3, "other words")], "doc_id long, text string")
    table = table.withColumn("text", F.when(F.col("doc_id") == 1, F.repeat(F.concat("text", F.lit(" ")), times)).otherwise(F.col("text")))
    got = {r.doc_id: r for r in score_documents(table, F.col("doc_id") == 3).collect()}
    assert got[1].n_tokens == times * 100_000 + 1 and got[3].n_known == 1
    assert got[1].train_tokens == got[1].n_tokens + got[2].n_tokens
    assert got[1].base_score < got[1].score < 0 and not got[1].held_out


def test_a_block_takes_a_bounded_multiple_of_its_bytes():
    rnd = random.Random(2)
    raw = " ".join(f"{rnd.randrange(10**6)}" for _ in range(600_000)).encode()
    blobs = {"folds": np.zeros(1, np.uint8), "offsets": np.array([0, len(raw)]), "states": np.full(1, 3, np.uint8), "rows": np.full(1, -1), "contexts": np.full(1, lm._END)}
    row = {"n_bytes": pa.scalar(len(raw)), "packed": pa.scalar(pa.compress(raw, codec=lm._CODEC, asbytes=True), pa.binary())}
    row |= {k: pa.scalar(v.tobytes(), pa.binary()) for k, v in blobs.items()}
    lm._Block(row, 8)  # tables that stay
    tracemalloc.start()
    kept = lm._Block(row, 8)
    now, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(kept.keys) > 600_000
    assert now < 9 * len(raw) and peak < 34 * len(raw), (now / len(raw), peak / len(raw))
