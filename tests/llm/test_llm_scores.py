"""PII, quality rules, packing, classifiers and language-model scores against plain versions or held-out rows."""

import math
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from evenbasket.llm import packing, pii, quality, quality_rules, toxicity  # noqa: E402
from evenbasket.llm.language_model import learn_weights, score_documents, unpack_sorted, pack_sorted  # noqa: E402
from evenbasket.llm.pii import find_spans, sanitise, span_list  # noqa: E402
from evenbasket.llm.quality_rules import judge_quality  # noqa: E402
from evenbasket.llm.queries import remainder  # noqa: E402
from evenbasket.llm.tables import TEXTS_OF_ID, Scratch, drawn_texts  # noqa: E402

SF = "/root/testdata/sf0.01"


def by_id(rows):
    return sorted(rows, key=lambda x: tuple((v is None, v if v is not None else 0) for v in x))


def stored(df, tmp_path):
    """As a table of files; a local relation is evaluated by the planner."""
    df.write.parquet(f"{tmp_path}/t")
    return df.sparkSession.read.parquet(f"{tmp_path}/t")


def test_base_spans_match_the_plain_patterns(spark, tmp_path):
    rnd = random.Random(3)
    rows = list(enumerate(brute.TEXTS + ["".join(rnd.choice("ab1 2.3@-+()%4😀\n") for _ in range(rnd.randint(1, 60))) for _ in range(400)] + ["9" * 50000, "a@b.c 1.2.3.4 " * 2000]))
    got = find_spans(stored(brute.documents(spark, [*rows, (None, brute.TEXTS[8])]), tmp_path)).select("doc_id", span_list(F.col("base")).alias("base")).collect()
    text = dict(rows) | {None: brute.TEXTS[8]}
    assert len(got) == len(rows) + 1
    assert all(x.base == brute.pii(text[x.doc_id]) for x in got)


def test_terms_that_give_an_entity_away(spark, tmp_path):
    rnd = random.Random(1)
    filler = ["table", "chair", "window", "garden", "river", "bridge", "forest", "market"]
    rows = [(i, f"{rnd.choice(filler)} {' '.join(rnd.choices(filler, k=12))} Zanzibarian wrote from boss@corp.example.com about {' '.join(rnd.choices(filler, k=12))}") for i in range(8)]
    rows += [(100 + i, " ".join(rnd.choices(filler, k=30))) for i in range(200)]
    docs = stored(brute.documents(spark, rows), tmp_path)
    got = {x.doc_id: x for x in find_spans(docs).collect()}
    for i, text in rows[:8]:
        values = {t.value for t in got[i].terms}
        assert "Zanzibarian" in values and not values & set(filler)
        assert all(text[t.start : t.end] == t.value for t in got[i].terms)
    assert not any(got[i].terms for i, _ in rows[8:])
    clean = {x.doc_id: x.text for x in sanitise(docs).collect()}
    assert all("Zanzibarian" not in clean[i] and "[EMAIL]" in clean[i] and "boss@" not in clean[i] for i, _ in rows[:8])
    assert all(clean[i] == text for i, text in rows[8:])


def test_terms_of_rare_entities(spark, tmp_path):
    rnd = random.Random(5)
    filler = ["table", "chair", "window", "garden", "river", "bridge", "forest", "market"]
    some = lambda: " ".join(rnd.choices(filler, k=14))
    # One number in two spellings, two addresses of one domain, and an address mentioned once.
    rows = [(0, f"{some()} Zanzibarian +44 20 7946 0958 {some()}"), (1, f"{some()} Zanzibarian +44-20-7946-0958 {some()}")]
    rows += [(2, f"{some()} Quixotic a@corp.example.com {some()}"), (3, f"{some()} Quixotic B@CORP.example.com {some()}"), (4, f"{some()} Xylophonist c@other.example.org {some()}")]
    rows += [(100 + i, some()) for i in range(3000)]
    got = {x.doc_id: {t.value for t in x.terms} for x in find_spans(stored(brute.documents(spark, rows), tmp_path)).collect()}
    assert [got[i] for i in range(5)] == [{"Zanzibarian"}, {"Zanzibarian"}, {"Quixotic"}, {"Quixotic"}, {"Xylophonist"}]
    assert not any(got[i] for i, _ in rows[5:])


def test_copies_are_one_context(spark, tmp_path):
    """Twenty copies tell no more than one text (a mark); eight different texts do (removed)."""
    rnd = random.Random(9)
    filler = ["table", "chair", "window", "garden", "river"]
    some = lambda: " ".join(rnd.choices(filler, k=20))
    rows = [(100 + i, some()) for i in range(50)]
    copies = [(i, f"{filler[0]} Quixotic boss@corp.example.com {filler[1]}") for i in range(20)]
    texts = [(i, f"{some()} Quixotic boss@corp.example.com {some()}") for i in range(8)]
    for own, want in ((copies[:1], "[TERM]"), (copies, "[TERM]"), (texts, "")):
        clean = {x.doc_id: x.text for x in sanitise(stored(brute.documents(spark, own + rows), tmp_path / str(len(own)))).collect()}
        assert all(f" {want} [EMAIL] " in clean[i] and "Quixotic" not in clean[i] for i, _ in own)


def corpus_with_entities(n, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefghijklm", k=1 + int(rnd.paretovariate(0.9)) % 5))
    entity = lambda: rnd.choice([f"u{rnd.randrange(9)}@mail.example.com", f"U{rnd.randrange(9)}@b{rnd.randrange(3)}.example.org", "+49 30 123 4567", "+49-30-1234567", "10.0.0.7", "010.0.0.7", "4111 1111 1111 1111"])
    text = lambda: " ".join(entity() if rnd.random() < 0.04 else word() for _ in range(rnd.randrange(70)))
    rows = [(i, text()) for i in range(n)]
    return rows + [(i, t) for i, t in rows[:5]] + [(9000 + i, rows[0][1]) for i in range(5)] + [(9900, None), (9901, "")]


@pytest.mark.parametrize("n", [16, 300])
def test_disclosures_match_a_plain_count(spark, tmp_path, n):
    rows = corpus_with_entities(n, n)
    docs = stored(brute.documents(spark, rows), tmp_path)
    based = pii.with_base_spans(docs.select(*pii._key("doc_id", "text"), F.col("text").alias("t")), "t")
    got = pii.disclosing_terms(pii.mentions_of(based), docs, Scratch(spark, "test")).collect()
    want = brute.disclosures(rows)
    assert len(got) == len(want) > 10 and {(r.entity, r.term) for r in got} == set(want)
    assert all(r.rest == pytest.approx(want[r.entity, r.term], abs=1e-9) for r in got)


def test_disclosure_does_not_depend_on_the_size_of_the_corpus(spark, tmp_path):
    """The same mentions among 20 and among 3,000 other documents, and a word that stands elsewhere too."""
    some = ["Quixotic plans a@x.example.com table chair", "river Quixotic b@x.example.com window"]
    for n in (20, 3000):
        rows = list(enumerate(some)) + [(100 + i, "table chair river window" + " plans plans" * (i % 2)) for i in range(n)]
        got = {r.doc_id: [t.value for t in r.terms] for r in find_spans(stored(brute.documents(spark, rows), tmp_path / str(n))).collect()}
        assert got[0] == got[1] == ["Quixotic"] and not any(got[i] for i, _ in rows[2:])


def test_sanitising_an_empty_table(spark):
    docs = brute.documents(spark, [])
    assert sanitise(docs).columns == docs.columns and sanitise(docs).count() == 0 and find_spans(docs).count() == 0


def test_sanitise_keeps_rows_columns_and_nulls(spark, tmp_path):
    docs = stored(brute.documents(spark), tmp_path)
    got = sanitise(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert got.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert all(brute.pii(x.text) == "" for x in got.collect())


def test_statistics_match(spark, tmp_path):
    rnd = random.Random(2)
    rows = list(enumerate(brute.TEXTS + [" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 80))) for _ in range(200)]))
    docs = stored(brute.documents(spark, [*rows, (None, None)]), tmp_path)
    text = dict(rows) | {None: None}
    got = judge_quality(docs, ["doc_id", "kept", "n_words", "rule"]).collect()
    assert got[0].__fields__[:3] == ["doc_id", "rule", "n_words"]
    assert len(got) == len(rows) + 1
    for x in got:
        n, *_, repeats = want = brute.statistics(text[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (n < 50 or 100 * repeats > 50 * n) and not (x.base_failed and x.kept)


def test_outliers_go_and_clean_texts_stay(spark, tmp_path):
    rnd = random.Random(4)
    clean = [(i, " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) for _ in range(rnd.randint(60, 400)))) for i in range(400)]
    junk = [(1000 + i, " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 8))) + "$$$" for _ in range(100))) for i in range(40)]
    kept = {x.doc_id for x in judge_quality(stored(brute.documents(spark, clean + junk), tmp_path), ["doc_id"]).where("kept").collect()}
    assert kept == {i for i, _ in clean}


def test_quality_rules_on_an_empty_table(spark):
    assert judge_quality(brute.documents(spark, []), ["doc_id", "kept"]).count() == 0


def plain_mcd(x):
    """Squared distances from the estimate of least determinant, by concentration steps in NumPy."""
    floors = np.diag([v**2 for v in quality_rules.FLOORS.values()])
    quantile = lambda v, q: np.sort(v)[max(math.ceil(q * len(v)) - 1, 0)]
    far = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    middle = np.array([quantile(v, 0.5) for v in x.T])
    spread = np.diag([(1.4826 * quantile(abs(v - m), 0.5)) ** 2 for v, m in zip(x.T, middle, strict=True)]) + floors
    starts = [(middle, spread), (np.array([quantile(v, 0.25) for v in x.T]), spread), (x.mean(0), np.cov(x.T, bias=True) + floors)]

    def step(m, c):
        d = far(m, c)
        near = x[d <= quantile(d, quality_rules.SUPPORT)]
        return near.mean(0), np.cov(near.T, bias=True) + floors

    for _ in range(quality_rules.FIRST_STEPS):
        starts = [step(*s) for s in starts]
    m, c = min(starts, key=lambda s: np.linalg.slogdet(s[1])[1])
    while True:
        after = step(m, c)
        if not np.linalg.slogdet(after[1])[1] < np.linalg.slogdet(c)[1] - quality_rules.FALL:
            d = far(m, c)
            return d / max(quantile(d, 0.5) / quality_rules.MEDIAN_CHI2, 1.0)
        m, c = after


def plain_vector(r):
    rate = lambda a, b: math.asin(math.sqrt(min(1.0, a / b)))
    return [math.log(r.word_chars / r.n_words), rate(r.n_symbols, r.word_chars), rate(r.n_dup_lines, r.n_lines + 10), rate(r.n_repeat_words, r.n_words), math.log(r.n_words)]


def odd_texts(n, seed, first=0):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdefgh", k=rnd.randint(2, 9))) + rnd.choice(["", "", "", "$", ""])
    out = []
    for i in range(n):
        words = [word() + "$$$" * (i % 25 == 24) for _ in range(rnd.randint(60, 300))]
        for _ in range(rnd.randrange(4)):
            k = rnd.randrange(len(words) - 4)
            words += words[k : k + 4]
        out.append((first + i, "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)) + "\nagain" * rnd.choice([0, 0, 0, 2, 9])))
    return out


@pytest.mark.parametrize("seed, lang", [(1, "en"), (2, None)])
def test_distances_are_those_of_a_plain_estimate(spark, tmp_path, seed, lang):
    rows = odd_texts(260, seed)
    docs = stored(brute.documents(spark, rows).withColumn("lang", F.lit(lang).cast("string")), tmp_path)
    got = judge_quality(docs, ["doc_id"]).where("NOT base_failed").collect()
    want = plain_mcd(np.array([plain_vector(r) for r in got]))
    assert np.allclose([r.distance for r in got], want, rtol=1e-6)
    assert 0 < sum(not r.kept for r in got) < 60 and all(r.kept == (r.distance <= quality_rules.CUTOFF) for r in got)


def test_small_groups_are_judged_by_their_language(spark, tmp_path):
    """A group of one text, of 199 and of 201: no size makes a difference by itself."""
    rows = odd_texts(400, 5)
    docs = brute.documents(spark, rows).withColumn("lang", F.lit("en"))
    found = []
    for n in (1, 199, 201, 400):
        own = docs.withColumn("source", F.when(F.col("doc_id") < n, "a").otherwise("b"))
        found.append({r.doc_id: r.distance for r in judge_quality(stored(own, tmp_path / str(n)), ["doc_id"]).where("NOT base_failed").collect()})
    near = [abs(found[1][i] - found[2][i]) / (1 + found[2][i]) for i in found[1]]
    assert max(near) < 0.2 and found[0].keys() == found[3].keys()
    assert abs(found[0][0] - found[3][0]) < 0.1 * (1 + found[3][0])


def test_mostly_repeated_lines_go_and_clean_texts_stay(spark, tmp_path):
    """A text of 230 lines, 199 of them copies of an earlier one, with 200 of its 440 words repeated."""
    rnd = random.Random(6)
    words = iter(f"w{k:06d}{'x' * rnd.randrange(5)}" for k in range(10**6))
    take = lambda n: " ".join(next(words) for _ in range(n))
    clean = [(i, "\n".join(take(rnd.randint(5, 12)) for _ in range(rnd.randint(8, 40)))) for i in range(300)]
    junk = [(1000, "\n".join([take(8) for _ in range(30)] + ["same"] * 200))]
    long = [(1001, "\n".join(take(12) for _ in range(2500))), (1002, "\n".join([take(10) for _ in range(20)] + ["one line twice"] * 2))]
    kept = {r.doc_id for r in judge_quality(stored(brute.documents(spark, clean + junk + long), tmp_path), ["doc_id"]).where("kept").collect()}
    assert kept == {i for i, _ in clean + long}


def test_many_groups_are_joined_in_slices(spark, tmp_path, monkeypatch):
    docs = stored(brute.documents(spark, odd_texts(120, 7)).withColumn("source", F.when(F.col("doc_id") < 20, F.col("doc_id").cast("string"))), tmp_path)
    want = {r.doc_id: r.distance for r in judge_quality(docs, ["doc_id"]).collect()}
    monkeypatch.setattr(quality_rules, "BROADCAST_GROUPS", 3)
    got = {r.doc_id: r.distance for r in judge_quality(docs, ["doc_id"]).collect()}
    assert got == {i: d if d is None else pytest.approx(d, rel=1e-9) for i, d in want.items()}


def test_chi_squared_quantiles():
    for beyond, degrees, x in ((0.5, 5, 4.35146), (0.05, 5, 11.0705), (1e-5, 5, 30.8562), (0.01, 1, 6.6349), (0.05, 9, 16.919)):
        assert quality_rules.chi_squared_quantile(beyond, degrees) == pytest.approx(x, rel=1e-4)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary_path())


def test_pieces_and_places(spark, tokenizer):
    packed = packing.pack_documents(brute.documents(spark), with_ids=True)
    got = packed.collect()
    rows = [(x.doc_id, x.text) for x in brute.documents(spark).collect()]
    want = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert by_id([tuple(x)[:5] for x in packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()]) == by_id(want)
    places = {}
    for x in got:
        places.setdefault(x.sequence_id, []).append((x.offset, x.length, x.ids))
    for parts in places.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    built = {x.sequence_id: x.ids for x in packing.sequences(packed).collect()}
    assert built == {k: [t for _, _, ids in sorted(v) for t in ids] for k, v in places.items()}


def test_best_fit_takes_the_tightest_bin():
    rnd = random.Random(6)
    lengths = sorted([rnd.randint(1, 100) for _ in range(500)], reverse=True)
    bins, offsets = packing.best_fit(lengths, 100)
    room = []
    for length, number, offset in zip(lengths, bins, offsets, strict=True):
        fits = [r for r in room if r >= length]
        if fits:
            assert room[number] == min(fits) and offset == 100 - room[number]
        else:
            assert number == len(room) and offset == 0
            room.append(100)
        room[number] -= length


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(brute.documents(spark, [])).count() == 0


def test_base_score_and_model(spark):
    rows = list(enumerate(brute.TEXTS)) + [(0, brute.TEXTS[0]), (None, None)]
    got = score_documents(brute.documents(spark, rows), remainder(5) == 1, block_bytes=300, group_ngrams=50).collect()
    want = brute.base_scores(rows, lambda i: brute.remainder(i, 5) == 1)
    assert len(got) == len(rows)
    key = lambda x: (x[0] is None, x[0] or 0)
    for x, (i, w) in zip(sorted(got, key=key), sorted([(i, w) for (i, _), w in zip(rows, want, strict=True)], key=key), strict=True):
        assert (x.doc_id, x.n_tokens, x.n_known, x.train_tokens, x.held_out) == (i, *w[:3], brute.remainder(i, 5) == 1)
        assert math.isclose(x.base_score, w[3], rel_tol=1e-9) and x.score < 0


def test_model_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = score_documents(docs, remainder(5) == 1).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_expectation_maximisation_finds_the_mixture():
    rng = np.random.default_rng(2)
    p2, p1, true = rng.dirichlet(np.ones(50)), rng.dirichlet(np.ones(50)), np.array([0.1, 0.3, 0.6])
    p0 = 1 / 50
    n = (true[0] * p0 + true[1] * p1 + true[2] * p2) * 1e6
    got = learn_weights(np.full(50, 3), n, p2, p1, p0)[3]
    assert np.allclose(got, true, atol=0.02)


def test_sorted_numbers_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 2, 1000):
        keys = np.unique(rng.integers(0, 2**63, n, np.uint64) * np.uint64(2))
        assert np.array_equal(unpack_sorted(pack_sorted(keys)), keys)


def test_language_model_on_an_empty_table(spark):
    assert score_documents(brute.documents(spark, []), remainder(5) == 1).count() == 0


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    weights = quality.train(docs, labels, "quality", remainder(5) != 0)
    scored = quality.score_quality(docs, weights, ["doc_id"]).where(remainder(5) == 0).join(labels, "doc_id")
    right, total = scored.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right >= 0.9 * total


def test_quality_of_odd_rows(spark):
    docs = brute.documents(spark).withColumn("predicted", F.lit("own"))
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 0), (2, None), (None, 1), (10, 0)], "doc_id long, quality int")
    weights = quality.train(docs, labels, "quality", F.lit(True))
    got = quality.score_quality(docs, weights, ["doc_id", "score", "predicted", "lang"]).collect()
    assert got[0].__fields__ == ["doc_id", "lang", "score", "predicted"]
    assert len(got) == docs.count() and all(0 <= x.score <= 1 for x in got)
    untrained = quality.train(docs, labels.limit(0), "quality", F.lit(True))
    assert not untrained.any() and quality.score_quality(docs.limit(0), untrained, ["doc_id"]).count() == 0


def test_an_id_that_repeats_teaches_a_few_texts(spark):
    """One id with 3,000 rows of 500 texts: as many rows as any other id's few, the same ones each time."""
    rows = [(1, f"text number {k % 500}") for k in range(3000)] + [(2, "one"), (2, "one"), (3, None), (3, ""), (4, "not drawn")]
    source = brute.documents(spark, rows).select(F.col("doc_id").alias("__id"), F.col("text").alias("__t"))
    drawn = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "__id long, __y int")
    got = [sorted((r["__id"], r["__t"] or "", r["__y"]) for r in drawn_texts(source.repartition(n), drawn).collect()) for n in (1, 7)]
    assert got[0] == got[1] and [sum(r[0] == i for r in got[0]) for i in (1, 2, 3, 4)] == [TEXTS_OF_ID, 1, 1, 0]


def test_updates_follow_the_regularised_leader():
    """Weights are those that minimise the sum of linearised losses, proximal terms and both penalties, one coordinate at a time."""
    rnd = np.random.default_rng(3)
    size = 6
    model, seen = quality.FollowTheLeader(size), []
    weights = np.zeros(size + 1)
    for _ in range(60):
        at = np.append(np.sort(rnd.choice(size, 3, replace=False)), size)
        x, y = np.append(rnd.random(3), 1.0), int(rnd.integers(2))
        p = 1 / (1 + math.exp(-float(weights[at] @ x)))
        seen.append((at, (p - y) * x, weights.copy()))
        model.learn(at, x, y)
        for i in range(size + 1):
            steps = [(g[at.tolist().index(i)], w[i]) for at, g, w in seen if i in at]
            if steps:
                g2 = np.cumsum([g * g for g, _ in steps])
                sigma = np.diff(np.sqrt(np.append(0, g2))) / quality.ALPHA
                linear = sum(g for g, _ in steps) - sum(s * w for s, (_, w) in zip(sigma, steps, strict=True))
                curve = quality.BETA / quality.ALPHA + quality.L2 + sigma.sum()
                l1 = 0 if i == size else quality.L1
                loss = lambda w, a=linear, b=curve, c=l1: a * w + b * w * w / 2 + c * abs(w)
                weights[i] = 0 if abs(linear) <= l1 else -(linear - math.copysign(l1, linear)) / curve
                assert all(loss(weights[i]) <= loss(weights[i] + d) for d in (-1e-3, 1e-3, -weights[i]))
        assert np.allclose(model.weights(np.arange(size + 1)), weights)


MODEL = toxicity.Model({"idiot$": 6.0, "stup": 6.0}, -2.0)


@pytest.mark.parametrize(
    ("text", "toxic"),
    [
        ("You are an idiot.", True),
        ("What a stupid idea", True),
        ("He is not an idiot.", False),
        ("She said he is an idiot.", False),
        ("He is not tall. You idiot.", True),
        ("I will kill you", True),
        ("I will not kill you", False),
        ("you, I will kill", False),
        ("they kill", False),
        ("idiotic", False),
        ("", False),
    ],
)
def test_clauses(text, toxic):
    reader, machine = toxicity.Reader(MODEL.arcs), toxicity.grammar()
    logit = MODEL.bias + sum(toxicity.clause_weights(text, reader, machine))
    assert (1 / (1 + math.exp(-logit)) >= 0.7) == toxic


def test_learned_arcs(spark, tmp_path):
    rnd = random.Random(9)
    names = ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        own = rnd.sample(names, 20)
        bad = i % 5 == 0
        if bad:
            own.insert(rnd.randrange(20), "zork" + rnd.choice(["a", "en", "ig", "heit", "um", "us"]))
        rows.append((i, " ".join(own)))
        labels.append((i, int(bad)))
    docs = stored(brute.documents(spark, rows).drop("score"), tmp_path)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 3 != 1)
    assert "zork" in model.arcs and all(a.startswith("zork") for a in model.arcs)
    got = {x.doc_id: x.predicted for x in toxicity.score_toxicity(docs, model, ["doc_id"]).collect()}
    assert got == dict(labels)


def test_texts_that_share_a_frequent_word_all_teach(spark, tmp_path):
    rnd = random.Random(11)
    names = ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(300)]
    frequent = min(("are", "the", "and", "of", "to", "in", "is", "it"), key=lambda w: spark.range(1).select(F.xxhash64(F.lit(w))).first()[0])
    # Each insult occurs in every tenth text, and all texts share a word of a low hash.
    rows = [(i, " ".join([frequent, *rnd.sample(names, 20), *(["zork"] if i % 10 == 0 else [])])) for i in range(400)]
    docs = brute.documents(spark, rows).drop("score")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    models = [toxicity.learn(stored(docs.repartition(k), tmp_path / str(k)), labels, F.lit(True)) for k in (1, 7)]
    assert "zork" in models[0].arcs and models[0] == models[1]


def test_copies_teach_once(spark, tmp_path):
    rnd = random.Random(12)
    names = ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(300)]
    rows = [(i, " ".join(rnd.sample(names, 20) + ["zork"] * (i % 5 == 0))) for i in range(400)]
    copied = " ".join(f"quux{k} vorbis{k}" for k in range(10))
    rows += [(1000 + i, copied) for i in range(100)]
    labels = spark.createDataFrame([(i, int(i >= 1000 or i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.learn(stored(brute.documents(spark, rows).drop("score").repartition(5), tmp_path), labels, F.lit(True))
    assert "zork" in model.arcs and not any(a.startswith(("quux", "vorb")) for a in model.arcs)


def test_toxicity_of_odd_rows(spark):
    docs = brute.documents(spark, [*enumerate(brute.TEXTS), (None, None), (77, "you are nice. " * 30_000 + "really")])
    none = toxicity.learn(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    got = toxicity.score_toxicity(docs, none, ["doc_id", "score", "rule"]).collect()
    assert got[0].__fields__ == ["doc_id", "rule", "score", "n_clauses", "predicted"]
    assert toxicity.score_toxicity(docs.limit(0), none, ["doc_id"]).count() == 0
    assert len(got) == docs.count() and all(x.predicted == 0 for x in got)
