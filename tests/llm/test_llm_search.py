"""Near-duplicates, decontamination, URL rules and chat formatting against plain versions."""

import hashlib
import math
import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from evenbasket.llm import near_dedup  # noqa: E402
from evenbasket.llm.chat import format_conversations, loss_text  # noqa: E402
from evenbasket.llm.decontamination import find_contamination  # noqa: E402
from evenbasket.llm.near_dedup import drop_near_duplicates, near_duplicates  # noqa: E402
from evenbasket.llm.queries import oracle_sql, queries  # noqa: E402
from evenbasket.llm.url_rules import apply_rules  # noqa: E402


def near_copies(n=60):
    rnd = random.Random(5)
    base = [f"word{i}" for i in range(160)]
    rows = list(enumerate(brute.TEXTS)) + [(0, brute.TEXTS[0]), (None, brute.TEXTS[1]), (None, None)]
    for k in range(n):
        own = list(base)
        for _ in range(rnd.randint(0, 6)):
            own[rnd.randrange(len(own))] = f"edit{rnd.randrange(40)}"
        rows.append((1000 - k, " ".join(own)))
    return rows


def test_components_match_all_pairs(spark):
    rows = near_copies()
    got = near_duplicates(brute.documents(spark, rows)).collect()
    want = [(i, *x, i == x[1]) for (i, _), x in zip(rows, brute.components(rows), strict=True)]
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted([(x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got], key=key) == sorted(want, key=key)


def test_components_with_hot_keys(spark, monkeypatch):
    """Every key of more than two rows takes the hot path, and pairs meet in cells of two by two."""
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 2)
    test_components_match_all_pairs(spark)


def test_hot_keys_get_their_totals(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "HOT_ROWS", 3)
    keys = [1] * 40 + [2] * 3 + [3] + [None]
    rows = spark.createDataFrame(list(enumerate(keys)), "cid long, key long")
    totals = rows.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    got = near_dedup._with_totals(rows, totals, "key", "size", "cid").collect()
    assert sorted((r.cid, r.size) for r in got) == [(k, keys.count(x) if x in (1, 2) else None) for k, x in enumerate(keys)]


def test_cross_pairs_match_all_pairs_of_a_key(spark, monkeypatch):
    """Cells change nothing: one key shared by a large label and many small ones, another by few."""
    from evenbasket.llm.tables import Scratch

    members = [(c, 7, 10, 1, 0 if c < 9 else c) for c in range(30)] + [(c, 8, 10, 2, c // 2) for c in range(20, 26)] + [(50, 9, 10, 1, 1)]
    want = set()
    for a in members:
        want |= {(max(a[0], b[0]), min(a[0], b[0])) for b in members if a[1] == b[1] and a[4] != b[4]}
    df = spark.createDataFrame(members, "cid long, key long, n long, rank int, label long")
    for cell in (1, 4, 1000):
        monkeypatch.setattr(near_dedup, "HOT_ROWS", cell)
        got = near_dedup._cross_pairs(df, Scratch(spark, "pairs"), 80).collect()
        assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_one_document_of_each_group_stays(spark):
    rows = near_copies()
    stay = drop_near_duplicates(brute.documents(spark, rows)).collect()
    want = {(i, t) for (i, t), (n, c) in zip(rows, brute.components(rows), strict=True) if i == c}
    assert len(stay) == len(want) and {(x.doc_id, x.text) for x in stay} == want


def test_odd_sketch_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    for similarity in (0.7, 0.85, 0.95):
        total = 4000
        common = int(similarity * total)
        own = (total - common) // 2
        x = rng.integers(0, 2**63, total, np.uint64)
        a, b = x[: common + own], np.concatenate((x[:common], x[common + own :]))
        z = sum(int(np.bitwise_count(p)) for p in near_dedup.odd_sketch(near_dedup.minhash(a)) ^ near_dedup.odd_sketch(near_dedup.minhash(b)))
        estimate = 1 + near_dedup.SKETCH_BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * z / near_dedup.SKETCH_BITS)
        assert abs(estimate - similarity) < 0.12


@pytest.mark.parametrize("near", [near_dedup.Near(), near_dedup.NEAR_80])
def test_sketch_hardly_loses_a_pair_at_the_threshold(near):
    """Exactly: m of the samples differ, and each flips two of the bits at random."""
    n, size, t = near.bands * near.rows, near_dedup.SKETCH_BITS, near.threshold / 100
    odd, at, loss = np.eye(1, size + 1)[0], np.arange(size + 1), 0.0
    for m in range(n + 1):
        loss += math.comb(n, m) * (1 - t) ** m * t ** (n - m) * odd[near_dedup.most_odd_bits(near) + 1 :].sum()
        for _ in range(2):
            odd = np.append(0, (odd * (1 - at / size))[:-1]) + np.append((odd * at / size)[1:], 0)
    assert loss < 1e-7


def test_near_dedup_of_an_empty_table(spark):
    assert near_duplicates(brute.documents(spark, [])).collect() == []


ITEMS = [
    (1, "four FIVE six seven eight, nine ten eleven twelve one two three"),
    (2, "short"),
    (None, "again and again"),
    (4, ""),
    (5, None),
    (11, "w100 w101 w102 w103 w104 w105 w106 w107 w108 w109 w110"),
    (3, "two three four five six seven eight nine ten eleven"),
]


@pytest.mark.parametrize("part_chars", [10**6, 40])
def test_contamination_matches_direct_search(spark, part_chars):
    rows = list(enumerate(brute.TEXTS)) + [(None, brute.TEXTS[0])]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = find_contamination(brute.documents(spark, rows).drop("n_words"), items, ["doc_id"], part_chars=part_chars).collect()
    key = lambda x: (x[0] is None, x[0] or 0)
    want = [(i, *brute.contamination(t, ITEMS)) for i, t in rows]
    assert sorted([(x.doc_id, x.n_words, x.n_hit, x["items"]) for x in got], key=key) == sorted(want, key=key)
    for x in got:
        assert x.n_items == len(x["items"]) and x.contaminated == (x.n_hit > 0)
        assert x.items_sha256 == hashlib.sha256(",".join(x["items"]).encode()).hexdigest()


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    got = find_contamination(brute.documents(spark), items, ["doc_id"]).collect()
    assert len(got) == len(brute.TEXTS) + 3 and not any(x.contaminated for x in got)
    assert find_contamination(brute.documents(spark, []), items, ["doc_id"]).count() == 0


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("example.net", "/en/x", "block"), ("Example.net", "/en/x", "allow"), ("a.example.net", "", "allow"), (None, "/", "block")]
URLS = [
    "http://a.example.net/en/", "https://EXAMPLE.net/en/x?y", "http://example.net", "http://foo.net/en/x", "x://b.example.com/de/1#f", "http://z.org/fr/", "http://z.org/fr",
    "nothing", None, "", "http://", "a://b://c/d", "http://exexample.net/en/", "http://example.net/en/\uffff", "http://example.net/en/😀", "http://example.net/en/xa", "http://b.a.example.net", "http://net./x", "http://..net/", "http://example.net:80/en/",
]


def judged(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = brute.lower(host)
    fits = [(len(a + b), len(a), a, b, v) for a, b, v in ((brute.lower(a), b, v) for a, b, v in RULES if a) if (host == a or host.endswith("." + a)) and path.startswith(b)]
    if not fits:
        return host, path, None, "allow"
    best = max(fits)
    return host, path, best[2] + best[3], best[4]


def test_rules_match_a_scan_of_all_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS * 2)] + [(None, URLS[0], "x")], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = apply_rules(pages, rules).collect()
    assert len(got) == len(URLS) * 2 + 1
    for x in got:
        assert (x.host, x.path, x.rule, x.verdict) == judged(x.url), x.url


def test_rules_on_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, URLS[0])], "page_id long, url string")
    assert [(x.rule, x.verdict) for x in apply_rules(pages, rules).collect()] == [(None, "allow")]
    assert apply_rules(pages.limit(0), rules).count() == 0


TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a</s>\n<s>user\nfoo"), (1, 2, "assistant", "x <\\s> <\\\\/s> [INST] [\\INST] [\\\\/INST]"),
    (2, 0, None, None), (2, None, "a\nb<s>%0A", "</s>"), (None, 3, "assistant", "😀<s"), (None, 3, "assistant", "/s>"),
    (3, 0, "assistant", "abc"), (3, 0, "assistant", "abc"), (3, 1, "assistant", ""), (3, 2, "assistant", "<|im_end|>" * 500), (4, 0, "", "plain [ < \\ text"),
]


def test_chat_round_trip(spark):
    given = spark.createDataFrame([(*r, 7) for r in TURNS], "conv_id long, turn long, role string, text string, turns long")
    got = format_conversations(given).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    assert {x.conv_id for x in got} == {1, 2, 3, 4, None} and len(got) == 5
    for x in got:
        own = sorted([r[1:] for r in TURNS if r[0] == x.conv_id], key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        want = [(r[1] or "", r[2] or "") for r in own]
        assert x.round_trip and [(t.role, t.text) for t in x.turns] == want
        assert x.loss == "".join(t for r, t in want if r == "assistant")
        assert all(r not in x.formatted[s.start : s.end] for s in x.loss_spans for r in ("<s>", "</s>", "[INST]"))
    plain = next(x for x in got if x.conv_id == 4)
    assert plain.formatted == "<s>\nplain [ < \\ text</s>\n"


def test_chat_of_an_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_queries_are_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("slice_urls", [7, 1000])
def test_deeply_nested_rules_match_a_scan_of_all(spark, slice_urls):
    """Hosts nested up to five deep and paths within paths, over few letters, in one slice and in many."""
    rnd = random.Random(slice_urls)
    host = lambda n: ".".join(rnd.choice(["a", "b", "ab", "|", "c-d"]) for _ in range(n))
    path = lambda n: "".join(rnd.choice(["/", "x", "é", "/y"]) for _ in range(n))
    rules = [(host(rnd.randint(1, 5)), path(rnd.randrange(5)), rnd.choice(["block", "allow"])) for _ in range(150)]
    hosts = [host(rnd.randint(1, 6)) for _ in range(60)] + [f"{host(2)}.{h}" for h, _, _ in rules[:40]]
    urls = [(k, f"http://{rnd.choice(hosts)}/{path(rnd.randrange(6))}") for k in range(300)]
    got = apply_rules(spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string"), slice_urls=slice_urls)
    best = {}
    for h, p, v in rules:
        best[h, p] = max(v, best.get((h, p), v))
    for r in got.collect():
        fits = [(len(h + p), len(h), h + p, v) for (h, p), v in best.items() if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        want = max(fits, default=(0, 0, None, "allow"))
        assert (r.rule, r.verdict) == want[2:] or [x[:2] for x in fits].count(want[:2]) > 1, (r, want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") >= 2 and "last(" in plan
