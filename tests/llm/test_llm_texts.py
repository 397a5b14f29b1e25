"""Periodic runs, piece encoding and fill-in-the-middle against plain versions."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from evenbasket.llm import fill_in_middle as fim  # noqa: E402
from evenbasket.llm import piece_tokenizer  # noqa: E402
from evenbasket.llm.periodic_runs import find_runs, periodic_runs  # noqa: E402
from evenbasket.llm.queries import queries  # noqa: E402
from evenbasket.llm.tokens import ALNUM, NOT_SPACE, mix, split_words, word_spans  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHES = ["doc_id", "lang", "n_words", "score", "kept", "rule"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, least=12):
    """All (start, length, smallest period), by comparing words q apart for each q."""
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rnd, size):
    words = [f"w{rnd.randrange(rnd.choice([1, 2, 3, 50]))}" for _ in range(rnd.randrange(size))]
    if words and rnd.random() < 0.6:
        a = rnd.randrange(len(words))
        p = 1 + (len(words) - a) // rnd.randint(2, 9)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_word_spans_are_those_of_split_words():
    rnd = random.Random(2)
    for _ in range(150):
        texts = ["".join(rnd.choice("aB7 \né") for _ in range(rnd.randrange(40))).encode() for _ in range(rnd.randint(1, 5))]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.cumsum([0, *map(len, texts)])
        for grammar in (NOT_SPACE, ALNUM):
            want = split_words(data, offsets, grammar)
            for section in (1, 3, 8, 1000):
                got = word_spans(data, offsets, grammar, section=section)
                assert all((getattr(got, name) == getattr(want, name)).all() for name in ("start", "end", "hash", "first"))


@pytest.mark.parametrize("least", [12, 7, 2])
def test_runs_match_comparing_all_periods(least):
    rnd = random.Random(least)
    for _ in range(150):
        docs = [repetitive(rnd, 90) for _ in range(rnd.randrange(5))]
        first = np.cumsum([0, *map(len, docs)])
        words = mix(np.array([zlib.crc32(w.encode()) for d in docs for w in d], np.uint64))
        got = periodic_runs(words, first, least)
        assert [got.get(k, []) for k in range(len(docs))] == [plain_runs(d, least) for d in docs]


def test_runs_of_words_without_overlaps_and_with_many():
    """Thue-Morse words hold no overlap; Fibonacci words hold runs everywhere; one word repeated is one run."""
    x, y = "a", "ab"
    while len(y) < 1500:
        x, y = y, y + x
    for word in ("".join("ab"[bin(i).count("1") % 2] for i in range(2048)), y, "a" * 3000):
        got = periodic_runs(mix(np.frombuffer(word.encode(), np.uint8).astype(np.uint64)), np.array([0, len(word)]))
        assert got.get(0, []) == plain_runs(word)


def test_find_runs_of_odd_rows(spark):
    block = " ".join(f"x{k}" for k in range(7))
    rows = list(enumerate([*brute.TEXTS, f"start {block}\n{block}\t{block} x0 end", "a " * 40, f"{block} z {block} {block} Z"])) + [(0, "b " * 30), (0, "b " * 30), (None, None)]
    got = find_runs(brute.documents(spark, rows), CLASHES).collect()
    assert got[0].__fields__ == ["doc_id", "lang", "score", "kept", "rule", "n_words", "runs", "collapsed"]
    want = []
    for i, t in rows:
        w = plain_words(t)
        runs = plain_runs(w)
        want.append((i, len(w), runs, plain_collapsed(w, runs)))
    key = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got], key=key) == sorted(want, key=key)
    assert find_runs(brute.documents(spark, []), CLASHES).collect() == []


def test_runs_of_a_very_long_text(spark):
    """Longer than several chunks: numbered words, then a block of 1,000 words over and over."""
    long = " ".join(f"n{k}" for k in range(200_000)) + " " + " ".join(f"p{k % 1000}" for k in range(300_500))
    got = find_runs(brute.documents(spark, [(1, long), (2, "short")]), ["doc_id"]).orderBy("doc_id").collect()
    assert [tuple(x) for x in got[0].runs] == [(200_000, 300_500, 1000)] and got[0].n_words == 500_500
    assert got[0].collapsed == " ".join(long.split()[:201_000]) and got[1].collapsed == "short"


def test_op11_matches_a_plain_version(spark):
    got = {r.doc_id: r for r in queries()["op11_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        w, h = plain_words(text), zlib.crc32(str(i).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        if n > 3000:
            continue  # quadratic; long texts are tested above
        runs, r = plain_runs(w), got[i]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best), i
        assert r.exponent_milli == (best[1] and 1000 * best[1] // best[2])
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)) and r.collapsed_sha256 == sha(plain_collapsed(w, runs))


# -- pieces --------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_tokenizer.vocabulary_path())


def test_pieces_are_those_of_merging_and_of_the_library(library):
    encoder, decoder = piece_tokenizer.load(piece_tokenizer.vocabulary_path())
    rnd = random.Random(4)
    pieces = [library.id_to_piece(k).replace("▁", " ") for k in range(library.get_piece_size())]
    texts = [t or "" for t in brute.TEXTS] + ["▁▁ a  ", "\n\n", "\x00", "<0x0A><unk></s>", "😀👍🏽", "   " * 50, "er" * 300]
    for _ in range(2500):
        texts.append("".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 7))))
        texts.append("".join(rnd.choice("  ▁aeinrst.,\n\té你0011ß😀") for _ in range(rnd.randrange(25))))
    for text in texts:
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode(text) and decoder.decode(ids) == library.decode(ids.tolist())
        if len(text) < 40:
            assert encoder.backtracked(" x" + text) == encoder.merged(" x" + text)


def test_any_ids_decode_as_in_the_library(library, spark):
    _, decoder = piece_tokenizer.load(piece_tokenizer.vocabulary_path())
    rnd = random.Random(5)
    rows = [[rnd.choice([rnd.randrange(300), rnd.randrange(32000)]) for _ in range(rnd.randrange(9))] for _ in range(1500)]
    assert [decoder.decode(np.array(x, int)) for x in rows] == [library.decode(x) for x in rows]
    table = spark.createDataFrame([(k, x, "own") for k, x in enumerate([*rows[:50], None, []])], "doc_id long, ids array<int>, decoded string")
    got = piece_tokenizer.decode_ids(table, ["doc_id", "decoded"]).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == [library.decode(x) for x in rows[:50]] + ["", ""]


def test_a_vocabulary_with_spaces_inside_pieces_and_no_bytes():
    """Neither cut at spaces nor spelled in bytes; scores that a later merge exceeds, and equal ones."""
    scores = {"▁": -9.0, "a": -9.0, "b": -9.0, "c": -9.0, "ab": -5.0, "b▁": -1.0, "bc": -5.0, "ab▁": -7.0, "b▁a": -0.5, "ca": -5.0, "aa": -3.0, "aaa": -1.0, "aaaa": -8.0, "zq": -1.0}
    pieces = piece_tokenizer.Pieces(scores, {}, {p: k + 1 for k, p in enumerate(scores)}, 0)
    rnd = random.Random(6)
    for _ in range(1500):
        text = "".join(rnd.choice("aaabbc d") for _ in range(rnd.randrange(1, 25)))
        merged = pieces.merged("▁" + text.replace(" ", "▁"))
        assert [p for s in pieces.segments.findall("▁" + text.replace(" ", "▁")) for p in pieces.backtracked(s)] == merged
    assert pieces.encode("ddd").tolist() == [1, 0]


def test_long_texts_are_encoded_in_sections(library, monkeypatch):
    encoder, _ = piece_tokenizer.load(piece_tokenizer.vocabulary_path())
    monkeypatch.setattr(piece_tokenizer, "SECTION", 700)
    for text in (" ".join(f"wort{k}, naïve\n" for k in range(900)), "x" * 5000, " " * 4000 + "y", "ab  " * 2000, "é" * 1500 + " z" * 900):
        assert encoder.encode(text).tolist() == library.encode(text)


def test_encode_texts_of_odd_rows(spark, library):
    rows = list(enumerate([*brute.TEXTS, "x" * 400_000, "many words " * 150_000])) + [(0, brute.TEXTS[0]), (0, "other"), (None, None)]
    got = piece_tokenizer.encode_texts(brute.documents(spark, rows), [*CLASHES, "n_chars"]).collect()
    key = lambda x: (x[0] is None, x[0] or 0, len(x[1]))
    want = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in rows]
    assert sorted([(r.doc_id, r.ids, r.decoded) for r in got], key=key) == sorted(want, key=key)
    clash = brute.documents(spark, rows[:3]).withColumn("ids", F.lit("own"))
    assert piece_tokenizer.encode_texts(clash, ["doc_id", "ids"]).columns == ["doc_id", "ids", "decoded"]
    assert piece_tokenizer.encode_texts(brute.documents(spark, []), ["doc_id"]).collect() == []


def test_op12_matches_the_library(spark, library):
    got = {r.doc_id: r for r in queries()["op12_piece_tokenizer"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode(text or "")
        assert tuple(got[i])[1:] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


# -- fill in the middle --------------------------------------------------------

FIM_TEXTS = ["", None, "one line", "one\n", "\n", "\n\n\nx", "a\nb\nc\nd\ne\n", "é\n你好\n😀👍🏽 z\nend", "has <P> in it\nx", "<M>", "<S\n>", "<\n<\n<", "P>\n<S\nM>", "\r\n\r\n", "😀" * 50, "x" * 300_000 + "\n" + "é\n" * 900_000]


def plain_fim(doc_id, text, unit="line", transformed=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    x, y = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h3 % 100 >= transformed:
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, transformed", [("line", 100), ("char", 60)])
def test_fill_in_middle_matches_a_plain_version_and_comes_back(spark, unit, transformed):
    rows = [(100 * k + j, t) for j, t in enumerate(FIM_TEXTS) for k in range(4 if len(t or "") < 1000 else 1)] + [(0, "again\nand"), (0, "again\nand"), (None, "no\nid"), (None, None)]
    made = fim.fill_in_middle(brute.documents(spark, rows).withColumn("form", F.lit(1)), ["doc_id", "form", "lang"], unit=unit, transformed=transformed)
    assert made.columns == ["doc_id", "lang", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = [(i, *plain_fim(i, t, unit, transformed), t or "") for i, t in rows]
    key = lambda x: (x[0] is None, x[0] or 0, x[-1])
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got], key=key) == sorted(want, key=key)


def test_fill_in_middle_of_an_empty_table(spark):
    assert fim.fill_in_middle(brute.documents(spark, []), CLASHES).collect() == []


def test_exception_index_converts_both_ways():
    text = "aé你😀b\nzß" * 30 + "plain" * 20
    raw = np.frombuffer(text.encode(), np.uint8)
    index = fim.ExceptionIndex(raw)
    chars = np.arange(len(text) + 1)
    places = np.array([len(text[:k].encode()) for k in chars])
    assert (index.bytes(chars) == places).all() and (index.chars(places) == chars).all()
    assert len(index.at) == sum(ord(c) > 127 for c in text)
