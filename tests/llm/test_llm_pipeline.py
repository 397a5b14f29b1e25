"""The pipeline, stage by stage, against a plain version."""

import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from evenbasket.llm import packing  # noqa: E402
from evenbasket.llm.near_dedup import near_duplicates  # noqa: E402

def world():
    rnd = random.Random(11)
    names = ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        own = rnd.sample(names, 40)
        toxic = i % 5 == 0
        if toxic:
            own.insert(rnd.randrange(40), "zork" + rnd.choice(["a", "en", "ig", "heit"]))
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic)))
    items = [(1, " ".join(rnd.sample(names, 12))), (2, None)]
    rows += [(600 + k, rows[k][1]) for k in range(1, 20, 3)]  # copies
    rows += [(700, rows[1][1] + " " + items[0][1]), (701, f"{rows[2][1]} mail a{700}@b.example and 10.0.0.1 {rows[3][1]}"), (702, None), (703, ""), (704, " ".join(f"w{k}" for k in range(5000)))]
    return rows, labels, items


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    rows, labels, items = world()
    table = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    want = [(i, t) for i, t in rows if not re.search(r"\bzork", t or "")]
    want = [(i, t) for (i, t), (_, c) in zip(want, brute.components(want), strict=True) if i == c]
    want = [(i, t) for i, t in want if not brute.contamination(t, items)[1]]
    found = brute.disclosures(want)
    assert {t for _, t in found} >= {"mail", "and"}  # words that stand by these entities alone
    want = [(i, None if t is None else brute.redacted(t, found)) for i, t in want]
    assert {701, 702, 703, 704} <= {i for i, _ in want} and not {700, 601} & {i for i, _ in want}

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == corpus_pipeline.COLUMNS, name
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
    got = docs.collect()
    assert sorted((x.doc_id, x.text) for x in got if x.text) == sorted((i, t) for i, t in want if t)
    assert {x.doc_id for x in got} == {i for i, _ in want}
    assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in got)

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    pieces = []
    for i, text in want:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        pieces += [(i, k, at, len(ids[at : at + 4096]), zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), 4096))]
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(tuple(x)[:5] for x in out.collect()) == sorted(pieces)


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_copies_at_eighty_percent_go(spark, tmp_path):
    """104 words have 100 shingles; k other words at the end leave 100 - k of them: similarity (100 - k) / (100 + k)."""
    rows = []
    for g, k in enumerate((8, 11, 12)):  # 0.85, 0.80, 0.79
        words = [f"g{g}w{j}" for j in range(104)]
        rows += [(10 * g, " ".join(words)), (10 * g + 1, " ".join(words[: 104 - k] + [f"x{g}n{j}" for j in range(k)]))]
    table = [(i, t, "en", "src", len(t)) for i, t in rows]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()) == [0, 10, 20, 21]
    assert sorted(x.doc_id for x in near_duplicates(docs).where("kept").collect()) == [0, 10, 11, 20, 21]
