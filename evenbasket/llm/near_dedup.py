"""Near-duplicate detection: MinHash bands, odd sketches, exact confirmation, components.

1. One pass over the texts gives each document's set of word shingles as a
   128-bit fingerprint, MinHash band keys and an odd sketch (the MinHash
   samples folded into a parity bitmap).
2. Documents with equal sets form a class; from here on a class is one row, so
   thousands of copies cost nothing.
3. Every band bucket gives candidate pairs of its members with its leader. The
   population count of two sketches' XOR estimates their similarity; candidates
   that clearly miss the threshold go, the rest are confirmed on the full sets.
4. Confirmed links form components. Members of a bucket that are still in
   different components are paired wherever the rarest shingles of their sets
   leave a link possible, and go through the same two tests. So no link is
   skipped, while a group of near copies never meets as all its pairs.

With 32 bands of 6 samples, a pair at similarity 0.85 shares no bucket with a
probability of 3e-7, and the sketch loses it with a probability below 1e-7.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, add_columns
from evenbasket.llm.tokens import NOT_SPACE, chunks, mix, ngram_hashes, split_words

SHINGLE = 5
BANDS, ROWS = 32, 6
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512


class Near(NamedTuple):
    """What is a link: the threshold in percent, how far below it the sketch's estimate may be, and the bands of samples that find it."""

    threshold: int = 85
    slack: int = 17
    bands: int = BANDS
    rows: int = ROWS


#: A pair at similarity 0.80 shares no bucket with a probability of 2.8e-7, and the sketch loses it with less than 1e-7.
NEAR_80 = Near(80, 21, 38, 5)

#: A key of more rows than HOT_ROWS, and more than one in HOT_KEYS of all rows, is hot: there are fewer than HOT_KEYS of them.
HOT_ROWS, HOT_KEYS = 1000, 50_000

_RNG = np.random.default_rng(8128)
_MULTIPLIER = _RNG.integers(0, 2**31, SAMPLES, np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _RNG.integers(0, 2**32, SAMPLES, np.uint32)
_SAMPLE_SEED = _RNG.integers(0, 2**63, SAMPLES, np.uint64)
_BLOCK = 2048


def shingle_set(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of a text's word hashes; fewer words than ``size`` are one shingle."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    return np.unique(ngram_hashes(hashes, min(n, size)))


def minhash(shingles: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(samples, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), _BLOCK):
        np.minimum(least, ((x[None, k : k + _BLOCK] ^ _FLIP[:samples, None]) * _MULTIPLIER[:samples, None]).min(axis=1), out=least)
    return least


def band_keys(samples: np.ndarray, bands: int = BANDS) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in samples.reshape(bands, -1).T.astype(np.uint64):
        keys = mix(keys ^ column)
    return keys


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the (sample number, sample) pairs, as 64-bit words."""
    place = mix(samples.astype(np.uint64) ^ _SAMPLE_SEED[: len(samples)]) % np.uint64(SKETCH_BITS)
    odd = np.bincount(place.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def most_odd_bits(near: Near = Near()) -> int:
    """XOR population count up to which a pair stays a candidate: |A xor B| = -n/2 ln(1 - 2z/n)."""
    apart = 2 * near.bands * near.rows * (1 - (near.threshold - near.slack) / 100)
    return int(np.ceil(SKETCH_BITS / 2 * (1 - np.exp(-2 * apart / SKETCH_BITS))))


def _signer(near: Near):
    def make():
        def derive(column: pa.Array) -> list:
            n, low, high, bands, sketch = [], [], [], [], []
            none = np.zeros(0, np.int64)
            for row, to, data, offsets in chunks(column):
                words = split_words(data, offsets, NOT_SPACE)
                for k in range(to - row):
                    own = shingle_set(words.hash[words.first[k] : words.first[k + 1]])
                    n.append(len(own))
                    low.append(np.add.reduce(mix(own), dtype=np.uint64).view(np.int64) if len(own) else 0)
                    high.append(np.add.reduce(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64).view(np.int64) if len(own) else 0)
                    samples = minhash(own, near.bands * near.rows) if len(own) else None
                    bands.append(none if samples is None else band_keys(samples, near.bands).view(np.int64))
                    sketch.append(none if samples is None else odd_sketch(samples).view(np.int64))
            return [n, low, high, bands, sketch]

        return derive

    return make


def signatures(documents: DataFrame, keep: list[str], text: str = "text", near: Near = Near()) -> DataFrame:
    """``keep`` columns with n_shingles, set fingerprint (fp1, fp2), band keys and odd sketch; empty texts have none."""
    return add_columns(documents, text, keep, "n_shingles long, fp1 long, fp2 long, bands array<long>, sketch array<long>", _signer(near))


def _set_writer():
    def derive(column: pa.Array) -> list:
        out = []
        for row, to, data, offsets in chunks(column):
            words = split_words(data, offsets, NOT_SPACE)
            out += [shingle_set(words.hash[words.first[k] : words.first[k + 1]]).tobytes() for k in range(to - row)]
        return [out]

    return derive


def _confirmer(near: Near):
    def confirm(batches):
        """Pairs whose full sets are similar enough: 100 * intersection >= threshold * union."""
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= near.threshold * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _with_totals(rows: DataFrame, totals: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """``rows`` with the columns of ``totals``, a written table of one row a key (NULL for a key that isn't there).

    ``size`` of ``totals`` is how many of ``rows`` have the key. Hot keys are joined by broadcast, fewer than HOT_KEYS of
    them, and their rows go through the other keys' shuffle dealt by ``spread``, so no task gets a key's rows whole.
    """
    floor = max(HOT_ROWS, (totals.agg(F.sum(size)).first()[0] or 0) // HOT_KEYS)
    names = [c for c in totals.columns if c != key]
    hot = totals.where(F.col(size) > floor).select(key, *[F.col(c).alias(f"hot_{c}") for c in names])
    rest = totals.where(F.col(size) <= floor).select(F.col(key).alias("deal"), *[F.col(c).alias(f"rest_{c}") for c in names])
    marked = rows.join(F.broadcast(hot), key, "left")
    # a hot row may meet another key by its hash: what it has of its own counts
    is_hot = F.col(f"hot_{size}").isNotNull()
    dealt = marked.withColumn("deal", F.when(is_hot, F.xxhash64(spread)).otherwise(F.col(key)))
    found = [F.when(is_hot, F.col(f"hot_{c}")).otherwise(F.col(f"rest_{c}")).alias(c) for c in names]
    return dealt.join(rest, "deal", "left").select(*rows.columns, *found)


def _links(pairs: DataFrame, classes: DataFrame, sets: DataFrame, scratch: Scratch, near: Near) -> DataFrame:
    """Those of the distinct candidate ``pairs`` (a, b) that are links."""
    sketch = classes.select("cid", "sketch")
    alike = (
        pairs.join(sketch.select(F.col("cid").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(sketch.select(F.col("cid").alias("b"), F.col("sketch").alias("sb")), "b")
        .where(sum(F.bit_count(F.col("sa")[k].bitwiseXOR(F.col("sb")[k])) for k in range(SKETCH_BITS // 64)) <= most_odd_bits(near))
        .select("a", "b")
    )
    alike = alike.join(sets.select(F.col("cid").alias("a"), F.col("set").alias("set_a")), "a")
    alike = alike.join(sets.select(F.col("cid").alias("b"), F.col("set").alias("set_b")), "b")
    return scratch.keep(alike.select("a", "b", "set_a", "set_b").mapInArrow(_confirmer(near), "a long, b long"))


def _shingles(batches):
    for batch in batches:
        for cid, own in zip(batch.column("cid"), batch.column("set"), strict=True):
            own = np.frombuffer(own.as_buffer(), np.int64)
            n = len(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, cid.as_py())), pa.array(own), pa.array(np.full(n, n))], names=["cid", "shingle", "n"])


def _prefixes(sets: DataFrame, scratch: Scratch, threshold: int) -> DataFrame:
    """(cid, key, n, rank): the rarest shingles of each set, as many as two sets at the threshold must have one in common of.

    With all sets in one order of shingles, sets of similarity t share one of
    the first (1 - t) * size + 1; rarest first, edited copies of a text show
    their own edits there and meet almost nobody. No link is lost by it.
    """
    shingles = sets.mapInArrow(_shingles, "cid long, shingle long, n long")
    rarity = scratch.keep(shingles.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"))
    rank = F.row_number().over(Window.partitionBy("cid").orderBy("df", "shingle"))
    first = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    known = _with_totals(shingles, rarity, "shingle", "df", "cid").withColumn("df", F.coalesce("df", F.lit(1)))
    ranked = known.withColumn("rank", rank).where(F.col("rank") <= first)
    prefixes = scratch.keep(ranked.where("df > 1").select("cid", F.col("shingle").alias("key"), "n", "rank"))
    scratch.drop(rarity)
    return prefixes


def _cross_pairs(members: DataFrame, scratch: Scratch, threshold: int) -> DataFrame:
    """Distinct pairs (a > b) of different labels that share a key; members (cid, key, n, rank, label).

    Only what is outside a key's largest label is paired with the rest, so a
    group that is one component already costs nothing. A pair also needs room
    for the overlap of a link behind the ranks of the shared key: the first
    shared one has all of the overlap from there on, and later ones have less.
    The rows of a key meet in cells of at most about HOT_ROWS by HOT_ROWS.
    """
    sizes = members.groupBy("key", "label").agg(F.count("*").alias("size"))
    largest = F.max(F.struct("size", "label"))
    main = sizes.groupBy("key").agg(largest["label"].alias("main"), (F.sum("size") - largest["size"]).alias("others"), F.sum("size").alias("total"))
    main = scratch.keep(main.where("others > 0"))
    lots = [F.ceil(F.col(c) / HOT_ROWS).cast("long").alias(f"{c}_lots") for c in ("others", "total")]
    open_ = _with_totals(members, main, "key", "total", "cid").where("main IS NOT NULL").select("*", *lots)
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    one_of = lambda c: F.pmod(F.xxhash64("cid"), F.col(c))
    left = open_.where("label <> main").select(
        "key", F.col("cid").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("rank").alias("ra"), one_of("others_lots").alias("x"), all_of("total_lots").alias("y")
    )
    right = open_.select("key", F.col("cid").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("rank").alias("rb"), "main", all_of("others_lots").alias("x"), one_of("total_lots").alias("y"))
    room = 1 + F.least(F.col("na") - F.col("ra"), F.col("nb") - F.col("rb"))
    alike = (100 + threshold) * room >= threshold * (F.col("na") + F.col("nb"))
    pairs = left.join(right, ["key", "x", "y"]).where((F.col("la") != F.col("lb")) & ((F.col("lb") == F.col("main")) | (F.col("a") < F.col("b"))) & alike)
    pairs = scratch.keep(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    scratch.drop(main)
    return pairs


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(cid, label): the smallest cid reachable over ``links`` (a, b), for all their ends.

    Each round a label takes the least label around it and then that label's
    own label, so a chain shortens by halves; rounds end when nothing changes.
    """
    both = scratch.keep(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = scratch.keep(both.groupBy(F.col("a").alias("cid")).agg(F.min("b").alias("b")).select("cid", F.least("cid", "b").alias("label")))
    while True:
        around = both.join(labels.select(F.col("cid").alias("b"), F.col("label").alias("near")), "b").groupBy(F.col("a").alias("cid")).agg(F.min("near").alias("near"))
        hooked = labels.join(around, "cid").select("cid", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = labels.select(F.col("cid").alias("to"), F.col("label").alias("far"))
        after = scratch.keep(hooked.join(jump, "to").select("cid", F.least("to", "far").alias("label"), "was"))
        changed = after.where("label <> was").limit(1).count()
        scratch.drop(labels)
        labels = after
        if not changed:
            scratch.drop(both)
            return labels.select("cid", "label")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """Per row of ``documents``: doc_id, row key, n_shingles, component_id, kept.

    Words are runs without white space of the text with A-Z lower-cased. A
    document's set holds its distinct 5-word shingles, or its whole sequence if
    it has fewer words. Documents are linked if 100 * intersection >=
    ``near.threshold`` * union of their sets; component_id is the smallest doc_id reachable over
    links, and kept says that it is the document's own.

    Null or empty texts have an empty set, are linked with nothing and are
    kept. Rows that repeat a doc_id are rows of their own (equal ones get equal
    results). A null doc_id can't be a component's id unless no linked row has
    one; then it is null and the row is kept. ``text_key`` (xxhash64 of the
    text) tells rows with one doc_id apart. Other columns are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "near-dedup")
    source = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"))
    signed = scratch.keep(signatures(source, ["doc_id", "text_key"], near=near))
    full = signed.where("n_shingles > 0")
    grouped = full.groupBy("fp1", "fp2", "n_shingles").agg(
        F.min("doc_id").alias("least_id"), F.any_value(F.struct("doc_id", "text_key", "bands", "sketch")).alias("one")
    )
    classes = scratch.keep(grouped.select("fp1", "fp2", "n_shingles", "least_id", "one.*").withColumn("cid", F.monotonically_increasing_id()))

    member = classes.select("cid", F.explode("bands").alias("band"))
    shared = scratch.keep(member.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"))
    member = scratch.keep(_with_totals(member, shared, "band", "n", "cid").where("n IS NOT NULL"))
    scratch.drop(shared)
    # The leader is the member that shares buckets with most others: the text that near copies were made of.
    degree = member.groupBy("cid").agg(F.sum("n").alias("degree"))
    leaders = scratch.keep(member.join(degree, "cid").groupBy("band").agg(F.max(F.struct("degree", "cid"))["cid"].alias("leader"), F.count("*").alias("n")))
    buckets = scratch.keep(_with_totals(member.drop("n"), leaders, "band", "n", "cid").select("band", "cid", "leader"))
    scratch.drop(member, leaders)

    wanted = classes.join(buckets.select("cid").distinct(), "cid", "left_semi").select("cid", F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    texts = source.join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))).select("cid", "text")
    # Rows that repeat both doc_id and text bring a class more than once.
    sets = scratch.keep(add_columns(texts, "text", ["cid"], "set binary", _set_writer).dropDuplicates(["cid"]))

    stars = buckets.where("cid <> leader").select(F.greatest("cid", "leader").alias("a"), F.least("cid", "leader").alias("b"))
    stars = scratch.keep(stars.distinct())
    links = _links(stars, classes, sets, scratch, near)
    labels = components(links, scratch)

    # What the stars leave: members of one bucket in different components.
    labelled = scratch.keep(buckets.join(labels, "cid", "left").select("band", "cid", F.coalesce("label", "cid").alias("label")))
    mixed = scratch.keep(labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("n")).where("least <> most"))
    left = scratch.keep(_with_totals(labelled, mixed, "band", "n", "cid").where("n IS NOT NULL").select("cid", "label").distinct())
    scratch.drop(buckets, labelled, mixed)
    prefixes = _prefixes(sets.join(left, "cid", "left_semi"), scratch, near.threshold)
    pairs = _cross_pairs(prefixes.join(left, "cid"), scratch, near.threshold)
    scratch.drop(left, prefixes)
    more = _links(pairs.join(stars, ["a", "b"], "left_anti"), classes, sets, scratch, near)
    scratch.drop(sets, pairs, stars)
    labels = components(links.union(more), scratch)
    scratch.drop(links, more)

    of_class = classes.join(labels, "cid", "left").select("fp1", "fp2", "n_shingles", "least_id", F.coalesce("label", "cid").alias("label"))
    ids = of_class.groupBy("label").agg(F.min("least_id").alias("component_id"))
    final = scratch.keep(of_class.join(ids, "label").select("fp1", "fp2", "n_shingles", "component_id"))
    scratch.drop(classes)
    row = signed.select("doc_id", "text_key", "n_shingles", "fp1", "fp2")
    out = row.join(final, ["fp1", "fp2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "text_key", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", near: Near = Near()) -> DataFrame:
    """``documents`` with one row of each component: all its columns, rows that repeat doc_id and text once."""
    decided = near_duplicates(documents, doc_id=doc_id, text=text, near=near).where("kept").groupBy("doc_id", "text_key").agg(F.count("*").alias("n"))
    decided = Scratch(documents.sparkSession, "near-dedup-kept").keep(decided)
    key = [F.col(f"`{doc_id}`").eqNullSafe(F.col("__id")), F.xxhash64(F.col(f"`{text}`")) == F.col("__key")]
    decided = decided.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), "n")
    once = documents.join(decided.where("n = 1"), key, "left_semi")
    repeated = documents.join(decided.where("n > 1"), key, "left_semi").dropDuplicates([doc_id, text])
    return once.unionByName(repeated)
