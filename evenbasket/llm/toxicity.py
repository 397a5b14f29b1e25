"""Toxicity by a weighted finite-state grammar over clauses.

Words are read into classes: insult (with a weight), threat, target, negation,
reported speech, other. Small transducers rewrite a clause's class sequence:
negation and reported speech change what they govern, and the insult and threat
grammar pairs what is left with a target. They are composed once into a single
deterministic machine, whose arcs give the matched events; a clause's weight is
the sum of its events, and a text's score the logistic of its clauses' weights.

The insult acceptor's arcs (whole words and beginnings of words, so that
inflected forms are accepted) and their weights are learned from labelled rows:
a beginning becomes an arc if its share of toxic documents can't be chance.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch, add_columns, drawn_texts, ship_package

#: Labelled rows from which arcs are learned, drawn by a hash of the id.
SAMPLE_ROWS = 8_000
#: Beginnings of words that may be arcs (characters), the least toxic share, the chance of any false arc, the most arcs.
SHORTEST, LONGEST, LEAST_SHARE, FALSE_ARCS, MOST_ARCS = 4, 10, 0.8, 0.01, 20_000
KEPT_WORDS = 400_000
#: Least hashes of word triples that copies of a text have in common.
LEAST_HASHES = 3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
#: Fixed word lists of the closed classes, by language (en, de, fr, es).
TARGETS = "you your yours yourself u ur he she they them him her those these du dich dir dein deine ihr euch er sie tu te toi ton ta vous votre il elle ils elles ti vosotros usted ustedes ellos ellas".split()
NEGATIONS = "not never no nobody isn't aren't wasn't nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún ninguna".split()
REPORTS = "said says say called calls wrote writes claimed claims quoted sagte sagt nannte schrieb behauptet dit disait écrit appelle dijo dice llamó escribió".split()
THREATS = "kill hurt destroy murder beat burn shoot töten umbringen schlagen vernichten tuer frapper détruire brûler matar golpear destruir quemar".split()

#: Weight of an event, as a share of the insult arc's (or of ``THREAT_WEIGHT``).
PLAIN, DIRECTED, NEGATED, REPORTED = 1.0, 1.25, 0.2, 0.35
THREAT_WEIGHT, THREAT_ALONE = 6.0, 0.25
#: Words that a negation governs, and words between an insult or threat and its target.
SCOPE, REACH = 2, 3


# -- transducers -------------------------------------------------------------


class Transducer(NamedTuple):
    """Deterministic: arcs[state, symbol] = (next state, output symbol); state 0 starts a clause."""

    arcs: dict[tuple[object, object], tuple[object, object]]


def negation_transducer(symbols: list) -> Transducer:
    """Marks insults and threats among the ``SCOPE`` words after a negation as (symbol, 'negated')."""
    arcs = {}
    for state, symbol in product(range(SCOPE + 1), symbols):
        if symbol == NEGATION:
            arcs[state, symbol] = (SCOPE, symbol)
        elif symbol in (INSULT, THREAT):
            arcs[state, symbol] = (0, (symbol, "negated") if state else symbol)
        else:
            arcs[state, symbol] = (max(state - 1, 0), symbol)
    return Transducer(arcs)


def report_transducer(symbols: list) -> Transducer:
    """Marks insults and threats after a verb of saying or a quotation mark as (symbol, 'reported')."""
    arcs = {}
    for state, symbol in product((0, 1), symbols):
        marked = (symbol, "reported") if state and symbol in (INSULT, THREAT) else symbol
        arcs[state, symbol] = (1 if symbol == REPORT else state, marked)
    return Transducer(arcs)


def event_transducer(symbols: list) -> Transducer:
    """Pairs insults with a target at most ``REACH`` words before them, threats with one as near behind; outputs (class, factor) events or None.

    A state holds how far a target behind, and a threat waiting for its target, still reach.
    """
    factor = {"negated": NEGATED, "reported": REPORTED}
    arcs = {}
    for target, threat, symbol in product(range(REACH + 1), range(REACH + 1), symbols):
        rest, event = (max(target - 1, 0), max(threat - 1, 0)), None
        if symbol == TARGET:
            rest = (REACH, 0)
            event = (THREAT, DIRECTED - THREAT_ALONE) if threat else None
        elif isinstance(symbol, tuple):
            event = (symbol[0], factor[symbol[1]] * (THREAT_ALONE if symbol[0] == THREAT else 1))
        elif symbol == INSULT:
            event = (INSULT, DIRECTED if target else PLAIN)
        elif symbol == THREAT:
            rest, event = (rest[0], REACH), (THREAT, THREAT_ALONE)
        arcs[(target, threat), symbol] = (rest, event)
    # The composition starts every machine in state 0.
    number = {(0, 0): 0} | {(i, j): 1 + i * (REACH + 1) + j for i in range(REACH + 1) for j in range(REACH + 1) if (i, j) != (0, 0)}
    return Transducer({(number[state], symbol): (number[to], event) for (state, symbol), (to, event) in arcs.items()})


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that feeds the outputs of ``first`` to ``second``; its reachable states are numbered."""
    symbols = {s for _, s in first.arcs}
    number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            a, passed = first.arcs[state[0], symbol]
            b, out = second.arcs[state[1], passed]
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            arcs[number[state], symbol] = (number[a, b], out)
    return Transducer(arcs)


def grammar() -> Transducer:
    read = [OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT]
    negated = [(INSULT, "negated"), (THREAT, "negated")]
    reported = [(INSULT, "reported"), (THREAT, "reported")]
    return compose(compose(negation_transducer(read), report_transducer(read + negated)), event_transducer(read + negated + reported))


# -- reading words -----------------------------------------------------------

_CORE = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_CLOSED = {w: kind for kind, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)) for w in words}


class Reader(dict):
    """Classes of raw words: a tuple of (class, weight) steps and whether a clause ends after the word; None for plain words."""

    def __init__(self, arcs: dict[str, float]):
        super().__init__()
        self.exact = {a[:-1]: w for a, w in arcs.items() if a.endswith("$")}
        self.begin = {a: w for a, w in arcs.items() if not a.endswith("$")}

    def insult(self, word: str) -> float | None:
        if word in self.exact:
            return self.exact[word]
        return next((self.begin[word[:n]] for n in range(SHORTEST, min(len(word), LONGEST) + 1) if word[:n] in self.begin), None)

    def __missing__(self, raw: str):
        if len(self) > KEPT_WORDS:
            self.clear()
        steps = [(REPORT, 0.0)] if raw[0] in "\"'“„«‚" and len(raw) > 1 else []
        for word in _CORE.findall(raw):
            weight = self.insult(word)
            if weight is not None:
                steps.append((INSULT, weight))
            else:
                steps.append((_CLOSED.get(word, OTHER), THREAT_WEIGHT))
        ends = raw[-1] in ".!?;:,"
        plain = not ends and all(kind == OTHER for kind, _ in steps)
        self[raw] = value = None if plain and len(steps) == 1 else (tuple(steps), ends)
        return value


def clause_weights(text: str, reader: Reader, machine: Transducer) -> list[float]:
    """Weights of the clauses of ``text`` in which the grammar matches something."""
    read = [reader[raw] for raw in text.lower().split()]
    if not any(x is not None and any(kind in (INSULT, THREAT) for kind, _ in x[0]) for x in set(read)):
        return []
    out, state, total = [], 0, 0.0
    for x in read:
        if x is None:
            state, _ = machine.arcs[state, OTHER]
            continue
        for kind, weight in x[0]:
            state, event = machine.arcs[state, kind]
            if event is not None:
                total += event[1] * weight
        if x[1]:
            if total:
                out.append(total)
            state, total = 0, 0.0
    return out + [total] * bool(total)


# -- learning ----------------------------------------------------------------


class Model(NamedTuple):
    arcs: dict[str, float]
    bias: float


def _count_arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate arcs of (label, words, group) rows: the toxic and all documents of a task that have them, and (t, n) = (largest label, 1) for each group of copies."""
    toxic, every, copies = Counter(), Counter(), {}
    for batch in batches:
        for y, words, group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = set(words or ())
            arcs = {w + "$" for w in words}
            arcs |= {w[:n] for w in words for n in range(SHORTEST, min(len(w), LONGEST) + 1)}
            if group is not None:
                own = copies.setdefault(group, {})
                own.update((a, max(y, own.get(a, 0))) for a in arcs)
                continue
            every.update(arcs)
            if y:
                toxic.update(arcs)
    for group, names in [(None, list(every)), *((g, list(own)) for g, own in copies.items())]:
        for k in range(0, len(names), 10_000):
            part = names[k : k + 10_000]
            t, n = ([toxic[a] for a in part], [every[a] for a in part]) if group is None else ([copies[group][a] for a in part], [1] * len(part))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([group] * len(part), pa.string()), pa.array(t, pa.int64()), pa.array(n, pa.int64())], names=["arc", "group", "t", "n"])


def copy_group(words: Column) -> Column:
    """What copies of a text have in common and other texts hardly ever: its ``LEAST_HASHES`` least word triples by hash (of a shorter text: all words)."""
    n = F.size(words)
    triples = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    least = F.slice(F.array_sort(F.array_distinct(F.slice(triples, F.lit(1), F.greatest(n - 2, F.lit(1))))), F.lit(1), F.lit(LEAST_HASHES))
    return F.concat_ws(" ", F.transform(least, lambda h: h.cast("string")))


def learn(documents: DataFrame, labels: DataFrame, learns, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """The insult acceptor, learned where ``learns`` (a boolean column of ``documents``) holds.

    Copies and near copies would pass as evidence of their own, so a candidate
    counts once in each ``copy_group``, as toxic if any of its documents is; all
    distinct texts count. An arc needs a toxic share that, by
    Chernoff's bound over all candidates, chance gives with probability
    ``FALSE_ARCS`` at most; its weight is the smoothed log-odds against the
    base rate. Rows without label (or with a null one) teach nothing; an id
    with several labels has the largest, and one with several texts teaches a few of
    them, once each (``drawn_texts``). An empty table teaches nothing. Other
    columns, whatever their names, are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "toxicity")
    label = labels.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("y")).where("y IS NOT NULL")
    source = documents.where(learns).select(F.col(f"`{doc_id}`").alias("__id"), F.col(f"`{text}`").alias("__t"))
    labelled = label.join(source.select("__id").distinct(), "__id").withColumn("__order", F.xxhash64(F.col("__id").cast("string")))
    drawn = scratch.keep(labelled.orderBy("__order", "__id").limit(sample_rows))
    total, toxic = drawn.agg(F.count("*"), F.sum("y")).first()
    if not total or not toxic or toxic == total:
        return Model({}, -2.0)

    words = F.regexp_extract_all(F.lower(F.coalesce("__t", F.lit(""))), F.lit(r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"), F.lit(0))
    rows = drawn_texts(source, drawn.select("__id", "y")).select("y", words.alias("words"))
    rows = scratch.keep(rows.select("y", F.array_distinct("words").alias("words"), copy_group(F.col("words")).alias("group")))
    shared = rows.groupBy("group").agg(F.count("*").alias("size")).where("size > 1").select("group", F.lit(True).alias("copied"))
    marked = rows.join(F.broadcast(shared), "group", "left").select("y", "words", F.when(F.col("copied"), F.col("group")).alias("group"))
    counted = marked.mapInArrow(_count_arcs, "arc string, group string, t long, n long")
    # A group's copies may be in several tasks; null groups are sums already.
    once = counted.groupBy("arc", "group").agg(F.when(F.col("group").isNull(), F.sum("t")).otherwise(F.max("t")).alias("t"), F.when(F.col("group").isNull(), F.sum("n")).otherwise(F.lit(1)).alias("n"))
    arcs = scratch.keep(once.groupBy("arc").agg(F.sum("t").alias("t"), F.sum("n").alias("n")).where("n >= 3"))
    scratch.drop(rows)
    base = arcs.agg(F.sum("t") / F.sum("n")).first()[0]
    if not base or base >= 1:
        return Model({}, -2.0)
    bar = math.log(max(1, arcs.count()) / FALSE_ARCS)
    share = F.col("t") / F.col("n")
    clean = 1 - share
    divergence = share * F.log(share / base) + F.when(clean > 0, clean * F.log(clean / (1 - base))).otherwise(0.0)
    chosen = arcs.where((share >= max(LEAST_SHARE, base)) & (F.col("n") * divergence >= bar))
    weight = F.log((F.col("t") + 0.5) / (F.col("n") - F.col("t") + 0.5)) - math.log(base / (1 - base))
    got = chosen.select("arc", weight.alias("weight")).orderBy(F.desc("weight"), "arc").limit(MOST_ARCS).collect()  # bounded by MOST_ARCS
    return Model({r[0]: r[1] for r in got}, math.log(toxic / (total - toxic)))


# -- scoring -----------------------------------------------------------------


def _scorer(shared):
    def make():
        model = shared.value
        reader, machine = Reader(model["arcs"]), grammar()

        def derive(column: pa.Array) -> list:
            logits, clauses = [], []
            for text in column:
                found = clause_weights(text.as_py() or "", reader, machine)
                logits.append(model["bias"] + sum(found))
                clauses.append(len(found))
            return [1 / (1 + np.exp(-np.clip(np.array(logits, float), -35, 35))), clauses]

        return derive

    return make


def score_toxicity(documents: DataFrame, model: Model, keep: list[str], text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``keep`` columns with score (0 to 1), n_clauses (matched ones) and predicted (score >= threshold).

    One pass, no shuffle. A text without a match (null and empty ones too) has
    the base rate as its score. Texts are read whole, whatever their length; equal
    texts get equal scores, and an empty table gives no rows. A kept column with
    the name of a made one is left out.
    """
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast({"arcs": model.arcs, "bias": model.bias})  # at most MOST_ARCS arcs
    keep = [c for c in keep if c.lower() != "predicted"]
    scored = add_columns(documents, text, keep, "score double, n_clauses int", _scorer(shared))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
