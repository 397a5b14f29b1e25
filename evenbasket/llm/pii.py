"""Personal data and what gives it away. DataFrame functions only.

Patterns find the protected entities (email, ip, card, phone). Words around
their mentions may reveal them as well. What a term t leaves unknown of an entity
e is the information that is still in e for one who has read t,

    rest(e | t) = -log2 P(e | t)    bits,

and what it gives away is the pointwise mutual information, log2 P(e | t) / P(e).
A term discloses an entity if it gives away at least ``GAIN`` bits and leaves at
most ``GENERALISE`` of them; if it leaves at most ``REMOVE``, it is removed, else
generalised to a mark, in the documents that mention the entity. The measure does
not depend on the size of the corpus: a word that stands by one entity only,
in one context, leaves one bit with any number of documents.

P(e | t) counts different contexts (copies of a passage are one) against the other
documents that have t, and is smoothed by one context of P(e), so a single
context is weak evidence and not none. Spellings of one entity are one, and an
email's domain is an entity of its own that all its addresses mention.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch

#: Kinds in order, and their patterns. Possessive runs and the looks behind keep the search linear; they start and end where the plain forms do.
LOCAL = r"A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
TERM = "term"
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", TERM: "[TERM]"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"

#: Characters of context on each side, and weight of the prior P(e) in contexts.
CONTEXT, PRIOR = 80, 1.0
#: Bits that a term gives away at least, and bits that it leaves at most, to be generalised and to be removed.
GAIN, GENERALISE, REMOVE = 1.0, 1.0, 0.415  # 0.415 bits: P(e | t) of three in four
#: Slices in which the documents of one term are joined with what it discloses; a third of them may have it.
SLICES = 16
#: Terms are runs of at least three letters, lower-cased.
TERM_PATTERN = r"\p{L}{3,}"

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.substr(F.reverse(digits), k, F.lit(1)).cast("int")).otherwise(_doubled(F.substr(F.reverse(digits), k, F.lit(1)).cast("int"))),
    )
    return total % 10 == 0


def _doubled(digit: Column) -> Column:
    return 2 * digit - F.when(digit > 4, 9).otherwise(0)


def _valid(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.rlike(found, F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _parts(text: Column, found: Column, pattern: Column) -> Column:
    """What stands before each of the matches ``found``, and the match; null without a match."""
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda b, m: F.struct(F.char_length(b).alias("before"), m.alias("match")))
    return F.when(F.size(found) > 0, parts)


#: Matches whose places are added up in one go; in one long sum, each step would copy all before it.
_RUN = 64


def _spans(kind: str, parts: str) -> Column:
    """Spans of the matches in the column ``parts``, whose places follow from the lengths before them."""
    size = lambda p: p["before"] + F.char_length(p["match"])
    runs = F.transform(F.sequence(F.lit(0), F.expr(f"(size({parts}) - 1) div {_RUN}")), lambda k: F.slice(F.col(parts), (k * _RUN + 1).cast("int"), F.lit(_RUN)))
    lengths = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda acc, p: acc + size(p)))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    starts = F.aggregate(lengths, first, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")))["all"]

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["before"]
        end = acc["at"] + size(p)
        span = F.array(F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), p["match"].alias("value")))
        return F.struct(end.alias("at"), F.when(_valid(kind, p["match"]), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    none = F.array().cast(f"array<{SPAN}>")
    each = F.zip_with(runs, starts, lambda run, at: F.aggregate(run, F.struct(at.alias("at"), none.alias("spans")), step)["spans"])
    return F.when(F.col(parts).isNotNull(), F.flatten(each)).otherwise(none)


def with_base_spans(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with __text (null: empty) and __base: spans (code points, end exclusive) by kind, then start."""
    out = documents.withColumn("__text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    has = {"email": F.contains("__text", F.lit("@")), "phone": F.contains("__text", F.lit("+"))}
    for kind in KINDS:
        found = F.regexp_extract_all("__text", F.lit(PATTERNS[kind]), F.lit(0))
        if kind in has:
            found = F.when(has[kind], found).otherwise(F.array().cast("array<string>"))
        out = out.withColumn(f"__{kind}", found)
    out = out.withColumns({f"__{kind}": _parts(F.col("__text"), F.col(f"__{kind}"), F.lit(PATTERNS[kind])) for kind in KINDS})
    return out.withColumn("__base", F.concat(*[_spans(kind, f"__{kind}") for kind in KINDS])).drop(*[f"__{kind}" for kind in KINDS])


def _key(doc_id: str, text: str) -> list[Column]:
    return [F.col(f"`{doc_id}`").alias("__id"), F.xxhash64(F.col(f"`{text}`")).alias("__key")]


def disclosing_terms(mentions: DataFrame, documents: DataFrame, scratch: Scratch, text: str = "text") -> DataFrame:
    """(entity, term, rest) of the terms that disclose an entity, rest in bits; mentions (__id, __key, entity, context, terms)."""
    total = documents.count()
    pairs = mentions.select("__id", "__key", "entity", "context", F.explode("terms").alias("term"))
    near = pairs.groupBy("entity", "term", "__id", "__key").agg(F.min("context").alias("least"))
    found = scratch.keep(near.groupBy("entity", "term").agg(F.count("*").alias("both"), F.count_distinct("least").alias("contexts")))
    terms = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(TERM_PATTERN), F.lit(0)))
    # Counted in full, then joined: a join of all words would make a row for each occurrence of a frequent term.
    seen = documents.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("seen"))
    elsewhere = F.greatest(F.col("seen") - F.col("both"), F.lit(0))
    known = found.join(seen, "term").select("entity", "term", "contexts", elsewhere.alias("elsewhere"))
    # However frequent the entity is, P(e | t) is at most that of a prior of 1; most terms of a frequent entity go here.
    known = known.where((F.col("contexts") + PRIOR) / (F.col("contexts") + F.col("elsewhere") + PRIOR) >= 2.0**-GENERALISE)
    mentioned = mentions.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("mentioned"))
    usual = F.least(F.lit(1.0), F.col("mentioned") / F.lit(float(max(total, 2))))
    share = (F.col("contexts") + PRIOR * usual) / (F.col("contexts") + F.col("elsewhere") + PRIOR)
    judged = known.join(mentioned, "entity").select("entity", "term", (-F.log2(share)).alias("rest"), F.log2(share / usual).alias("gain"))
    kept = scratch.keep(judged.where((F.col("rest") <= GENERALISE) & (F.col("gain") >= GAIN)).drop("gain"))
    scratch.drop(found)
    return kept


def entities_of(span: Column) -> Column:
    """What a span mentions: its value however it is written (digits of cards and phones, lower-cased emails, octets without zeros in front), and an email's domain."""
    value, kind = F.lower(span["value"]), span["kind"]
    own = F.when(kind.isin("card", "phone"), F.regexp_replace(value, "[^0-9]", "")).when(kind == "ip", F.regexp_replace(value, "(?<![0-9])0+(?=[0-9])", "")).otherwise(value)
    domain = F.when(kind == "email", F.concat(F.lit("domain:"), F.substring_index(value, "@", -1)))
    return F.array_compact(F.array(F.concat(kind, F.lit(":"), own), domain))


def mentions_of(spans: DataFrame) -> DataFrame:
    """(__id, __key, entity, context, terms) of each span's context, from rows with __text and __base."""
    around = F.transform(
        "__base",
        lambda s: F.struct(
            entities_of(s).alias("entities"),
            F.concat(
                F.substr("__text", F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))),
                F.lit(" "),
                F.substr("__text", s["end"] + 1, F.lit(CONTEXT)),
            ).alias("around"),
        ),
    )
    each = spans.where(F.size("__base") > 0).select("__id", "__key", F.explode(around).alias("m"))
    terms = F.array_distinct(F.regexp_extract_all(F.lower("m.around"), F.lit(TERM_PATTERN), F.lit(0)))
    found = each.select("__id", "__key", "m.entities", F.xxhash64("m.around").alias("context"), terms.alias("terms"))
    return found.select("__id", "__key", F.explode("entities").alias("entity"), "context", "terms")


def _analyse(documents: DataFrame, scratch: Scratch, doc_id: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """Each row's key and base spans, and (if any) per document key the terms to generalise and to remove."""
    based = with_base_spans(documents.select(*_key(doc_id, text), F.col(f"`{text}`").alias("__t")), "__t")
    around = F.when(F.size("__base") > 0, F.col("__text"))
    spans = scratch.keep(based.select("__id", "__key", "__base", around.alias("__text")))
    terms = disclosing_terms(mentions_of(spans), documents, scratch, text)
    if terms.isEmpty():
        return spans, None
    mentioning = spans.where(F.size("__base") > 0)
    entities = mentioning.select("__id", "__key", F.explode(F.array_distinct(F.flatten(F.transform("__base", entities_of)))).alias("entity")).distinct()
    words = F.array_distinct(F.regexp_extract_all(F.lower("__text"), F.lit(TERM_PATTERN), F.lit(0)))
    own = mentioning.select("__id", "__key", F.explode(words).alias("term")).distinct()
    # By term, as a term discloses few entities, while an entity may have many terms and many documents. A term's documents
    # are dealt into slices, for each of which its entities are repeated.
    own = own.withColumn("slice", F.pmod(F.xxhash64("__id", "__key"), F.lit(SLICES).cast("long")))
    dealt = terms.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    dealt = dealt.hint("merge")  # the repeated rows are many more than the table's size lets expect: no broadcast
    found = own.join(dealt, ["term", "slice"]).select(F.col("__id").alias("i"), F.col("__key").alias("k"), F.col("entity").alias("e"), "term", "rest")
    same = F.col("i").eqNullSafe(F.col("__id")) & (F.col("k") == F.col("__key")) & (F.col("e") == F.col("entity"))
    found = found.join(entities, same, "left_semi").select(F.col("i").alias("__id"), F.col("k").alias("__key"), "term", "rest")
    of_doc = found.groupBy("__id", "__key", "term").agg(F.min("rest").alias("rest"))
    of_doc = of_doc.groupBy("__id", "__key").agg(F.sort_array(F.collect_list("term")).alias("__terms"), F.sort_array(F.collect_list(F.when(F.col("rest") <= REMOVE, F.col("term")))).alias("__removed"))
    kept = scratch.keep(of_doc)
    scratch.drop(terms)
    return spans, kept


def with_term_spans(rows: DataFrame) -> DataFrame:
    """``rows`` (__text, __base, __terms) with __found: spans of the document's terms as whole words that no base span touches."""
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("__terms", "|"), F.lit(r")(?!\p{L})"))
    rows = rows.withColumn("__found", F.when(F.col("__terms").isNotNull(), F.regexp_extract_all("__text", pattern, F.lit(0))))
    rows = rows.withColumn("__found", _parts(F.col("__text"), F.col("__found"), pattern))
    free = F.filter(_spans(TERM, "__found"), lambda t: ~F.exists("__base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return rows.withColumn("__found", free)


def span_list(spans: Column) -> Column:
    """'kind:start:end' of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (spans of the patterns) and terms (spans that the corpus adds) of each row.

    A null or empty text has none; an empty table gives no rows. Texts are read
    whole, whatever their length. Rows that repeat are found alike and count once
    for the terms if they share id and text. Other columns, whatever their names,
    are not read.
    """
    scratch = Scratch(documents.sparkSession, "pii")
    spans, terms = _analyse(documents, scratch, doc_id, text)
    if terms is None:
        return spans.select(F.col("__id").alias("doc_id"), F.col("__base").alias("base"), F.array().cast(f"array<{SPAN}>").alias("terms"))
    same = spans["__id"].eqNullSafe(terms["__id"]) & (spans["__key"] == terms["__key"])
    rows = with_term_spans(spans.join(terms, same, "left").select(spans["__id"], "__base", "__text", "__terms"))
    return rows.select(F.col("__id").alias("doc_id"), F.col("__base").alias("base"), F.col("__found").alias("terms"))


def _redacted() -> Column:
    """__text with marks in place of the spans in __all (sorted by start); of overlapping spans the first gives the mark, and all go."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        piece = F.concat(acc["out"], F.substr("__text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), s["mark"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, piece).otherwise(acc["out"]).alias("out"))

    end = F.aggregate("__all", start, step, lambda acc: F.concat(acc["out"], F.substr("__text", acc["at"] + 1)))
    return F.when(F.size("__all") > 0, end).otherwise(F.col("__text"))


def sanitise(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the spans in ``text`` replaced by marks; terms that disclose nearly all are removed.

    Null texts stay null, empty ones empty; rows, their number and all other
    columns stay as they are, and an empty table stays empty. Long texts are
    read whole. Columns named ``__text``, ``__base`` and the like are the
    operator's own and must not be in the table.
    """
    scratch = Scratch(documents.sparkSession, "pii")
    found, terms = _analyse(documents, scratch, doc_id, text)
    scratch.drop(found)
    rows = documents
    if terms is None:
        rows = rows.withColumns({"__terms": F.lit(None).cast("array<string>"), "__removed": F.lit(None).cast("array<string>")})
    else:
        same = F.col(f"`{doc_id}`").eqNullSafe(terms["__id"]) & (F.xxhash64(F.col(f"`{text}`")) == terms["__key"])
        rows = rows.join(terms, same, "left").drop("__id", "__key")
    rows = with_term_spans(with_base_spans(rows, text))
    mark = F.create_map(*[F.lit(x) for kv in MARKS.items() for x in kv])
    every = F.concat(F.col("__base"), F.col("__found"))

    def marked(s: Column) -> Column:
        removed = (s["kind"] == TERM) & F.coalesce(F.array_contains(F.col("__removed"), F.lower(s["value"])), F.lit(False))
        return F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), F.when(removed, F.lit("")).otherwise(mark[s["kind"]]).alias("mark"))

    rows = rows.withColumn("__all", F.array_sort(F.transform(every, marked)))
    clean = F.when(F.col(f"`{text}`").isNotNull(), _redacted())
    return rows.withColumn(text, clean).select(documents.columns)
