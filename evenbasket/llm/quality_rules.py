"""Quality rules with robust multivariate outliers. DataFrame functions only.

Statistics of each text become a vector of transformed rates. Per language and
source, minimum-covariance-determinant estimates of centre and scatter are found
by concentration steps: the rows nearest by Mahalanobis distance give the next
estimate, from several starts, until no determinant falls any more; the least
one counts. The estimates of a group are drawn towards those of its language,
and these towards those of all texts, the more the fewer rows they rest on. Texts
far from their group's centre are rejected, besides two fixed rules.

Texts are read once; every step after that aggregates a table of a few numbers
a text, with partial sums, so one huge group is no burden.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenbasket.llm.tables import Scratch

SPACE = " \t\n\x0b\x0c\r"
#: Share of a group's rows that its estimates rest on, and precision of the quantiles.
SUPPORT, PRECISION = 0.75, 2000
#: Concentration steps that all starts get before the best goes on alone, and the fall of a log determinant that counts as one.
FIRST_STEPS, FALL = 2, 1e-3
#: Rows that the estimate of the pool above a group weighs in it.
PRIOR_ROWS = 200.0
#: Vector components and the least standard deviation that each is taken to have: rates are arcsines of square
#: roots, whose noise hardly depends on the rate. What a single chance event does to a usual text is no deviation (a symbol
#: in 400 characters, a repeated line in 45, a repeated window in 400 words, 5 % of the mean word length);
#: and a text some hundred times longer than its group's is no junk for that alone.
FLOORS = {"f_length": 0.05, "f_symbols": 0.05, "f_lines": 0.15, "f_repeats": 0.12, "f_words": 1.0}
DIMS = list(FLOORS)
#: Share of texts that a group without outliers would lose.
LOST = 1e-5
#: Groups up to which their estimates (some 30 numbers each) are broadcast; more are joined in slices of rows.
BROADCAST_GROUPS, SLICES = 50_000, 64


def chi_squared_beyond(x: float, degrees: int) -> float:
    """P(a chi-squared variable of odd ``degrees`` exceeds x)."""
    term, total = math.sqrt(2 * x / math.pi) * math.exp(-x / 2), math.erfc(math.sqrt(x / 2))
    for k in range(3, degrees + 1, 2):
        total += term
        term *= x / k
    return total


def chi_squared_quantile(beyond: float, degrees: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_squared_beyond(mid, degrees) > beyond else (low, mid)
    return high


#: Squared distance beyond which a text is an outlier, and its median in a group without any.
CUTOFF, MEDIAN_CHI2 = chi_squared_quantile(LOST, len(DIMS)), chi_squared_quantile(0.5, len(DIMS))


def text_statistics(text: Column) -> dict[str, Column]:
    """First expressions of the statistics: arrays that the next step counts."""
    text = F.coalesce(text, F.lit(""))
    body = F.btrim(text, F.lit(SPACE))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[ \t-\r]+", -1))
    return {"__text": text, "__words": words, "__lines": F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)) != "")}


def repeated_words(windows: Column, ordered: Column) -> Column:
    """Words in windows of three that occur twice or more; ``ordered`` has (hash, place) of the windows, sorted."""
    n = F.size(ordered)
    equal = F.zip_with(F.slice(ordered, F.lit(1), n - 1), F.slice(ordered, F.lit(2), n - 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(equal, lambda p: p.isNotNull()))))


def with_statistics(documents: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each whole text (null: none)."""
    first = documents.select(*[F.col(f"`{c}`") for c in keep], *[e.alias(n) for n, e in text_statistics(F.col(f"`{text}`")).items()])
    n = F.size("__words")
    hashes = F.transform("__words", lambda w, i: F.xxhash64(w, F.get("__words", i + 1), F.get("__words", i + 2)))
    counted = first.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.char_length("__text") - F.char_length(F.regexp_replace("__text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.slice(hashes, F.lit(1), F.greatest(n - 2, F.lit(0))).alias("__windows"),
    )
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    ordered = F.when(some, F.array_sort(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    stats = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    sorted_ = counted.select(*keep, *stats, "__windows", ordered.alias("__ordered"))
    places = sorted_.select(*keep, *stats, F.when(F.col("__ordered").isNotNull(), repeated_words(F.col("__windows"), F.col("__ordered"))).alias("__places"))
    covered = F.zip_with("__places", F.slice("__places", F.lit(2), F.size("__places")), lambda a, b: F.least(F.lit(3), b - a))
    total = F.when(F.col("__places").isNull(), F.lit(0)).otherwise(F.aggregate(covered, F.lit(0), lambda s, x: s + x))
    return places.select(*keep, *stats, total.cast("long").alias("n_repeat_words"))


def vector() -> dict[str, Column]:
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    rate = lambda part, whole: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(part) / whole)))
    return {
        "f_length": F.log(chars / words),
        "f_symbols": rate("n_symbols", chars),
        "f_lines": rate("n_dup_lines", F.col("n_lines") + 10),
        "f_repeats": rate("n_repeat_words", words),
        "f_words": F.log(words),
    }


_PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i + 1)]
_CENTRE, _SCATTER, _FACTOR = [f"m_{i}" for i in range(len(DIMS))], [f"c_{i}_{j}" for i, j in _PAIRS], [f"l_{i}_{j}" for i, j in _PAIRS]


def _factor(stats: DataFrame) -> DataFrame:
    """With the Cholesky factor of each scatter and its log determinant. Scatters have their floors."""
    for i, j in _PAIRS:
        inner = F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        # Sums of squares lose some digits: what is left of a variance never falls below a hundredth of its floor.
        least = F.lit((FLOORS[DIMS[i]] / 10) ** 2)
        stats = stats.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(inner, least)) if i == j else inner / F.col(f"l_{j}_{j}"))
    return stats.withColumn("log_det", sum((2 * F.log(f"l_{i}_{i}") for i in range(len(DIMS))), F.lit(0.0)))


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distances of rows that have their group's centre and factor."""
    names = []
    for i, a in enumerate(DIMS):
        rest = F.col(a) - F.col(f"m_{i}") - sum((F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
        names.append(f"y_{i}")
    return rows.withColumn("d2", sum((F.col(y) * F.col(y) for y in names), F.lit(0.0))).drop(*names)


def _floored(i: int, j: int, scatter: Column) -> Column:
    return scatter + F.lit(FLOORS[DIMS[i]] ** 2) if i == j else scatter


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Centre and floored scatter of each group from plain sums: the components are small, so squares keep their digits."""
    sums = [F.sum(a).alias(f"s_{i}") for i, a in enumerate(DIMS)]
    squares = [F.sum(F.col(DIMS[i]) * F.col(DIMS[j])).alias(f"q_{i}_{j}") for i, j in _PAIRS]
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).cast("double").alias("n"), *sums, *squares)
    centre = [(F.col(f"s_{i}") / F.col("n")).alias(f"m_{i}") for i in range(len(DIMS))]
    scatter = [_floored(i, j, F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"s_{i}") * F.col(f"s_{j}") / (F.col("n") * F.col("n"))).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    return total.select(*by, *centre, *scatter)


def _quantile(column: str, share: float) -> Column:
    return F.percentile_approx(column, share, PRECISION)


def of_groups(rows: DataFrame, stats: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """``rows`` with the few numbers of their groups. A group may hold most rows: so many groups that they can't be
    broadcast are repeated for slices of the rows, and no task gets a group whole."""
    if stats.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(stats), on, how)
    slices = F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))
    dealt = rows.withColumn("__slice", F.pmod(F.monotonically_increasing_id(), F.lit(SLICES).cast("long")))
    return dealt.join(stats.withColumn("__slice", F.explode(slices)), [*on, "__slice"], how).drop("__slice")


def _starts(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, start, centre, scatter): medians and first quartiles with median deviations (junk adds to rates), and plain moments."""
    middle = scratch.keep(rows.groupBy("grp").agg(*[F.percentile_approx(a, [0.5, 0.25], PRECISION).alias(f"q_{i}") for i, a in enumerate(DIMS)]))
    spread = of_groups(rows, middle, ["grp"]).select("grp", *[F.abs(F.col(a) - F.col(f"q_{i}")[0]).alias(f"a_{i}") for i, a in enumerate(DIMS)])
    spread = spread.groupBy("grp").agg(*[_quantile(f"a_{i}", 0.5).alias(f"a_{i}") for i in range(len(DIMS))])
    robust = middle.join(spread, "grp")
    scatter = [_floored(i, j, F.pow(1.4826 * F.col(f"a_{i}"), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in _PAIRS]
    each = [robust.select("grp", F.lit(k).alias("start"), *[F.col(f"q_{i}")[k].alias(f"m_{i}") for i in range(len(DIMS))], *scatter) for k in (0, 1)]
    plain = _moments(rows, ["grp"]).select("grp", F.lit(2).alias("start"), *_CENTRE, *_SCATTER)
    made = scratch.keep(_factor(each[0].unionByName(each[1]).unionByName(plain)))
    scratch.drop(middle)
    return made


def _concentrated(rows: DataFrame, stats: DataFrame) -> DataFrame:
    """The next estimates: moments of the nearest rows by the last ones."""
    far = _distance(of_groups(rows, stats.select("grp", "start", *_CENTRE, *_FACTOR), ["grp"])).select("grp", "start", *DIMS, "d2")
    limits = far.groupBy("grp", "start").agg(_quantile("d2", SUPPORT).alias("limit"))
    near = of_groups(far, limits, ["grp", "start"]).where("d2 <= limit")
    return _factor(_moments(near, ["grp", "start"]))


def minimum_covariance_determinant(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(grp, n, m_i, c_i_j): centre and scatter of each group of ``rows`` (grp and the vector); the scatter is scaled so that the median distance is that of a chi-squared variable, if it is larger."""
    stats = _starts(rows, scratch)
    for _ in range(FIRST_STEPS):
        stats, before = scratch.keep(_concentrated(rows, stats)), stats
        scratch.drop(before)
    best = F.min_by(F.struct(*stats.columns), F.struct("log_det", "start")).alias("best")
    stats, before = scratch.keep(stats.groupBy("grp").agg(best).select("best.*")), stats
    scratch.drop(before)
    done = []
    while True:
        # Groups whose determinant still falls go on; it is bounded below by the floors, so they come to an end.
        after = scratch.keep(_concentrated(rows, stats))
        old = stats.select("grp", F.col("log_det").alias("was"))
        judged = after.join(old, "grp").withColumn("falls", F.col("log_det") < F.col("was") - FALL)
        kept = stats.join(judged.where("NOT falls").select("grp"), "grp", "left_semi")
        done.append(scratch.keep(kept))
        falling = scratch.keep(judged.where("falls").drop("was", "falls"))
        scratch.drop(after, stats)
        stats = falling
        if stats.isEmpty():
            break
    scratch.drop(stats)
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    found = found.select("grp", *_CENTRE, *_SCATTER, *_FACTOR)
    far = _distance(of_groups(rows, found, ["grp"])).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), _quantile("d2", 0.5).alias("middle"))
    scale = F.greatest(F.col("middle") / MEDIAN_CHI2, F.lit(1.0))  # not below 1, which would undo the floors
    final = scratch.keep(found.join(far, "grp").select("grp", "n", *_CENTRE, *[(F.col(c) * scale).alias(c) for c in _SCATTER]))
    scratch.drop(*done)
    return final


def _drawn_to(own: DataFrame, pool: DataFrame, on: list[str], pool_is_one: bool = False) -> DataFrame:
    """Estimates drawn towards the pool's by the rows they rest on. Two centres apart widen the scatter as mixed groups do."""
    above = pool.select(*on, *[F.col(c).alias(f"p_{c}") for c in (*_CENTRE, *_SCATTER)])
    both = own.join(F.broadcast(above) if pool_is_one else above, on)
    w = F.col("n") / (F.col("n") + PRIOR_ROWS)
    apart = lambda i: F.col(f"m_{i}") - F.col(f"p_m_{i}")
    centre = {c: w * F.col(c) + (1 - w) * F.col(f"p_{c}") for c in _CENTRE}
    scatter = {f"c_{i}_{j}": w * F.col(f"c_{i}_{j}") + (1 - w) * F.col(f"p_c_{i}_{j}") + w * (1 - w) * apart(i) * apart(j) for i, j in _PAIRS}
    return both.select(*[c for c in own.columns if c not in (*_CENTRE, *_SCATTER)], *[e.alias(c) for c, e in (centre | scatter).items()])


def judge_quality(documents: DataFrame, keep: list[str], text: str = "text", lang: str = "lang", source: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """``keep`` columns with the statistics, base_failed, distance and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated
    windows. Of the other texts, those of one language and source (null: '') are
    a group. ``distance`` is the squared robust distance from its centre (null if
    base_failed), and a text is kept up to ``cutoff``. Groups of any size are
    treated alike: a small one's estimates are mostly those of its language. Null
    and empty texts have no words and fail. Repeated rows count as often as they
    occur; an empty table gives no rows; texts are read whole, whatever their
    length. Other columns are not read, and a kept column with the name of a made
    one is left out.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept"]
    keep = [c for c in keep if c.lower() not in made]
    own = [f"__k{i}" for i in range(len(keep))]
    scratch = Scratch(documents.sparkSession, "quality-rules")
    named = documents.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, own, strict=True)], F.col(f"`{text}`").alias("__t"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("__lang"), F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("__source"))
    stats = with_statistics(named, [*own, "__lang", "__source"], "__t")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = scratch.keep(stats.withColumn("base_failed", failed).withColumns(vector()))
    out = _judge(judged, own, cutoff, scratch)
    return out.select(*[F.col(k).alias(c) for c, k in zip(keep, own, strict=True)], *made)


def _judge(judged: DataFrame, keep: list[str], cutoff: float, scratch: Scratch) -> DataFrame:
    """Distances and verdicts of rows that have their statistics, vector and group names."""
    rows = judged.where("NOT base_failed")
    none = F.lit("")
    levels = F.array(*[F.struct(F.lit(k).alias("level"), lang.alias("lang"), source.alias("source")) for k, lang, source in ((0, none, none), (1, F.col("__lang"), none), (2, F.col("__lang"), F.col("__source")))])
    vectors = rows.select(*DIMS, F.explode(levels).alias("grp"))
    estimates = minimum_covariance_determinant(vectors, scratch)
    by_level = [estimates.where(F.col("grp.level") == k).withColumns({"__lang": F.col("grp.lang"), "__source": F.col("grp.source")}).drop("grp") for k in range(3)]
    # All texts are one group, whose key is the empty source of the languages' groups.
    langs = _drawn_to(by_level[1], by_level[0].drop("__lang"), ["__source"], True).drop("__source")
    groups = scratch.keep(_factor(_drawn_to(by_level[2], langs, ["__lang"])).select("__lang", "__source", *_CENTRE, *_FACTOR))
    scratch.drop(estimates)
    scored = _distance(of_groups(judged, groups, ["__lang", "__source"], "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    out = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"]
    return scored.select(*out, distance.alias("distance"), (~F.col("base_failed") & (distance <= cutoff)).alias("kept"))
