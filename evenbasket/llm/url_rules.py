"""URL block and allow rules by a sort-merge range join. DataFrame functions only.

A rule (host, path) fits its host, all subdomains, and paths that start with its
own. In a canonical key a host's labels stand in reverse, each closed by a dot,
so a host with its subdomains is a prefix, and a prefix is an interval of sorted
keys. Intervals of prefixes are nested or apart. A sorted sweep over the keys of
urls and the beginnings of intervals keeps the stack of nested rules: at depth d
stands the last interval of that depth that has begun, and a url finds itself
inside those whose key its own starts with (the others are over).

Two such sweeps judge a url: over hosts, which gives the rule hosts that it
belongs to, and over rule host and path in one key, for these rule hosts alone.

Urls are dealt into slices by a hash, because one host may have most of them; the
rules are repeated for each slice. Each different url is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

#: Different urls in a slice, at least (and no fewer than there are rules), and the most slices in which rules are repeated.
SLICE_URLS, MOST_SLICES = 1000, 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; '' without '://' or url."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """Behind the host up to '?', '#' or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels in reverse, each closed by a dot, as hexadecimal bytes."""
    return F.hex(F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit(".")))


def path_key(of_host: Column, path: Column) -> Column:
    """A rule host's key and a path; the separator stands in neither."""
    return F.concat(of_host, F.lit("|"), F.hex(path))


def _begun(rules: DataFrame, part: Column) -> DataFrame:
    """``rules`` (with distinct keys ``at``) and the depth at which their intervals are nested: one more than are open where one begins.

    Keys are hexadecimal, and 'G' stands above every digit, so key + 'G' is where an
    interval ends. No interval of one ``part`` holds one of another.
    """
    of = rules.withColumns({"__part": part, "__row": F.struct(*rules.columns), "__step": F.lit(1)})
    ends = of.select("__part", F.concat("at", F.lit("G")).alias("at"), F.lit(None).cast(of.schema["__row"].dataType).alias("__row"), F.lit(-1).alias("__step"))
    events = of.select("__part", "at", "__row", "__step").unionByName(ends)
    open_ = F.sum("__step").over(Window.partitionBy("__part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    return events.withColumn("depth", open_).where("__step = 1").select("__row.*", F.col("depth").cast("int").alias("depth"))


def _sweep(points: DataFrame, begun: DataFrame, what: list[str], slices: int) -> DataFrame:
    """``points`` (slice, at, ...) with ``active``: the intervals around each, outermost first, with their columns ``what``."""
    deepest = begun.agg(F.max("depth")).first()[0] or 0  # one number
    dealt = begun.select("at", "depth", F.struct("at", *what).alias("rule"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"))
    events = points.select("slice", "at", F.struct(*points.columns).alias("point")).unionByName(dealt, allowMissingColumns=True)
    # At the same key, intervals begin before points.
    sweep = Window.partitionBy("slice").orderBy("at", F.col("point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    stack = F.array(*[F.last(F.when(F.col("depth") == d, F.col("rule")), ignorenulls=True).over(sweep) for d in range(1, deepest + 1)])
    swept = events.withColumn("stack", stack if deepest else F.lit(None).cast(ArrayType(dealt.schema["rule"].dataType))).where(F.col("point").isNotNull())
    inside = F.filter("stack", lambda r: r.isNotNull() & F.col("at").startswith(r["at"]))
    return swept.select("point.*", inside.alias("active"))


def apply_rules(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", slice_urls: int = SLICE_URLS) -> DataFrame:
    """``pages`` with host, path, rule and verdict (columns of these names are replaced).

    ``rules`` has host, path and verdict ('block' or 'allow'). The longest rule
    (host and path together; the longer host, if equal) that fits wins; of two
    rules with one host and path, 'block'. Rows of ``rules`` with a null are
    left out. Without a fitting rule, ``rule`` is null and the verdict
    ``default``. A null url, or one without '://', has empty host and path; urls
    of any length are read whole. Repeated rows stay; an empty table of rules
    gives all pages the default, and an empty table of pages stays empty.
    """
    given = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict").dropna()
    given = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    judged = pages.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(f"`{url}`")), "path": url_path(F.col(f"`{url}`"))})
    distinct = judged.select("host", "path").where("host <> ''").distinct()
    slices = max(1, min(MOST_SLICES, -(-distinct.count() // max(slice_urls, given.count()))))
    points = distinct.select(F.pmod(F.xxhash64("host", "path"), F.lit(slices).cast("long")).alias("slice"), host_key(F.col("host")).alias("at"), "host", "path")

    hosts = _begun(given.select(host_key(F.col("host")).alias("at"), F.col("host").alias("of_host")).distinct(), F.substring_index(F.lower("of_host"), ".", -1))
    of_hosts = _sweep(points, hosts, ["of_host"], slices).select("slice", "host", "path", F.explode("active").alias("a"))
    inner = of_hosts.select("slice", path_key(F.col("a.at"), F.col("path")).alias("at"), "host", "path", "a.of_host")
    paths = _begun(given.select(path_key(host_key(F.col("host")), F.col("path")).alias("at"), F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict"), F.col("rule_host"))
    longest = F.element_at("active", -1)  # the innermost interval has the longest path
    fits = _sweep(inner, paths, ["rule_host", "rule_path", "verdict"], slices).where(F.size("active") > 0).select("host", "path", longest.alias("r"))
    best = F.max_by("r", F.struct(F.length("r.rule_host") + F.length("r.rule_path"), F.length("r.rule_host"))).alias("best")
    best = fits.groupBy(F.col("host").alias("__host"), F.col("path").alias("__path")).agg(best)
    out = judged.join(best, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
    return out.withColumns({"rule": F.concat("best.rule_host", "best.rule_path"), "verdict": F.coalesce("best.verdict", F.lit(default))}).drop("__host", "__path", "best")
