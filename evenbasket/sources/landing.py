"""Readers for files the vendor feeds land in a folder.

The reference downloaded these over HTTP; here they are files, read with an
explicit schema (no inference job), and normalised with DataFrame operators.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..operators.calendar import date_grain
from ..operators.reshape import normalize_bars
from ..schemas import JSON_DAY_RECORD
from ..session import scratch_path


MAX_COLUMNS = 1 << 20


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """A landed wide vendor download (date first, then `Field|Ticker` columns),
    every cell read as text; numeric coercion happens in `wide_to_long`.
    ``MAX_COLUMNS`` replaces the reader's own limit of 20,480."""
    return spark.read.option("header", True).option("inferSchema", False).option("maxColumns", MAX_COLUMNS).csv(path)


def read_wide_bars(spark: SparkSession, path: str) -> DataFrame:
    """Landed wide CSV -> stock_data rows."""
    return normalize_bars(read_wide_csv(spark, path))


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """Index universe list: a CSV with a `Symbol` column (other columns ignored)."""
    df = spark.read.option("header", True).csv(path)
    return df.select(F.trim("Symbol").alias("Symbol")).where(F.col("Symbol").isNotNull()).distinct()


def read_json_days(spark: SparkSession, path: str) -> DataFrame:
    """Vendor JSON responses, one object a line -> (ticker, date, open, close, market_cap).

    ``results`` may be an array of day records or a single record. A line that
    is no JSON object with such results is an error, not a loss; an empty array
    has no rows.
    """
    raw = spark.read.text(path).where(F.trim("value") != "")
    kind = F.get_json_object("value", "$.results")
    record = f"array<{JSON_DAY_RECORD.simpleString()}>"
    many = F.when(F.startswith(F.ltrim(kind), F.lit("[")), F.from_json(kind, record))
    single = F.when(F.startswith(F.ltrim(kind), F.lit("{")), F.array(F.from_json(kind, JSON_DAY_RECORD)))
    bad = F.raise_error(F.concat(F.lit("no results in vendor response: "), F.substring("value", 1, 200)))
    rec = raw.select(F.explode(F.coalesce(many, single, bad.cast(record))).alias("r")).select("r.*")
    return rec.select(
        "ticker",
        F.to_date("date").alias("date"),
        "open",
        "close",
        "market_cap",
    )


def read_time_series(spark: SparkSession, path: str) -> DataFrame:
    """Vendor time-series responses, one object a line: ``{"ticker": T, "series": {date: {field: value}}}``
    -> (ticker, date, open, high, low, close, volume). Field names may carry a number ("1. open"); values may be text."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", "ticker string, series map<string, map<string, string>>")
    rows = raw.select(F.when(parsed["series"].isNotNull(), parsed).otherwise(F.raise_error(F.lit("no series in vendor response")).cast("struct<ticker:string,series:map<string,map<string,string>>>")).alias("p"))
    days = rows.select("p.ticker", F.explode("p.series").alias("date", "fields"))
    named = F.transform_keys("fields", lambda k, _: F.regexp_replace(F.lower(k), r"^[0-9]+\. *", ""))
    days = days.select("ticker", F.to_date("date").alias("date"), named.alias("fields"))
    number = lambda f: F.nanvl(F.try_element_at("fields", F.lit(f)).try_cast("double"), F.lit(None).cast("double"))
    return days.select("ticker", "date", *[number(f).alias(f) for f in ("open", "high", "low", "close")], F.rint(number("volume")).cast("bigint").alias("volume"))


# Why a line, or a record of one, is no bar.
NOT_JSON, NO_RECORDS, NO_TICKER, NO_DATE, NO_CLOSE = "not JSON", "no records", "no ticker", "no date", "no close"


def parse_payloads(lines: DataFrame) -> DataFrame:
    """Vendor responses of any known shape, one in each ``value`` -> (ticker, date, open, high, low, close, volume, market_cap, reason, payload).

    Shapes: ``results`` with an array of day records or a single one, a bare array
    of day records, and ``series`` with fields by date under one ticker. Field names
    may carry a number ("1. open") and values may be text; of several names for a
    field the last in order counts (the plain one). A row is a bar (reason
    and payload NULL) or refused: payload is then the record, or the whole line if no
    records can be told apart in it, and the other columns hold what could be read. No
    line is lost and none fails the others; blank lines count as none.
    """
    parsed = lines.select("value", F.try_parse_json("value").alias("v")).where(F.trim("value") != "")
    one = F.expr("try_variant_get(v, '$.results', 'variant')")
    records = F.coalesce(
        F.expr("try_variant_get(v, '$.results', 'array<variant>')"),
        F.when(F.schema_of_variant(one).startswith("OBJECT"), F.array(one)),
        F.expr("try_variant_get(v, '$', 'array<variant>')"),
    )
    fields = "map<string, variant>"
    days = F.transform(records, lambda r: F.struct(F.try_variant_get(r, "$.ticker", "string").alias("ticker"), F.try_variant_get(r, "$.date", "string").alias("day"), F.try_variant_get(r, "$", fields).alias("fields"), F.to_json(r).alias("record")))
    ticker = F.try_variant_get("v", "$.ticker", "string")
    series = F.transform(
        F.map_entries(F.expr("try_variant_get(v, '$.series', 'map<string, variant>')")),
        lambda e: F.struct(ticker.alias("ticker"), e["key"].alias("day"), F.try_variant_get(e["value"], "$", fields).alias("fields"), F.to_json(F.create_map(e["key"], e["value"])).alias("record")),
    )
    rows = parsed.select("value", F.col("v").isNull().alias("broken"), F.explode_outer(F.coalesce(days, series)).alias("r"))
    named = F.transform(F.map_entries("r.fields"), lambda e: F.struct(F.regexp_replace(F.lower(e["key"]), r"^[0-9]+\. *", "").alias("name"), e["value"].alias("value")))
    rows = rows.select("value", "broken", "r", named.alias("n"))

    def number(field: str) -> Column:
        own = F.try_element_at(F.filter("n", lambda x: x["name"] == field), F.lit(-1))["value"]
        return F.nanvl(F.try_variant_get(own, "$", "double"), F.lit(None).cast("double"))

    bars = rows.select(
        F.col("r.ticker").alias("ticker"),
        F.col("r.day").try_cast("date").alias("date"),
        *[number(f).alias(f) for f in ("open", "high", "low", "close")],
        F.rint(number("volume")).cast("bigint").alias("volume"),
        number("market_cap").alias("market_cap"),
        "value",
        "broken",
        F.col("r.record").alias("record"),
    )
    reason = (
        F.when(F.col("broken"), NOT_JSON)
        .when(F.col("record").isNull(), NO_RECORDS)
        .when(F.coalesce(F.trim("ticker"), F.lit("")) == "", NO_TICKER)
        .when(F.col("date").isNull(), NO_DATE)
        .when(F.col("close").isNull(), NO_CLOSE)
    )
    names = ["ticker", "date", "open", "high", "low", "close", "volume", "market_cap"]
    return bars.select(*names, reason.alias("reason"), F.when(reason.isNotNull(), F.coalesce("record", "value")).alias("payload"))


def land_payloads(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(bars, refused) of landed vendor responses, one a line. They are parsed once and written to the checkpoint
    folder, split by whether they are refused; refused rows have reason, payload and what could be read."""
    parsed = parse_payloads(spark.read.text(path))
    stage = scratch_path(spark, f"payloads-{uuid.uuid4().hex}")
    parsed.withColumn("refused", F.col("reason").isNotNull()).write.partitionBy("refused").parquet(stage)
    kept = spark.read.schema(StructType([*parsed.schema.fields, StructField("refused", BooleanType())])).parquet(stage)
    return kept.where("NOT refused").drop("refused", "reason", "payload"), kept.where("refused").drop("refused")


def write_json_days(bars: DataFrame, path: str, page_size: int = 1000) -> None:
    """Lay bars out as vendor JSON envelopes ``{"results": [...]}``, paged like
    a vendor API: each date is split into ceil(rows / page_size) pages by a hash
    of the ticker, so an envelope holds about ``page_size`` records however many
    tickers a date has (no date lands whole in one task or one record)."""
    per_date = bars.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(page_size))).cast("bigint")
    paged = bars.join(date_grain(per_date), "date").withColumn("_page", F.pmod(F.xxhash64("ticker"), pages))
    records = paged.select(
        "date",
        "_page",
        F.struct(
            "ticker",
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            "open",
            "close",
            "market_cap",
        ).alias("r"),
    )
    envelopes = records.groupBy("date", "_page").agg(F.collect_list("r").alias("results")).select("results")
    envelopes.write.mode("overwrite").json(path)
