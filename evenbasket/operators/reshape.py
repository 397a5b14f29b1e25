"""Vendor bar normalisation: wide (one column per field x ticker) -> long -> tidy.

A wide vendor frame has the date first, then columns named ``Field|Ticker``
(e.g. ``Close|S000001``). Columns are plan, not data: a plan of hundreds of
thousands is slow to make and passes through the driver. Wide data of many tickers
is therefore a frame of lines, each with its header: the date first, then ``Columns``
(the names) and ``Cells`` (their values), in blocks of a bounded number of tickers.
Cells are exploded from one array beside their names (no shuffle); the
way back to one column per field is one conditional aggregate for each of a
fixed list of fields, so no job runs to discover them, and it shuffles once on
(date, ticker) after combining on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import round_to_long
from ..schemas import VENDOR_FIELDS, VENDOR_OPTIONAL_FIELDS
from .calendar import date_grain

SEP = "|"
HEADER, CELLS = "Columns", "Cells"
BLOCK_TICKERS = 1000


def wide_column(field: str, ticker: str) -> str:
    return f"{field}{SEP}{ticker}"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def numbers(cells: Column, types: set[str]) -> Column:
    """An array of cells of such types as doubles: text that is no number becomes NULL."""
    if "string" not in types:
        return cells.cast("array<double>")
    return F.transform(cells, lambda v: v.try_cast("double"))


def wide_to_long(wide: DataFrame) -> DataFrame:
    """(Date, Price, Ticker, Value): one row per cell, missing cells kept as NULL.

    ``wide`` has a column for each ``Field|Ticker``, or lines with ``Columns`` and
    ``Cells`` (the cells that a short line lacks are missing). The date column is found
    by position (first column), as in the vendor frame; every other column must be named
    ``Field|Ticker``. Non-numeric cells, and NaN, become NULL. The cells are one array
    that is exploded beside the names, so the plan stays small however many tickers
    there are.
    """
    date_col, names = wide.columns[0], wide.columns[1:]
    if {HEADER, CELLS} <= set(names):
        header, values = F.col(HEADER), numbers(F.col(CELLS), {wide.schema[CELLS].dataType.elementType.typeName()})
    else:
        odd = [c for c in names if SEP not in c]
        if not names or odd:
            raise ValueError(f"wide frame has columns that aren't 'Field|Ticker': {odd[:5]}")
        types = {f.dataType.typeName() for f in wide.schema.fields[1:]}
        mixed = "string" in types and len(types) > 1
        header, values = F.lit(names), numbers(F.array(*[quoted(c).cast("string") if mixed else quoted(c) for c in names]), types)
    zipped = F.arrays_zip(header.alias("name"), values.alias("value"))
    rows = wide.select(quoted(date_col).alias("Date"), F.inline(zipped).alias("_name", "_value"))
    name, at = F.col("_name"), F.coalesce(F.instr("_name", SEP), F.lit(0))
    odd_name = F.raise_error(F.concat(F.lit("wide line has a column that isn't 'Field|Ticker': "), F.coalesce(name, F.lit("none"))))
    return rows.select(
        "Date",
        F.when(at > 0, F.substring_index(name, SEP, 1)).otherwise(odd_name.cast("string")).alias("Price"),
        F.substr(name, at + 1).alias("Ticker"),
        F.nanvl("_value", F.lit(None).cast("double")).alias("Value"),
    )


def long_to_tidy(long: DataFrame) -> DataFrame:
    """Pivot long bars to the stock_data schema; `Adj Close` is dropped.

    market_cap = close * volume (dollar volume); volume is rounded half-even.
    Two cells of one (Date, Ticker, Price) are refused: a bar mixed of both
    would be one that never existed.
    """
    kept = long.where(~F.col("Price").isin(*VENDOR_OPTIONAL_FIELDS))
    cells = kept.groupBy("Date", "Ticker").agg(
        *[F.max(F.when(F.col("Price") == f, F.col("Value"))).alias(f.lower()) for f in VENDOR_FIELDS],
        *[F.count_if(F.col("Price") == f).alias(f"_{f}") for f in VENDOR_FIELDS],
    )
    twice = F.greatest(*[F.col(f"_{f}") for f in VENDOR_FIELDS]) > 1
    tidy = cells.select(
        F.when(twice, F.raise_error(F.lit("duplicate cells of one (Date, Ticker, Price)")).cast("date")).otherwise(F.to_date("Date")).alias("date"),
        F.col("Ticker").alias("ticker"),
        "open",
        "high",
        "low",
        "close",
        round_to_long("volume").alias("volume"),
        (F.col("close") * F.col("volume")).try_cast("double").alias("market_cap"),
    )
    return tidy


def normalize_bars(wide: DataFrame) -> DataFrame:
    """Wide vendor frame -> stock_data rows (date, ticker, open, high, low, close, volume, market_cap)."""
    return long_to_tidy(wide_to_long(wide))


def bars_to_wide(bars: DataFrame, tickers: list[str] | None = None, block: int | None = None) -> DataFrame:
    """Lay tidy bars out in the vendor's wide form (for landing test files).

    With ``block``: lines with ``Columns`` and ``Cells`` of about so many tickers each, for any
    number of tickers (``wide_blocks``). Without: a frame with a column for each ``Field|Ticker``, for
    few tickers. They become column names, so the driver has their list in any case;
    pass it to skip the job that finds it.
    """
    if block is not None:
        if tickers is not None:
            raise ValueError("blocks are of all tickers: choose among the bars")
        return wide_blocks(bars, block)
    fields = {f: f.lower() for f in VENDOR_FIELDS}
    long = bars.select(
        "date",
        "ticker",
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).cast("double").alias("v")) for f, c in fields.items()])
        ).alias("cell"),
    ).select("date", F.concat("cell.field", F.lit(SEP), "ticker").alias("key"), F.col("cell.v").alias("v"))
    if tickers is None:
        tickers = [r[0] for r in bars.select("ticker").distinct().orderBy("ticker").collect()]
    keys = [wide_column(f, t) for t in tickers for f in VENDOR_FIELDS]
    # One map a date, read by position: a plan of the same size for any number of keys.
    cells = long.groupBy("date").agg(F.map_from_entries(F.collect_set(F.struct("key", "v"))).alias("cells"))
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in keys])
    parsed = cells.select("date", F.from_json(F.to_json("cells"), schema).alias("row"))
    return parsed.select(F.col("date").alias("Date"), "row.*")


def wide_blocks(bars: DataFrame, per_block: int = BLOCK_TICKERS) -> DataFrame:
    """Tidy bars as wide lines (Date, Block, Columns, Cells): a line for each date and block of about ``per_block`` tickers.

    All lines of a block have the same columns, and every block has all dates, with missing
    cells where a ticker has no bar, as in one wide frame. Blocks are dealt by a hash of the ticker; no
    list of tickers or of columns passes through the driver. Two different bars of one
    (date, ticker) are refused, a repeated bar counts once. ``bars`` is read four times.
    """
    tickers = bars.select("ticker").distinct()
    blocks = F.greatest(F.lit(1), F.ceil(tickers.agg(F.count(F.lit(1))).scalar() / F.lit(per_block)))
    grid = tickers.crossJoin(date_grain(bars.select("date").distinct())).alias("g")
    same = F.col("g.date").eqNullSafe(F.col("b.date")) & F.col("g.ticker").eqNullSafe(F.col("b.ticker"))
    values = [F.col(f"b.{f.lower()}").cast("double").alias(f) for f in VENDOR_FIELDS]
    bar = F.struct(F.col("g.ticker").alias("ticker"), *values)
    filled = grid.join(bars.alias("b"), same, "left").select(F.col("g.date").alias("Date"), F.pmod(F.xxhash64("g.ticker"), blocks).alias("Block"), bar.alias("bar"))
    lines = filled.groupBy("Date", "Block").agg(F.sort_array(F.collect_set("bar")).alias("bars"))
    own = F.transform("bars", lambda b: b["ticker"])
    twice = F.raise_error(F.lit("two different bars of one (date, ticker)")).cast("array<string>")
    names = F.flatten(F.transform(own, lambda t: F.array(*[F.concat(F.lit(f + SEP), t) for f in VENDOR_FIELDS])))
    cells = F.flatten(F.transform("bars", lambda b: F.array(*[b[f] for f in VENDOR_FIELDS])))
    return lines.select("Date", "Block", F.when(F.size("bars") == F.size(F.array_distinct(own)), names).otherwise(twice).alias(HEADER), cells.alias(CELLS))
