"""Vendor bundles: a folder of wide downloads, each with tickers of its own, as a Spark data source.

The built-in CSV reader gives all files of a folder the header of one. Here every
file is read by its own header, as partitions of its own, and the dates and tickers
asked for are chosen in the files: lines of other dates are not unpacked, columns of
other tickers not sent to Spark, and files without a wanted ticker not planned.
Cells stay text in Python; they become numbers in Spark, as in ``wide_to_long``.
"""

from __future__ import annotations

import csv
import datetime
import io
import json
import re
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.columns import round_to_long
from ..operators.reshape import CELLS, HEADER, SEP
from ..schemas import VENDOR_FIELDS

FORMAT = "vendor_bundles"
SPLIT_BYTES = 128 << 20
BATCH_ROWS = 1 << 14
FIELDS = [f.lower() for f in VENDOR_FIELDS]
SCHEMA = "date date, ticker string, " + ", ".join(f"{f} string" for f in FIELDS)
DAY = re.compile(r"\s*(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T].*)?\s*$")


@dataclass
class Split(InputPartition):
    """Lines of a file that begin in [start, end)."""

    path: str
    start: int
    end: int


def day_of(text: str) -> datetime.date | None:
    found = DAY.match(text)
    try:
        return datetime.date(*map(int, found.groups())) if found else None
    except ValueError:
        return None


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (``file:/x`` and ``file:///x`` alike) and the path in it."""
    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if "://" not in local else fs.FileSystem.from_uri(path)


class BundleReader(DataSourceReader):
    """Dates from ``first`` to ``last`` (both included, None: no bound) of ``tickers`` (None: all)."""

    def __init__(self, path: str, split_bytes: int, first: str | None, last: str | None, tickers: list[str] | None):
        self.path, self.split_bytes = path, split_bytes
        self.first, self.last = (datetime.date.fromisoformat(x) if x else None for x in (first, last))
        self.tickers = None if tickers is None else frozenset(tickers)

    def wants(self, day: datetime.date | None) -> bool:
        if day is None:
            return self.first is None and self.last is None
        return (self.first is None or day >= self.first) and (self.last is None or day <= self.last)

    def columns(self, header: list[str], path: str) -> dict[str, list[int | None]]:
        """Places of a wanted ticker's fields in a line."""
        places: dict[str, list[int | None]] = {}
        for at, name in enumerate(header[1:], 1):
            field, sep, ticker = name.partition(SEP)
            if not sep:
                raise ValueError(f"{path}: column {name!r} isn't 'Field|Ticker'")
            if self.tickers is not None and ticker not in self.tickers:
                continue
            row = places.setdefault(ticker, [None] * len(FIELDS))
            if field in VENDOR_FIELDS:
                k = VENDOR_FIELDS.index(field)
                if row[k] is not None:
                    raise ValueError(f"{path}: two columns {name!r}")
                row[k] = at
        return places

    def partitions(self) -> list[Split]:
        where, root = file_system(self.path)
        found = where.get_file_info(root)
        files = [found] if found.is_file else where.get_file_info(fs.FileSelector(root, recursive=True)) if found.type != fs.FileType.NotFound else None
        if files is None:
            raise FileNotFoundError(self.path)
        splits = []
        for info in sorted(files, key=lambda i: i.path):
            if not info.is_file or not info.size or not info.base_name.endswith(".csv") or info.base_name.startswith(("_", ".")):
                continue
            if self.tickers is not None:
                with self.open(where, info.path) as lines:
                    if not self.columns(self.header(lines), info.path):
                        continue
            splits += [Split(info.path, at, min(at + self.split_bytes, info.size)) for at in range(0, info.size, self.split_bytes)]
        return splits or [Split("", 0, 0)]

    @staticmethod
    def open(where: fs.FileSystem, path: str) -> io.BufferedReader:
        return io.BufferedReader(where.open_input_file(path), 1 << 20)

    @staticmethod
    def header(lines: io.BufferedReader) -> list[str]:
        return next(csv.reader([lines.readline().decode("utf-8-sig")]), [])

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        where, _ = file_system(self.path)
        schema = pa.schema([("date", pa.date32()), *[(c, pa.string()) for c in ["ticker", *FIELDS]]])
        with self.open(where, partition.path) as lines:
            places = self.columns(self.header(lines), partition.path)
            if partition.start > lines.tell():
                lines.seek(partition.start - 1)
                lines.readline()  # the line that the split before has begun
            tickers, rows = list(places), [[] for _ in schema]

            def batch() -> pa.RecordBatch:
                done = pa.record_batch([pa.array(c, t.type) for c, t in zip(rows, schema, strict=True)], schema=schema)
                for c in rows:
                    c.clear()
                return done

            while tickers and lines.tell() < partition.end and (line := lines.readline()):
                text = line.decode("utf-8")
                if not text.strip():
                    continue
                first = text.split(",", 1)[0].strip().strip('"')
                day = day_of(first)
                if not self.wants(day):
                    continue
                cells = next(csv.reader([text]))
                cell = lambda at, cells=cells: cells[at] if at is not None and at < len(cells) else None
                rows[0] += [day] * len(tickers)
                rows[1] += tickers
                for k, column in enumerate(rows[2:]):
                    column += [cell(places[t][k]) for t in tickers]
                if len(rows[0]) >= BATCH_ROWS:
                    yield batch()
            if rows[0]:
                yield batch()


class VendorBundles(DataSource):
    """Options: ``path`` (a file or a folder, read to any depth), ``splitBytes`` (a longer file becomes several
    partitions), ``firstDate``, ``lastDate`` (YYYY-MM-DD, included), ``tickers`` (a JSON list)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BundleReader:
        asked = self.options.get
        tickers = asked("tickers")
        return BundleReader(asked("path"), int(asked("splitBytes", SPLIT_BYTES)), asked("firstDate"), asked("lastDate"), json.loads(tickers) if tickers else None)


def register_bundles(spark: SparkSession) -> None:
    """Make ``spark.read.format("vendor_bundles")`` known."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers need not have this package
    spark.dataSource.register(VendorBundles)


def read_bundles(
    spark: SparkSession,
    path: str,
    first: datetime.date | str | None = None,
    last: datetime.date | str | None = None,
    tickers: Sequence[str] | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Wide CSV files under ``path`` -> stock_data rows, one for each line and ticker of each file's header.

    ``first`` and ``last`` (both included; lines without a date go) and ``tickers`` are decided in the files.
    They are options of the reader and not pushed filters: Spark 4.1 keeps what was pushed into a Python source
    for all frames of one ``load``, so a second query on the frame would see the rows of the first.

    As in ``normalize_bars``: the date is the first column, cells that are no numbers and
    NaN are NULL, other fields than the vendor's are dropped, volume is rounded half-even and
    market_cap = close * volume; a line has a row for each ticker, with all cells missing too.
    A first cell that is no date gives NULL (the upsert refuses it). Short lines lack their last cells; blank lines
    and files without a line count as none. A column that isn't ``Field|Ticker`` or that stands twice is an error. Nothing is
    shuffled, so a (date, ticker) of two files has two rows: the upsert decides. Cells hold no line breaks.
    """
    register_bundles(spark)
    options = {"splitBytes": split_bytes, "firstDate": first and str(first), "lastDate": last and str(last), "tickers": None if tickers is None else json.dumps(list(tickers))}
    cells = spark.read.format(FORMAT).options(**{k: v for k, v in options.items() if v is not None}).load(path)
    number = {f: F.nanvl(F.col(f).try_cast("double"), F.lit(None).cast("double")) for f in FIELDS}
    bars = cells.select("date", "ticker", *[c.alias(f) for f, c in number.items()])
    market_cap = (F.col("close") * F.col("volume")).try_cast("double")
    return bars.select("date", "ticker", "open", "high", "low", "close", round_to_long("volume").alias("volume"), market_cap.alias("market_cap"))


def write_bundles(lines: DataFrame, path: str) -> None:
    """Wide lines (Date, Block, Columns, Cells) as wide CSV files under ``path``, one for each block with its own header.

    A block's lines must have the same columns, as ``bars_to_wide`` makes them. They meet in one task
    in the order of their dates, and the first brings the header along; a task holds one line at a time. Names and
    cells are text in quotes where they have a comma or a quote, missing cells are empty.
    """
    quote = lambda t: F.when(t.rlike('[,"]'), F.concat(F.lit('"'), F.replace(t, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(t, F.lit("")))
    row = lambda first, rest: F.array_join(F.concat(F.array(first), F.transform(rest, quote)), ",")
    date = quote(F.coalesce(F.col("Date").cast("string"), F.lit("")))
    number = F.row_number().over(Window.partitionBy("Block").orderBy("Date"))
    texts = lines.select("Block", number.alias("_line"), row(F.lit("Date"), F.col(HEADER)).alias("_header"), row(date, F.col(CELLS).cast("array<string>")).alias("_text"))
    both = F.when(F.col("_line") == 1, F.array("_header", "_text")).otherwise(F.array("_text"))
    files = texts.select("Block", "_line", F.posexplode(both).alias("_at", "line")).sortWithinPartitions("Block", "_line", "_at")
    # Whole lines as the one column of a CSV without quotes of its own: the files are found by their ending.
    plain = {"header": False, "sep": "\u0001", "quote": "", "escapeQuotes": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files.select("Block", "line").write.partitionBy("Block").options(**plain).csv(path)
