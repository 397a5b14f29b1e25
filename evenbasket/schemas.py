"""Table schemas and model parameters.

Every stored table has a fixed schema. Money and prices are DOUBLE (the
reference stored 32-bit floats; see README for why we do not).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# Model parameters: base index level, starting portfolio value, members per day.
BASE_INDEX_VALUE = 1000.0
INITIAL_NOTIONAL = 1_000_000.0
DEFAULT_MEMBERS = 100
# Trade log action tags (equal-weight index) and composition log tags (v1).
ACTION_ADD = "ADD"
ACTION_REMOVE = "REMOVE"
ACTION_REBALANCE = "REBALANCE"
V1_ADDED = "added"
V1_REMOVED = "removed"
# Vendor price fields of a wide download, and their stored names.
VENDOR_FIELDS = ["Open", "High", "Low", "Close", "Volume"]
VENDOR_OPTIONAL_FIELDS = ["Adj Close"]
# Dashboard windows look back this many days, both ends inclusive.
TRAILING_DAYS = 30
# Daily refresh: back-fill depth for tickers never seen before.
BACKFILL_MONTHS = 1
# ---------------------------------------------------------------------------
# What a held name without a price is worth: nothing, or its last known price
# of at most so many days before.
DROP, CARRY = "drop", "carry"
CARRY_DAYS = 92

STOCK_DATA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("market_cap", T.DoubleType()),
    ]
)
STOCK_DATA_KEY = ["date", "ticker"]

CONSTITUENTS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("weight", T.DoubleType()),
        T.StructField("shares_held", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("notional", T.DoubleType()),
    ]
)

PERFORMANCE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("index_value", T.DoubleType()),
        T.StructField("total_notional", T.DoubleType()),
        T.StructField("daily_return", T.DoubleType()),
    ]
)

REBALANCING_LOG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("action_type", T.StringType()),
        T.StructField("shares_change", T.DoubleType()),
        T.StructField("notional_change", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
    ]
)

COMPOSITION_LOG = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("action", T.StringType()),
    ]
)

INDEX_PERFORMANCE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("index_value", T.DoubleType()),
    ]
)

LONG_BARS = T.StructType(
    [
        T.StructField("Date", T.TimestampType()),
        T.StructField("Price", T.StringType()),
        T.StructField("Ticker", T.StringType()),
        T.StructField("Value", T.DoubleType()),
    ]
)

UNIVERSE = T.StructType([T.StructField("Symbol", T.StringType())])

# One vendor JSON day record (aggregates endpoint), inside a `results` envelope.
JSON_DAY_RECORD = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
    ]
)

TABLES = {
    "stock_data": (STOCK_DATA, ["date"]),
    "constituents": (CONSTITUENTS, ["date"]),
    "performance": (PERFORMANCE, []),
    "rebalancing_log": (REBALANCING_LOG, ["date"]),
    "index_composition_log": (COMPOSITION_LOG, ["date"]),
    "index_performance": (INDEX_PERFORMANCE, []),
}

#: Tables that a run of the index writes together (sources/runs.py).
RUN_TABLES = ["constituents", "rebalancing_log", "performance"]
