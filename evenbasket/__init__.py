"""evenbasket: equal-weight stock baskets on Spark DataFrames."""

from .operators.equal_weight import EqualWeightIndex, equal_weight_index
from .operators.metrics import (
    composition_on_date,
    performance_series,
    recent_changes,
    summary_metrics,
    trailing_window,
)
from .operators.price_average import composition_changes, price_average_index, simple_metrics
from .operators.quality import duplicate_keys, quality_report
from .operators.report import index_report
from .operators.reshape import long_to_tidy, normalize_bars, wide_to_long
from .operators.selection import global_row_number, select_members
from .operators.upsert import delete_by_key, refresh, upsert
from .sources.tables import TableStore, export_csv

__all__ = [
    "EqualWeightIndex",
    "TableStore",
    "composition_changes",
    "composition_on_date",
    "delete_by_key",
    "duplicate_keys",
    "equal_weight_index",
    "export_csv",
    "global_row_number",
    "index_report",
    "long_to_tidy",
    "normalize_bars",
    "performance_series",
    "price_average_index",
    "quality_report",
    "recent_changes",
    "refresh",
    "select_members",
    "simple_metrics",
    "summary_metrics",
    "trailing_window",
    "upsert",
    "wide_to_long",
]
