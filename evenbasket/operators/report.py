"""Index report rows: date, return and the member list in rank order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .selection import rank_order


def ranked_holdings(constituents: DataFrame, bars: DataFrame) -> DataFrame:
    """(date, ticker, rank) of stored holdings, in the order they were selected.

    The market cap comes from the bar of the same date (unique keys on both
    sides); the window holds one date's members, at most ``n`` rows.
    """
    caps = bars.select("date", "ticker", "market_cap")
    by_date = Window.partitionBy("date").orderBy(*rank_order())
    return constituents.select("date", "ticker").join(caps, ["date", "ticker"], "left").select("date", "ticker", F.row_number().over(by_date).cast("bigint").alias("rank"))


def index_report(perf: DataFrame, members: DataFrame) -> DataFrame:
    """(Date, IndexReturn, Top100Stocks): one row per date.

    The ticker list is aggregated per date over at most ``n`` members (bounded
    by the index size, not by the data) and joined by ', ' in rank order.
    """
    lists = members.groupBy("date").agg(
        F.expr("listagg(ticker, ', ') WITHIN GROUP (ORDER BY rank)").alias("Top100Stocks")
    )
    return perf.join(lists, "date", "left").select(  # both one row per date
        F.col("date").alias("Date"),
        F.col("daily_return").alias("IndexReturn"),
        "Top100Stocks",
    )


def render_report(report: DataFrame, decimals: int = 10) -> DataFrame:
    """(Date, text): each report row as the three lines of the printed report."""
    # The printed report's line labels.
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Date: "), F.date_format("Date", "yyyy-MM-dd")),
        F.concat(F.lit("Index Return: "), F.format_number("IndexReturn", decimals)),
        F.concat(F.lit("Top 100 Stocks: "), F.coalesce("Top100Stocks", F.lit(""))),
    )
    return report.select("Date", text.alias("text"))


def export_report_text(report: DataFrame, path: str, decimals: int = 10) -> None:
    """Write the rendered report as text files, records in date order."""
    render_report(report, decimals).orderBy("Date").select("text").write.mode("overwrite").text(path)
