"""The dashboard's queries as SQL table functions over a store's tables.

``register_functions`` makes them temporary functions of the session, so that SQL
users call them with a date and a window; the parameters become filters on the
partition column, as if they stood in the query.

    SELECT * FROM index_metrics(DATE'2024-01-30', 30)
    SELECT * FROM composition_on(DATE'2024-01-30') ORDER BY weight DESC
"""

from __future__ import annotations

from ..sources.tables import TableStore

FUNCTIONS = {
    "performance_window": (
        "as_of DATE, days INT DEFAULT 30",
        "date DATE, index_value DOUBLE, daily_return DOUBLE, is_change_day BOOLEAN",
        """SELECT p.date, p.index_value, p.daily_return, l.date IS NOT NULL
FROM {performance} p LEFT JOIN (SELECT DISTINCT date FROM {rebalancing_log} WHERE date BETWEEN date_sub(as_of, days) AND as_of) l ON l.date = p.date
WHERE p.date BETWEEN date_sub(as_of, days) AND as_of""",
    ),
    "index_metrics": (
        "as_of DATE, days INT DEFAULT 30",
        "cumulative_return DOUBLE, avg_daily_return DOUBLE, change_days BIGINT, composition_change_days BIGINT",
        """SELECT (max_by(index_value, date) / min_by(index_value, date) - 1) * 100, avg(daily_return) * 100,
  (SELECT count(DISTINCT date) FROM {rebalancing_log}),
  (SELECT count(DISTINCT date) FROM {rebalancing_log} WHERE action_type IN ('ADD', 'REMOVE'))
FROM {performance} WHERE date BETWEEN date_sub(as_of, days) AND as_of""",
    ),
    "composition_on": (
        "day DATE",
        "ticker STRING, weight DOUBLE, shares_held DOUBLE, price DOUBLE, notional DOUBLE",
        "SELECT ticker, weight, shares_held, price, notional FROM {constituents} WHERE date = day",
    ),
    "changes_between": (
        "first DATE, last DATE",
        "date DATE, ticker STRING, action_type STRING, shares_change DOUBLE, notional_change DOUBLE, price DOUBLE",
        "SELECT date, ticker, action_type, shares_change, notional_change, price FROM {rebalancing_log} WHERE date BETWEEN first AND last",
    ),
}


def register_functions(store: TableStore) -> list[str]:
    """Create the table functions over ``store`` (those of another store give way); their names."""
    tables = {t: f"`{store.namespace}`.`{t}`" for t in ("performance", "rebalancing_log", "constituents")}
    for name, (parameters, columns, body) in FUNCTIONS.items():
        store.spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body.format(**tables)}")
    return list(FUNCTIONS)
