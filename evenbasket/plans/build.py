"""Jobs that write the index tables.

Every job writes constituents, log and performance as one run (see
sources/runs.py): readers see the state before until all three are there.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import date_grain
from ..operators.equal_weight import EqualWeightIndex, equal_weight_index
from ..operators.price_average import PriceAverageIndex
from ..operators.report import index_report, ranked_holdings
from ..operators.upsert import refresh_batch
from ..schemas import BASE_INDEX_VALUE, CARRY_DAYS, DEFAULT_MEMBERS, DROP, INITIAL_NOTIONAL, STOCK_DATA_KEY, TRAILING_DAYS
from ..session import reliable_checkpoint
from ..sources.runs import Run
from ..sources.tables import TableStore


def build_index_tables(
    store: TableStore,
    bars: DataFrame | None = None,
    n: int = DEFAULT_MEMBERS,
    base: float = BASE_INDEX_VALUE,
    notional: float = INITIAL_NOTIONAL,
    missing: str = DROP,
    lookback: int = CARRY_DAYS,
) -> EqualWeightIndex:
    """(Re)compute constituents, rebalancing_log and performance from `stock_data`."""
    stored = bars is None
    bars = store.read("stock_data") if stored else bars
    # a stored table is rescanned cheaply (pruned columns, date partitions);
    # derived bars are checkpointed once
    ix = equal_weight_index(bars, n, base, notional, materialize="derived" if stored else True, missing=missing, lookback=lookback)
    run = Run(store, "build", {"n": n, "base": base, "notional": notional, "missing": missing, "lookback": lookback})
    run.write("constituents", ix.constituents())
    run.write("rebalancing_log", ix.rebalancing_log())
    run.write("performance", ix.performance())
    run.publish()
    return ix


def extend_index_tables(
    store: TableStore,
    bars: DataFrame | None = None,
    n: int | None = None,
    base: float | None = None,
    notional: float | None = None,
    missing: str | None = None,
) -> EqualWeightIndex | None:
    """Continue the stored index over the trading dates after its last date.

    The chain goes on from what is stored: the holdings of the last date (names
    and prices as they were bought), its index value and its total notional.
    Bars of indexed dates are not read again, so a back-fill of new names or a
    corrected close there changes nothing that was held; names enter when the
    next date is selected. To let a correction take effect, use
    ``recompute_index_tables`` from its date. The work grows with the new
    dates, not with the history (performance, a row per date, is written whole).

    Parameters are those of the stored index; ``base``, ``notional`` and
    ``missing``, if given, must agree with it, and ``n`` must not be below the
    stored holdings' count. Returns None when there is nothing new; builds from
    scratch when the store is empty.
    """
    return _continue(store, None, bars, n, base, notional, missing)


def recompute_index_tables(store: TableStore, day: str, bars: DataFrame | None = None, n: int | None = None) -> EqualWeightIndex | None:
    """Compute the index anew from ``day`` on (after corrected bars), on top of what is stored before it.

    Until the new dates are published, readers see the old ones. Dates from
    ``day`` on that have no bars any more go.
    """
    return _continue(store, day, bars, n, None, None, None)


def _continue(store: TableStore, day: str | None, bars: DataFrame | None, n: int | None, base: float | None, notional: float | None, missing: str | None) -> EqualWeightIndex | None:
    now = store.pinned()
    own = {"n": DEFAULT_MEMBERS, "base": BASE_INDEX_VALUE, "notional": INITIAL_NOTIONAL, "missing": DROP, "lookback": CARRY_DAYS} | now.parameters
    given = {k: v for k, v in {"base": base, "notional": notional, "missing": missing}.items() if v is not None}
    n = own["n"] if n is None else n
    kept = now.read("performance")
    if day is not None:
        kept = kept.where(F.col("date") < F.lit(day).cast("date"))
    state = kept.orderBy(F.col("date").desc()).limit(1).collect()  # one row
    if not state:
        own |= given
        return build_index_tables(store, bars, n, own["base"], own["notional"], own["missing"], own["lookback"])
    for name, value in given.items():
        if value != own[name]:
            raise ValueError(f"the stored index was built with {name} {own[name]}, not {value}")
    last = state[0]
    held = now.read("constituents").where(F.col("date") == F.lit(last.date))
    if (count := held.count()) > n:
        raise ValueError(f"the stored index holds {count} names on {last.date}, more than n = {n}")
    from_store = bars is None
    bars = store.read("stock_data") if from_store else bars
    recent = bars.where(F.col("date") > F.lit(last.date))
    since = str(recent.agg(F.min("date")).first()[0] or "")
    if day is not None:
        since = min(day, since or day)
    elif not since:
        return None
    # Seeded at the stored level itself; a level of 0 stays 0 (and has no return).
    lost = last.index_value == 0
    ix = equal_weight_index(
        recent,
        n,
        own["base"] if lost else last.index_value,
        own["notional"] if lost else last.total_notional,
        materialize="derived" if from_store else True,
        chain0=0.0 if lost else 1.0,
        held=held,
        missing=own["missing"],
        lookback=own["lookback"],
    )
    later = F.col("date") > F.lit(last.date)
    run = Run(store, "extend" if day is None else "recompute", own | {"n": n}, since)
    run.write("constituents", ix.constituents().where(later))
    run.write("rebalancing_log", ix.rebalancing_log().where(later))
    run.write("performance", kept.unionByName(ix.performance().where(later)))
    run.publish()
    return ix


def stored_report(store: TableStore) -> DataFrame:
    """The index report of the stored tables: a row per date, members in rank order."""
    now = store.pinned()  # one state for both tables
    members = ranked_holdings(now.read("constituents"), store.read("stock_data"))
    return index_report(now.read("performance"), members)


def build_legacy_tables(
    store: TableStore,
    bars: DataFrame | None = None,
    n: int = DEFAULT_MEMBERS,
    days: int | None = TRAILING_DAYS,
    align: str = "calendar",
) -> None:
    """The v1 tables: price-average index and composition log over the trailing window."""
    bars = store.read("stock_data") if bars is None else bars
    index = PriceAverageIndex(bars, n, align, days)
    store.overwrite("index_performance", index.performance())
    store.overwrite("index_composition_log", index.changes())


def refresh_legacy_tables(
    store: TableStore,
    touched: Sequence,
    n: int = DEFAULT_MEMBERS,
    days: int | None = TRAILING_DAYS,
    align: str = "calendar",
) -> list[str]:
    """Bring the v1 tables up to date after bars of the ``touched`` dates changed (came, were corrected or went); the dates whose log was computed anew.

    A date's members depend on its own bars alone, and its log on them and on the
    date compared with it. So only the touched dates and their successors are
    computed, from the bars of these dates and of those before them; the result is
    that of a rebuild. Dates that fell out of the trailing window go. The dates come from
    the catalog's partitions, not from bars. (A date on which nothing can be held has no
    row and is computed each time.)
    """
    dates = store.dates("stock_data")
    day = {d: dt.date.fromisoformat(d) for d in [*dates, *map(str, touched)]}
    least = str(day[dates[-1]] - dt.timedelta(days=days)) if dates and days is not None else ""
    window = [d for d in dates if d >= least]
    if align == "trading":
        before, after = dict(zip(dates[1:], dates, strict=False)), lambda d: next((x for x in dates[bisect_right(dates, d) :]), None)
    else:
        before, after = {d: str(day[d] - dt.timedelta(days=1)) for d in dates}, lambda d: str(day[d] + dt.timedelta(days=1))
    own = {str(d) for d in touched}
    known = {str(r[0]) for r in store.read("index_performance").select("date").collect()}  # a row per date
    # A window whose last dates went reaches farther back: dates without a row are computed too.
    wanted = sorted((own | {x for d in own if (x := after(d))} | (set(window) - known)) & set(window))
    bars = store.read("stock_data").where(F.col("date").isin([day.get(d) or dt.date.fromisoformat(d) for d in {*wanted, *(before.get(d) for d in wanted)} - {None}]))
    index = PriceAverageIndex(bars, n, align)
    only = store.spark.createDataFrame([(day[d],) for d in wanted], "date date")
    stored = store.read("index_performance").where(F.col("date").isin([day[d] for d in window]) & ~F.col("date").isin([day[d] for d in wanted]))
    performance = reliable_checkpoint(stored.unionByName(index.performance().join(date_grain(only), "date", "left_semi")))  # a row per date
    gone = [d for d in store.dates("index_composition_log") if d not in window]
    store.replace_dates("index_composition_log", index.changes(only), sorted({*wanted, *gone, *(own - set(window))}))
    store.overwrite("index_performance", performance)
    return wanted


def daily_refresh(store: TableStore, landed: DataFrame, universe: DataFrame, as_of: str) -> str:
    """Back-fill unseen universe tickers and land the day's bars into `stock_data`."""
    batch = refresh_batch(store.read("stock_data"), landed, universe, as_of)
    return store.upsert("stock_data", batch, keys=STOCK_DATA_KEY, order="_seq")


def open_store(spark: SparkSession, root: str, namespace: str = "evenbasket") -> TableStore:
    store = TableStore(spark, root, namespace)
    store.create_all()
    return store
