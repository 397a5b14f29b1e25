"""Equal-weight index over all dates at once.

Each trading day t holds the top-N names C(t) at weight 1/n(t) and is fully
rebalanced, so the day-by-day recurrence collapses to

    g(t') = sum over i in C(t) with a price on t' of P_i(t') / P_i(t), divided by n(t)
    V(t)  = V0 * product of g(s) for s <= t          (g(first date) = 1)
    notional_i(t) = V(t) / n(t),  shares_i(t) = notional_i(t) / P_i(t)

where t' is the next trading date. A held name without a price on t'
contributes nothing (its value is lost), or, under the ``carry`` policy, its last
known price. The only sequential step is the
running product over one row per date; everything else is joins and
aggregations at (date, ticker) grain.

Shuffle plan for bars B (dates x tickers), members M (dates x N):
  * top-N: partial WindowGroupLimit before the shuffle on date (skew-safe);
  * revaluation: M shifted to t' LEFT JOIN B on (date, ticker) -- unique keys
    on both sides, so no hot key; AQE broadcasts M when it is small;
  * growth: partial/final aggregate on date;
  * performance: one row per date; broadcast back by AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import (
    ACTION_ADD,
    ACTION_REBALANCE,
    ACTION_REMOVE,
    BASE_INDEX_VALUE,
    CARRY,
    CARRY_DAYS,
    DEFAULT_MEMBERS,
    DROP,
    INITIAL_NOTIONAL,
)
from ..functions.columns import safe_ratio
from ..session import reliable_checkpoint
from .asof import asof_join
from .calendar import date_grain, trading_calendar
from .selection import select_members


def known_price(c: str) -> Column:
    """A price that is a number (zero is one)."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def revaluation(members: DataFrame, calendar: DataFrame, bars: DataFrame, missing: str = DROP, lookback: int = CARRY_DAYS) -> DataFrame:
    """Yesterday's members priced today.

    (date, ticker, prev_date, prev_price, prev_n, cur_price, ratio) where ``date``
    is the next trading date after ``prev_date``. A ticker without a price that
    day has cur_price NULL and ratio 0 under ``missing="drop"``; under "carry" it
    has its last known price of at most ``lookback`` days before, if any.
    """
    if missing not in (DROP, CARRY):
        raise ValueError(f"missing must be {DROP!r} or {CARRY!r}, not {missing!r}")
    carried = (
        members.join(date_grain(calendar.select("date", "next_date")), "date")
        .where(F.col("next_date").isNotNull())
        .select(
            F.col("next_date").alias("date"),
            "ticker",
            F.col("date").alias("prev_date"),
            F.col("price").alias("prev_price"),
            F.col("n_members").alias("prev_n"),
        )
    )
    prices = bars.select("date", "ticker", known_price("close").alias("cur_price"))
    # Inner join first: the held side (dates x N) is the one AQE can broadcast,
    # so bars stream past it without a shuffle. A LEFT join straight onto bars
    # could only build on the bars side and would shuffle all of them.
    priced = carried.select("date", "ticker").join(prices, ["date", "ticker"])
    reval = with_ratio(carried.join(priced, ["date", "ticker"], "left"))
    return reval if missing == DROP else carry_prices(reval, members, bars, lookback)


def with_ratio(reval: DataFrame) -> DataFrame:
    return reval.withColumn("ratio", F.coalesce(safe_ratio("cur_price", "prev_price"), F.lit(0.0)))


def carry_prices(reval: DataFrame, members: DataFrame, bars: DataFrame, lookback: int = CARRY_DAYS) -> DataFrame:
    """``reval`` with the last known price where the day has none.

    Only the unpriced rows look back, and only bars of their tickers within the
    bound are read into the join. Prices at which names are held count as known
    (those of a seed have no bar).
    """
    known = bars.select("date", "ticker", known_price("close").alias("last_price")).unionByName(members.select("date", "ticker", F.col("price").alias("last_price")))
    gaps = reval.where(F.col("cur_price").isNull()).select("date", "ticker")
    found = asof_join(gaps, known, ["ticker"], "last_price", lookback).select("date", "ticker", "last_price")
    filled = reval.join(found, ["date", "ticker"], "left")
    return with_ratio(filled.withColumn("cur_price", F.coalesce("cur_price", "last_price"))).drop("last_price")


def growth_by_date(reval: DataFrame) -> DataFrame:
    """(date, growth, n_held, n_missing): mean price relative of yesterday's basket."""
    return reval.groupBy("date").agg(
        (F.sum("ratio") / F.count(F.lit(1))).alias("growth"),
        F.count(F.lit(1)).alias("n_held"),
        F.count_if(F.col("cur_price").isNull()).alias("n_missing"),
    )


def chain_performance(
    calendar: DataFrame,
    growth: DataFrame,
    base: float = BASE_INDEX_VALUE,
    notional: float = INITIAL_NOTIONAL,
    chain0: float = 1.0,
) -> DataFrame:
    """(date, prev_date, growth, index_value, total_notional, daily_return).

    First date: growth 1, return 0. A date whose basket was empty or wholly
    unpriced has growth 0; after a zero value the return is NULL (0/0).
    The running product uses an explicit ROWS frame (the default is RANGE) and
    runs over one row per date. ``chain0`` seeds the chain (the level of the
    first date relative to ``base``) when continuing a stored index.
    """
    g = (
        calendar.select("date", "prev_date")
        .join(date_grain(growth.select("date", F.col("growth").alias("g"))), "date", "left")
        .withColumn(
            "growth",
            F.when(F.col("prev_date").isNull(), F.lit(1.0)).otherwise(F.coalesce(F.col("g"), F.lit(0.0))),
        )
    )
    w = Window.orderBy("date")
    running = F.product("growth").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chained = g.withColumn("chain", running if chain0 == 1.0 else F.lit(float(chain0)) * running)
    chained = chained.withColumn("prev_chain", F.lag("chain").over(w))
    return chained.select(
        "date",
        "prev_date",
        "growth",
        (F.lit(float(base)) * F.col("chain")).alias("index_value"),
        (F.lit(float(notional)) * F.col("chain")).alias("total_notional"),
        F.when(F.col("prev_date").isNull(), F.lit(0.0))
        .when(F.col("prev_chain") == 0, F.lit(None).cast("double"))
        .otherwise(F.col("growth") - 1.0)
        .alias("daily_return"),
    )


def holdings(members: DataFrame, perf: DataFrame) -> DataFrame:
    """Constituents after rebalancing: (date, ticker, weight, shares_held, price, notional, prev_date)."""
    weight = F.lit(1.0) / F.col("n_members")
    target = F.col("total_notional") * F.col("weight")
    return (
        members.join(date_grain(perf.select("date", "prev_date", "total_notional")), "date")
        .withColumn("weight", weight)
        .withColumn("notional", target)
        .select(
            "date",
            "ticker",
            "weight",
            (F.col("notional") / F.col("price")).alias("shares_held"),
            "price",
            "notional",
            "prev_date",
        )
    )


def previous_positions(reval: DataFrame, perf: DataFrame) -> DataFrame:
    """Yesterday's positions moved to today: (date, ticker, prev_shares, cur_price).

    Shares are recomputed with exactly the holdings formula, so they equal the
    stored ones bit for bit.
    """
    prev_perf = perf.select(F.col("date").alias("prev_date"), F.col("total_notional").alias("prev_total"))
    weight = F.lit(1.0) / F.col("prev_n")
    return reval.join(date_grain(prev_perf), "prev_date").select(
        "date",
        "ticker",
        ((F.col("prev_total") * weight) / F.col("prev_price")).alias("prev_shares"),
        "cur_price",
    )


def trade_log(cons: DataFrame, prev_pos: DataFrame) -> DataFrame:
    """One row per (date, ticker) traded: ADD, REMOVE or REBALANCE.

    A single full outer join replaces the three set differences. No rows on the
    first date. A removed name without a price today has NULL price and notional.
    """
    today = cons.where(F.col("prev_date").isNotNull()).select(
        "date", "ticker", "shares_held", "price", "notional"
    )
    j = today.join(prev_pos, ["date", "ticker"], "full_outer")
    in_today = F.col("shares_held").isNotNull()
    in_prev = F.col("prev_shares").isNotNull()
    action = (
        F.when(in_today & in_prev, F.lit(ACTION_REBALANCE))
        .when(in_today, F.lit(ACTION_ADD))
        .otherwise(F.lit(ACTION_REMOVE))
    )
    rebalance_change = F.col("shares_held") - F.col("prev_shares")
    shares_change = (
        F.when(in_today & in_prev, rebalance_change)
        .when(in_today, F.col("shares_held"))
        .otherwise(-F.col("prev_shares"))
    )
    notional_change = (
        F.when(in_today & in_prev, rebalance_change * F.col("price"))
        .when(in_today, F.col("notional"))
        .otherwise(-(F.col("prev_shares") * F.col("cur_price")))
    )
    return j.select(
        "date",
        "ticker",
        action.alias("action_type"),
        shares_change.alias("shares_change"),
        notional_change.alias("notional_change"),
        F.when(in_today, F.col("price")).otherwise(F.col("cur_price")).alias("price"),
    )


@dataclass
class EqualWeightIndex:
    """DataFrames of one index definition over ``bars``.

    ``bars`` must hold one row per (date, ticker), as the stored table does
    (the upsert keeps keys unique; ``quality_report`` flags duplicates).

    ``materialize`` checkpoints the frames several outputs share, so each is
    computed once and every output starts from written files:

    * ``"derived"``: members (dates x N), the revaluation (dates x N) and the
      date-grain performance. Outputs then never touch bars again. Use this
      when ``bars`` is a stored table: rescanning a few pruned columns is
      cheaper than copying the largest table.
    * ``True``: the projected bars as well, for bars derived by an expensive
      aggregation (the fixture adapters over raw fact tables).
    * ``False``: everything stays lazy.

    ``held`` (date, ticker, price) seeds the chain with positions of one date
    before ``bars``: that date starts the calendar and its members are the held
    names at their prices, whatever ``bars`` would select for it; they are ranked
    by ticker, as holdings carry no market cap.

    ``missing`` and ``lookback`` say what a held name without a price is worth
    (see ``revaluation``).
    """

    bars: DataFrame
    n: int = DEFAULT_MEMBERS
    base: float = BASE_INDEX_VALUE
    notional: float = INITIAL_NOTIONAL
    materialize: bool | str = False
    chain0: float = 1.0
    held: DataFrame | None = None
    missing: str = DROP
    lookback: int = CARRY_DAYS

    def __post_init__(self) -> None:
        if self.materialize not in (False, True, "derived"):
            raise ValueError("materialize must be False, True or 'derived'")
        keep = lambda df: df
        small = reliable_checkpoint if self.materialize else keep
        big = (lambda df: reliable_checkpoint(df, "bars", large=True)) if self.materialize is True else keep
        self.bars = big(self.bars.select("date", "ticker", "close", "market_cap"))
        dates = self.bars.select("date")
        members = select_members(self.bars, self.n).select("date", "ticker", "price", "rank", "n_members")
        if self.held is not None:
            one = Window.partitionBy("date")  # the members of one date
            rank, count = F.row_number().over(one.orderBy("ticker")).cast("bigint"), F.count(F.lit(1)).over(one)
            seed = self.held.select("date", "ticker", "price", rank.alias("rank"), count.alias("n_members"))
            dates, members = dates.union(seed.select("date")), members.unionByName(seed)
        self.calendar = small(trading_calendar(dates))
        self.members = small(members)
        if self.missing not in (DROP, CARRY):
            raise ValueError(f"missing must be {DROP!r} or {CARRY!r}, not {self.missing!r}")
        self.reval = small(revaluation(self.members, self.calendar, self.bars))
        if self.missing == CARRY:  # on top of the written rows: the gaps are known then
            self.reval = small(carry_prices(self.reval, self.members, self.bars, self.lookback))
        self.growth = growth_by_date(self.reval)
        self.perf = small(chain_performance(self.calendar, self.growth, self.base, self.notional, self.chain0))
        self.cons = holdings(self.members, self.perf)

    def performance(self) -> DataFrame:
        return self.perf.select("date", "index_value", "total_notional", "daily_return")

    def constituents(self) -> DataFrame:
        return self.cons.select("date", "ticker", "weight", "shares_held", "price", "notional")

    def initial_constituents(self) -> DataFrame:
        return self.cons.where(F.col("prev_date").isNull()).select(
            "date", "ticker", "weight", "shares_held", "price", "notional"
        )

    def daily_value(self) -> DataFrame:
        """Yesterday's holdings at today's prices: (date, prev_date, held_value, n_held, n_missing)."""
        prev_pos = self.reval.join(
            date_grain(self.perf.select(F.col("date").alias("prev_date"), F.col("total_notional").alias("prev_total"))),
            "prev_date",
        )
        shares = (F.col("prev_total") * (F.lit(1.0) / F.col("prev_n"))) / F.col("prev_price")
        return prev_pos.groupBy("date", "prev_date").agg(
            F.coalesce(F.sum(shares * F.col("cur_price")), F.lit(0.0)).alias("held_value"),
            F.count(F.lit(1)).alias("n_held"),
            F.count_if(F.col("cur_price").isNull()).alias("n_missing"),
        )

    def rebalancing_log(self) -> DataFrame:
        return trade_log(self.cons, previous_positions(self.reval, self.perf))


def equal_weight_index(
    bars: DataFrame,
    n: int = DEFAULT_MEMBERS,
    base: float = BASE_INDEX_VALUE,
    notional: float = INITIAL_NOTIONAL,
    materialize: bool | str = False,
    start: str | None = None,
    end: str | None = None,
    chain0: float = 1.0,
    held: DataFrame | None = None,
    missing: str = DROP,
    lookback: int = CARRY_DAYS,
) -> EqualWeightIndex:
    """The index over the trading dates of ``bars`` within [start, end] (both
    inclusive, either open); the first trading date in range is the base date.
    The range is a filter on ``date``, so it reaches the scan / partition pruning."""
    if start is not None:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.where(F.col("date") <= F.lit(end).cast("date"))
    return EqualWeightIndex(bars, n, base, notional, materialize, chain0, held, missing, lookback)
