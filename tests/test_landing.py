"""Vendor responses with a quarantine, SQL table functions, incremental v1 tables."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import D, make_bars
from evenbasket.plans.build import build_index_tables, build_legacy_tables, refresh_legacy_tables
from evenbasket.plans.sql import FUNCTIONS, register_functions
from evenbasket.sources.landing import land_payloads
from evenbasket.sources.tables import TableStore


@pytest.fixture()
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "wh"), f"l_{os.urandom(4).hex()}")
    s.create_all()
    yield s
    s.drop()


def day(ticker="A", date="2025-01-02", **fields):
    return {"ticker": ticker, "date": date, "open": 1.5, "close": 2.5, "market_cap": 7.0} | fields


def test_every_line_is_a_bar_or_refused(spark, tmp_path):
    lines = [
        json.dumps({"results": [day(), day("B", close="3.25"), day("C", volume=10.6)]}),
        json.dumps({"results": day("D")}),
        json.dumps([day("E", **{"4. Close": 9})]),
        json.dumps({"ticker": "F", "series": {"2025-01-02": {"1. open": "1", "4. close": "2", "5. volume": "7"}, "2025-01-03": {"close": "x"}, "soon": {"close": 1}}}),
        "{broken",
        "   ",
        "[1, {}]",
        "null",
        "7",
        json.dumps({"results": []}),
        json.dumps({"results": None}),
        json.dumps({"error": "limit reached"}),
        json.dumps({"results": [day(None), day(" "), day("G", "2025-13-01"), day("H", None), day("I", close=None), day("J", close="NaN"), day("K")]}),
        json.dumps({"series": {"2025-01-02": {"close": 1}}}),
        json.dumps({"results": [day("L", open={"x": 1}, market_cap="?")]}),
        '{"results":[' + ",".join(json.dumps(day(f"X{k}")) for k in range(3000)) + "]}",
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines) + "\n")
    bars, refused = land_payloads(spark, str(tmp_path / "in"))
    assert bars.columns == ["ticker", "date", "open", "high", "low", "close", "volume", "market_cap"]
    got = {r.ticker: r for r in bars.where("ticker NOT LIKE 'X%'").collect()}
    assert sorted(got) == ["A", "B", "C", "D", "E", "F", "K", "L"] and bars.where("ticker LIKE 'X%'").count() == 3000
    assert (got["B"].close, got["C"].volume, got["F"].open, got["F"].volume, got["F"].market_cap) == (3.25, 11, 1.0, 7, None)
    assert (got["L"].open, got["L"].close, got["L"].market_cap) == (None, 2.5, None)
    assert {r.date for r in bars.collect()} == {D(2025, 1, 2)}
    why = sorted((r.reason, r.payload[:24]) for r in refused.collect())
    assert [w for w, _ in why] == sorted(
        ["not JSON"] + ["no records"] * 5 + ["no ticker"] * 5 + ["no date"] * 3 + ["no close"] * 3
    ), why
    assert ("not JSON", "{broken") in why and ("no close", '{"2025-01-03":{"close":"') in why
    held = [r for r in refused.collect() if r.reason == "no date" and r.ticker == "G"]
    assert json.loads(held[0].payload) == day("G", "2025-13-01")


def test_landing_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("")
    bars, refused = land_payloads(spark, str(tmp_path / "in"))
    assert bars.count() == 0 and refused.count() == 0


def test_sql_functions_filter_partitions(spark, store, f3_bars):
    store.overwrite("stock_data", f3_bars)
    build_index_tables(store, n=2)
    assert register_functions(store) == list(FUNCTIONS)
    held = spark.sql("SELECT ticker, notional FROM composition_on(DATE'2025-01-03') ORDER BY ticker")
    assert [tuple(r) for r in held.collect()] == [("A", pytest.approx(550_000)), ("C", pytest.approx(550_000))]
    text = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text and "(date" in text and "= 2025-01-03" in text
    metrics = spark.sql("SELECT * FROM index_metrics(DATE'2025-01-07')").first()
    assert tuple(metrics) == (pytest.approx(-45), pytest.approx(-10), 3, 2)
    assert [r.is_change_day for r in spark.sql("SELECT * FROM performance_window(DATE'2025-01-06', 3) ORDER BY date").collect()] == [True, True]
    changes = spark.sql("SELECT * FROM changes_between(DATE'2025-01-06', DATE'2025-01-06')")
    assert sorted(r.action_type for r in changes.collect()) == ["ADD", "REBALANCE", "REMOVE"]
    assert "PartitionFilters: [isnotnull(date" in changes._jdf.queryExecution().executedPlan().toString()
    joined = spark.sql("SELECT count(*) AS n FROM (VALUES (DATE'2025-01-02'), (DATE'2025-01-03')) AS t(day), LATERAL composition_on(day)")
    assert joined.first().n == 4


def tables(store):
    return {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in ("index_performance", "index_composition_log")}


def files(store):
    root = store.path("index_composition_log")
    return {f for d, _, names in os.walk(root) for f in (os.path.join(d, n) for n in names) if f.endswith(".parquet")}


@pytest.mark.parametrize("align, days", [("trading", None), ("calendar", None), ("calendar", 9), ("trading", 9)])
def test_refreshed_legacy_tables_equal_a_rebuild(spark, store, align, days):
    rnd = random.Random(3)
    dates = [D(2025, 1, 1) + dt.timedelta(days=k) for k in range(16) if k % 7 not in (3, 4)]
    bars = lambda some: make_bars(spark, [(d, t, float(rnd.randint(0, 9)), rnd.randint(1, 99)) for d in some for t in "ABCDE" if rnd.random() < 0.8])
    store.overwrite("stock_data", bars(dates[:-3]))
    build_legacy_tables(store, n=2, days=days, align=align)
    changes = [lambda d=d: store.upsert("stock_data", bars([d]), ["date", "ticker"]) for d in (dates[5], dates[-3], dates[0], dates[-1])]
    for change in changes:
        change()
        before = files(store)
        done = refresh_legacy_tables(store, store.observed["stock_data"]["dates"], n=2, days=days, align=align)
        assert len(done) <= 2
        kept = {f for f in before if not any(f"date={d}" in f for d in done)}
        if days is None:
            assert kept <= files(store)  # nothing else was rewritten
        got = tables(store)
        build_legacy_tables(store, n=2, days=days, align=align)
        assert got == tables(store)
    gone = spark.createDataFrame([(dates[6],), (dates[-1],)], "date date")
    store.delete("stock_data", gone, ["date"])
    refresh_legacy_tables(store, [dates[6], dates[-1]], n=2, days=days, align=align)
    got = tables(store)
    build_legacy_tables(store, n=2, days=days, align=align)
    assert got == tables(store)
    cols = spark.sql(f"SELECT count(*) FROM `{store.namespace}`.index_composition_log").first()[0]
    assert cols == len(got["index_composition_log"])
