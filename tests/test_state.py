"""Stored state: resuming the index, keys, drops, partitions; vendor frames and payloads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import D, make_bars
from evenbasket.operators.reshape import long_to_tidy, normalize_bars, wide_to_long
from evenbasket.plans.build import build_index_tables, extend_index_tables, recompute_index_tables
from evenbasket.sources.landing import read_json_days, read_time_series, read_wide_bars
from evenbasket.sources.tables import TableStore


@pytest.fixture()
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "wh"), f"t_{os.urandom(4).hex()}")
    s.create_all()
    yield s
    s.drop()


def counts_agree(store, name):
    got = store.spark.sql(f"SELECT count(*) FROM `{store.namespace}`.`{name}`").first()[0]
    assert got == store.read(name).count()
    return got


DAYS = [D(2025, 1, 2), D(2025, 1, 3), D(2025, 1, 6)]


def test_backfilled_name_enters_on_the_next_date(spark, store):
    store.overwrite("stock_data", make_bars(spark, [(d, "A", 10.0, 100) for d in DAYS[:2]]))
    build_index_tables(store, n=1, notional=5_000_000.0)
    later = [(DAYS[0], "C", 1.0, 10**6), (DAYS[1], "C", 1.0, 10**6), (DAYS[2], "A", 12.0, 100), (DAYS[2], "C", 3.0, 10**6)]
    store.upsert("stock_data", make_bars(spark, later), keys=["date", "ticker"])
    extend_index_tables(store, n=1)
    perf = [tuple(r) for r in store.read("performance").orderBy("date").collect()]
    assert [p[1] for p in perf] == [1000.0, 1000.0, pytest.approx(1200.0)]
    assert [p[2] for p in perf] == [5e6, 5e6, pytest.approx(6e6)]
    log = {(r.ticker, r.action_type) for r in store.read("rebalancing_log").where(F.col("date") == DAYS[2]).collect()}
    assert log == {("C", "ADD"), ("A", "REMOVE")}
    # holdings(t) = holdings(t-1) + shares_change
    cons = {(r.date, r.ticker): r.shares_held for r in store.read("constituents").collect()}
    for r in store.read("rebalancing_log").collect():
        before = cons.get((DAYS[DAYS.index(r.date) - 1], r.ticker), 0.0)
        assert cons.get((r.date, r.ticker), 0.0) == pytest.approx(before + r.shares_change)
    assert extend_index_tables(store, n=1) is None


def test_corrected_close_counts_from_the_next_date_or_when_recomputed(spark, store):
    rows = [(DAYS[0], "A", 10.0, 100), (DAYS[1], "A", 12.0, 100), (DAYS[2], "A", 18.0, 100)]
    store.overwrite("stock_data", make_bars(spark, rows[:2]))
    build_index_tables(store, n=1)
    store.upsert("stock_data", make_bars(spark, [(DAYS[1], "A", 9.0, 100), rows[2]]), keys=["date", "ticker"])
    extend_index_tables(store, n=1)
    levels = lambda: [r.index_value for r in store.read("performance").orderBy("date").collect()]
    assert levels() == [1000.0, pytest.approx(1200.0), pytest.approx(1800.0)]
    recompute_index_tables(store, str(DAYS[1]), n=1)
    assert levels() == [1000.0, pytest.approx(900.0), pytest.approx(1800.0)]
    for name in ("constituents", "rebalancing_log", "performance"):
        counts_agree(store, name)


def test_parameters_of_the_stored_index_are_checked(spark, store):
    store.overwrite("stock_data", make_bars(spark, [(DAYS[0], t, 10.0, 100) for t in "AB"]))
    build_index_tables(store, n=2, notional=5_000_000.0)
    store.upsert("stock_data", make_bars(spark, [(DAYS[1], "A", 10.0, 100)]), keys=["date", "ticker"])
    with pytest.raises(ValueError, match="notional"):
        extend_index_tables(store, n=2, notional=1_000_000.0)
    with pytest.raises(ValueError, match="n = 1"):
        extend_index_tables(store, n=1)


def test_null_keys_are_refused(spark, store):
    bars = make_bars(spark, [(DAYS[0], "A", 10.0, 100)])
    store.overwrite("stock_data", bars)
    with pytest.raises(ValueError, match="NULL"):
        store.upsert("stock_data", make_bars(spark, [(None, "C", 1.0, 1)]), keys=["date", "ticker"])
    with pytest.raises(ValueError, match="NULL"):
        store.upsert("stock_data", make_bars(spark, [(DAYS[0], None, 1.0, 1)]), keys=["date", "ticker"])
    assert counts_agree(store, "stock_data") == 1


def test_sql_and_read_agree_and_drop_removes_rows(spark, store):
    store.overwrite("stock_data", make_bars(spark, [(d, t, 10.0, 100) for d in DAYS[:2] for t in "AB"]))
    assert counts_agree(store, "stock_data") == 4
    again = TableStore(spark, store.root, f"t_{os.urandom(4).hex()}")
    again.create_all()
    assert counts_agree(again, "stock_data") == 4
    spark.sql(f"DROP DATABASE `{again.namespace}` CASCADE")  # the catalog's entries alone
    store.upsert("stock_data", make_bars(spark, [(DAYS[2], "A", 1.0, 1)]), keys=["date", "ticker"])
    assert counts_agree(store, "stock_data") == 5
    store.delete("stock_data", spark.createDataFrame([(DAYS[0],)], "date date"), ["date"])
    assert counts_agree(store, "stock_data") == 3
    shown = [r[0] for r in spark.sql(f"SHOW PARTITIONS `{store.namespace}`.stock_data").collect()]
    assert shown == [f"date={DAYS[1]}", f"date={DAYS[2]}"]
    store.drop()
    store.create_all()
    assert counts_agree(store, "stock_data") == 0


def test_vendor_frame_with_odd_tickers_and_nan(spark):
    wide = spark.createDataFrame(
        [("2025-01-02", "1.5", "NaN", "2", "7", "x", "3"), ("2025-01-03", None, "4", "NaN", "nan", "5", "")],
        ["Date", "Open|BRK.B", "Close|BRK.B", "Volume|BRK.B", "Close|A`B", "Volume|A`B", "High|A`B"],
    )
    got = {(str(r.date), r.ticker): r for r in normalize_bars(wide).collect()}
    assert len(got) == 4
    assert (got["2025-01-02", "BRK.B"].open, got["2025-01-02", "BRK.B"].close, got["2025-01-02", "BRK.B"].volume) == (1.5, None, 2)
    assert (got["2025-01-03", "BRK.B"].close, got["2025-01-03", "BRK.B"].volume) == (4.0, None)
    assert (got["2025-01-02", "A`B"].close, got["2025-01-02", "A`B"].high, got["2025-01-03", "A`B"].close) == (7.0, 3.0, None)


def test_columns_without_a_field_and_duplicate_cells_are_refused(spark):
    wide = spark.createDataFrame([("2025-01-02", 1.0, 2.0)], ["Date", "Close|A", "Total"])
    with pytest.raises(ValueError, match="Total"):
        wide_to_long(wide)
    long = spark.createDataFrame([("2025-01-02", "Open", "A", 10.0), ("2025-01-02", "Open", "A", 15.0)], "Date string, Price string, Ticker string, Value double")
    with pytest.raises(Exception, match="duplicate cells"):
        long_to_tidy(long).collect()


def test_thousands_of_tickers(spark, tmp_path):
    tickers = [f"T{i}" for i in range(3000)]
    fields = ["Open", "High", "Low", "Close", "Volume"]
    folder = tmp_path / "wide"
    folder.mkdir()
    header = ",".join(["Date", *[f"{f}|{t}" for t in tickers for f in fields]])
    (folder / "a.csv").write_text(header + "\n2025-01-02" + ",1.5" * (len(tickers) * len(fields)) + "\n")
    got = read_wide_bars(spark, str(folder)).agg(F.count("*"), F.count_distinct("ticker"), F.sum("close")).first()
    assert tuple(got) == (3000, 3000, 4500.0)


def test_json_shapes(spark, tmp_path):
    day = {"ticker": "A", "date": "2025-01-02", "open": 1.0, "close": 2.0, "market_cap": 3.0}
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({"results": r}) for r in ([day, day | {"ticker": "B"}], day | {"ticker": "C"}, [])) + "\n")
    assert sorted(r.ticker for r in read_json_days(spark, str(folder)).collect()) == ["A", "B", "C"]
    (folder / "b.json").write_text("{broken\n")
    with pytest.raises(Exception, match="no results"):
        read_json_days(spark, str(folder)).collect()


def test_time_series(spark, tmp_path):
    folder = tmp_path / "series"
    folder.mkdir()
    series = {"2025-01-02": {"1. open": "1.5", "4. close": "2", "5. volume": "7"}, "2025-01-03": {"close": "NaN"}}
    (folder / "a.json").write_text(json.dumps({"ticker": "A", "series": series}) + "\n")
    got = sorted(map(tuple, read_time_series(spark, str(folder)).collect()), key=str)
    assert got == [("A", D(2025, 1, 2), 1.5, None, None, 2.0, 7), ("A", D(2025, 1, 3), None, None, None, None, None)]
