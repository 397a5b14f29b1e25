"""Runs of the index tables: all or nothing, one state for all readers; writes that measure themselves and evaluate once."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import D, SF_SMALL, make_bars
from evenbasket.operators.price_average import PriceAverageIndex, composition_changes
from evenbasket.operators.quality import quality_report
from evenbasket.plans.build import build_index_tables, extend_index_tables, recompute_index_tables
from evenbasket.plans.registry import quality_batch
from evenbasket.schemas import RUN_TABLES
from evenbasket.sources.bars import daily_bars
from evenbasket.sources.runs import Run, compact, vacuum
from evenbasket.sources.tables import TableStore

DAYS = [D(2025, 1, 2), D(2025, 1, 3), D(2025, 1, 6), D(2025, 1, 7)]


@pytest.fixture()
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "wh"), f"r_{os.urandom(4).hex()}")
    s.create_all()
    yield s
    s.drop()


def bars_of(spark, days, closes=(10.0, 12.0, 18.0, 9.0)):
    return make_bars(spark, [(d, t, closes[DAYS.index(d)] * k, 100) for d in days for t, k in (("A", 1), ("B", 2))])


def state(store):
    return {t: sorted(map(tuple, store.read(t).collect()), key=str) for t in RUN_TABLES}


def catalog(store, name):
    cols = ", ".join(store.read(name).columns)
    return sorted(map(tuple, store.spark.sql(f"SELECT {cols} FROM `{store.namespace}`.`{name}`").collect()), key=str)


def counted(spark, df, column):
    """``df`` and the number of times a row of it was evaluated."""
    calls = spark.sparkContext.accumulator(0)

    def same(x):
        calls.add(1)
        return x

    kind = df.schema[column].dataType
    return df.withColumn(column, F.udf(same, kind).asNondeterministic()(column)), calls


def test_a_run_that_stops_between_two_writes_changes_nothing(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS[:2]))
    ix = build_index_tables(store, n=2)
    before = state(store)
    for done in (RUN_TABLES[:1], RUN_TABLES[:2]):
        run = Run(store, "extend", store.pinned().parameters, str(DAYS[2]))
        for name in done:
            run.write(name, getattr(ix, {"constituents": "constituents", "rebalancing_log": "rebalancing_log", "performance": "performance"}[name])().withColumn("date", F.date_add("date", 10)))
        with pytest.raises(ValueError, match="has not written"):
            run.publish()
        assert state(store) == before and all(catalog(store, t) == before[t] for t in RUN_TABLES)
    store.upsert("stock_data", bars_of(spark, DAYS[2:3]), keys=["date", "ticker"])
    extend_index_tables(store)
    assert [len(state(store)[t]) for t in RUN_TABLES] == [6, 4, 3]
    assert all(catalog(store, t) == state(store)[t] for t in RUN_TABLES)


def test_of_two_runs_from_one_state_the_first_counts(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS[:2]))
    ix = build_index_tables(store, n=2)
    runs = [Run(store, "build", {"n": k}) for k in (1, 2)]
    for run in runs:
        run.write("constituents", ix.constituents().limit(run.parameters["n"]))
        run.write("rebalancing_log", ix.rebalancing_log().limit(0))
        run.write("performance", ix.performance())
    runs[0].publish()
    with pytest.raises(RuntimeError, match="meanwhile"):
        runs[1].publish()
    assert store.read("constituents").count() == 1 and store.pinned().parameters == {"n": 1}


def test_readers_keep_the_state_they_pinned(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS))
    assert store.pinned().read("performance").count() == 0
    build_index_tables(store, n=2)
    old = store.pinned()
    levels = [r.index_value for r in old.read("performance").orderBy("date").collect()]
    store.upsert("stock_data", bars_of(spark, DAYS[1:2], closes=(0, 15.0)), keys=["date", "ticker"])
    recompute_index_tables(store, str(DAYS[1]))
    assert [r.index_value for r in old.read("performance").orderBy("date").collect()] == levels == pytest.approx([1000.0, 1200.0, 1800.0, 900.0])
    assert [r.index_value for r in store.read("performance").orderBy("date").collect()] == pytest.approx([1000.0, 1500.0, 1800.0, 900.0])
    kinds = [s["until"] for s in store.pinned().manifest["segments"]]
    assert kinds == [str(DAYS[1]), None]
    for t in RUN_TABLES:
        assert catalog(store, t) == state(store)[t]


def test_recompute_from_before_the_first_date_and_of_dates_that_lost_their_bars(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS))
    build_index_tables(store, n=2, notional=5_000_000.0)
    store.delete("stock_data", spark.createDataFrame([(DAYS[3],)], "date date"), ["date"])
    recompute_index_tables(store, str(DAYS[2]))
    assert [r.total_notional for r in store.read("performance").orderBy("date").collect()] == pytest.approx([5e6, 6e6, 9e6])
    recompute_index_tables(store, "2000-01-01")
    assert [r.total_notional for r in store.read("performance").orderBy("date").collect()] == pytest.approx([5e6, 6e6, 9e6])
    assert store.pinned().manifest["kind"] == "build" and store.pinned().parameters["notional"] == 5e6


def test_another_catalog_compaction_and_cleaning(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS[:1]))
    build_index_tables(store, n=2, missing="carry")
    for day in DAYS[1:]:
        store.upsert("stock_data", bars_of(spark, [day]), keys=["date", "ticker"])
        extend_index_tables(store)
    want = state(store)
    assert len(store.pinned().manifest["segments"]) == 4 and store.pinned().parameters["missing"] == "carry"
    with pytest.raises(ValueError, match="missing"):
        store.upsert("stock_data", make_bars(spark, [(D(2025, 1, 8), "A", 1.0, 1)]), keys=["date", "ticker"])
        extend_index_tables(store, missing="drop")
    other = TableStore(spark, store.root, f"r_{os.urandom(4).hex()}")
    other.create_all()
    assert all(catalog(other, t) == want[t] for t in RUN_TABLES)
    compact(store)
    assert state(store) == want and len(store.pinned().manifest["segments"]) == 1
    assert len(vacuum(store, keep=1)) == 4 and state(store) == want
    assert all(catalog(store, t) == want[t] for t in RUN_TABLES)
    other.sync("constituents")
    assert catalog(other, "constituents") == want["constituents"]
    spark.sql(f"DROP DATABASE `{other.namespace}` CASCADE")


def test_index_tables_are_written_by_runs_only(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS))
    build_index_tables(store, n=2)
    frame = store.read("constituents")
    for write in (lambda: store.overwrite("constituents", frame), lambda: store.put_partitions("constituents", frame), lambda: store.append("performance", store.read("performance")), lambda: store.delete("constituents", frame, ["date"]), lambda: store.upsert("constituents", frame, ["date", "ticker"])):
        with pytest.raises(ValueError, match="written by runs"):
            write()


def test_an_upsert_measures_its_batch_and_evaluates_it_once(spark, store):
    batch, calls = counted(spark, quality_batch(daily_bars(spark, SF_SMALL)), "volume")
    store.upsert("stock_data", batch, keys=["date", "ticker"])
    seen = store.observed["stock_data"]
    assert calls.value == seen["n_rows"] > seen["n_keys"]
    want = quality_report(quality_batch(daily_bars(spark, SF_SMALL))).agg(*[F.sum(c).alias(c) for c in ("n_bars", "n_tickers", "n_duplicate_keys", "n_null_close", "n_null_market_cap")]).first()
    assert tuple(want) == tuple(seen[c] for c in ("n_rows", "n_keys", "n_duplicate_keys", "n_null_close", "n_null_market_cap"))
    assert seen["n_nan_close"] and seen["n_nonpositive_close"] and not seen["n_null_keys"]
    assert len(seen["dates"]) == store.read("stock_data").select("date").distinct().count()


def test_writes_evaluate_their_rows_once(spark, store):
    bars = bars_of(spark, DAYS)
    for write in (store.overwrite, store.put_partitions, store.append):
        rows, calls = counted(spark, bars, "volume")
        write("stock_data", rows)
        assert calls.value == 8 and store.observed["stock_data"]["n_rows"] == 8
    assert store.read("stock_data").count() == 16  # appended to the same dates
    run = Run(store, "build", {})
    rows, calls = counted(spark, bars.select("date", "ticker", F.lit(0.5).alias("weight"), F.col("close").alias("shares_held"), F.col("close").alias("price"), F.col("close").alias("notional")), "price")
    run.write("constituents", rows)
    assert calls.value == 8 and run.dates["constituents"] == [str(d) for d in DAYS]


def test_reads_come_from_the_catalog_and_prune_partitions(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS))
    one = store.read("stock_data").where(F.col("date") == F.lit(DAYS[1]))
    assert one.count() == 2
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in text


def test_the_legacy_index_reads_bars_once(spark):
    n = daily_bars(spark, SF_SMALL).count()
    bars, calls = counted(spark, daily_bars(spark, SF_SMALL), "volume")
    bars = bars.withColumn("market_cap", F.col("market_cap") + F.col("volume") * 0)
    index = PriceAverageIndex(bars, 5, align="trading", days=30)
    assert index.performance().count() == 30 and index.changes().count() > 0 and calls.value == n
    for align, days in (("calendar", None), ("trading", 30)):
        bars, calls = counted(spark, daily_bars(spark, SF_SMALL), "volume")
        composition_changes(bars.withColumn("market_cap", F.col("market_cap") + F.col("volume") * 0), 5, align, days).collect()
        assert calls.value == n


def test_dates_without_a_name_to_hold_stay_in_the_legacy_calendar(spark):
    rows = make_bars(spark, [(DAYS[0], "A", 10.0, 1), (DAYS[1], "A", 0.0, 1), (DAYS[1], "B", 0.0, 1), (DAYS[2], "A", 12.0, 1)])
    got = sorted(tuple(map(str, r)) for r in composition_changes(rows, 1, align="trading").collect())
    assert got == [("2025-01-02", "A", "added"), ("2025-01-03", "A", "removed"), ("2025-01-06", "A", "added")]


def test_types_of_a_run_are_those_of_the_table(spark, store):
    store.overwrite("stock_data", bars_of(spark, DAYS))
    build_index_tables(store, n=2)
    assert store.read("rebalancing_log").schema["date"].dataType == T.DateType()
