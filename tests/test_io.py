"""Table store lifecycle, table upsert/delete, landed files, streaming ingest."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import D, SF_SMALL, make_bars, F3_ROWS
from evenbasket.operators.upsert import upsert
from evenbasket.plans.build import build_index_tables, build_legacy_tables, daily_refresh
from evenbasket.plans.registry import upsert_batch
from evenbasket.sources.bars import daily_bars, monthly_bars, supplier_universe, read_table
from evenbasket.sources.landing import read_json_days, read_universe, read_wide_bars, write_json_days
from evenbasket.sources.runs import Run
from evenbasket.sources.tables import TableStore, export_csv, read_csv_export
from evenbasket.schemas import PERFORMANCE
from evenbasket.streaming.ingest import ingest_available


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture()
def store(spark, tmp_path):
    s = TableStore(spark, str(tmp_path / "wh"), f"t_{os.urandom(4).hex()}")
    s.create_all()
    yield s
    s.drop()


def test_lifecycle(store):
    assert store.exists() and store.exists("stock_data")
    assert store.read("performance").count() == 0
    store.drop("performance")
    assert not store.exists("performance")
    store.drop()
    assert not store.exists()


def test_build_tables_from_store(spark, store, f3_bars):
    store.overwrite("stock_data", f3_bars)
    ix = build_index_tables(store, n=2)
    assert store.read("performance").count() == 4
    assert store.read("rebalancing_log").count() == 8
    assert rows(store.read("constituents")) == rows(ix.constituents())
    build_legacy_tables(store, n=2, days=30, align="calendar")
    assert store.read("index_composition_log").count() == 6
    # the registered namespace answers SQL
    got = spark.sql(f"SELECT count(*) AS c FROM `{store.namespace}`.constituents WHERE date = DATE'2025-01-06'").first()
    assert got.c == 2


def test_table_upsert_equals_frame_upsert(store, spark):
    bars = daily_bars(spark, SF_SMALL)
    store.overwrite("stock_data", bars)
    batch = upsert_batch(bars)
    store.upsert("stock_data", batch, keys=["date", "ticker"], order="_seq")
    assert rows(store.read("stock_data")) == rows(upsert(bars, batch, order="_seq"))
    # idempotent, and a swap repeated from the staged copy changes nothing
    stage = store.upsert("stock_data", batch, keys=["date", "ticker"], order="_seq", keep_stage=True)
    assert rows(store.read("stock_data")) == rows(upsert(bars, batch, order="_seq"))
    store.swap_in("stock_data", stage)
    assert rows(store.read("stock_data")) == rows(upsert(bars, batch, order="_seq"))


def test_table_delete_including_emptied_partition(store, f3_bars, spark):
    store.overwrite("stock_data", f3_bars)
    doomed = spark.createDataFrame(
        [(D(2025, 1, 6), "A"), (D(2025, 1, 6), "B"), (D(2025, 1, 7), "C")], "date date, ticker string"
    )
    store.delete("stock_data", doomed, keys=["date", "ticker"])
    left = store.read("stock_data")
    assert left.count() == 11 - 3
    assert left.where("date = DATE'2025-01-06'").count() == 0


def test_daily_refresh_into_store(store, spark):
    landed = monthly_bars(spark, SF_SMALL)
    store.overwrite("stock_data", landed.where("date < '2001-11-01'"))
    universe = supplier_universe(read_table(spark, SF_SMALL, "supplier"))
    daily_refresh(store, landed, universe, "2001-11-01")
    assert rows(store.read("stock_data")) == rows(landed)


def test_landed_files(spark, tmp_path):
    wide = tmp_path / "wide.csv"
    wide.write_text("Date,Close|AAA,Open|AAA,Volume|AAA,High|AAA,Low|AAA\n2025-01-02,10,9,100,11,8\n2025-01-03,n/a,10,50,12,9\n")
    bars = {r.date: r for r in read_wide_bars(spark, str(wide)).collect()}
    assert bars[D(2025, 1, 2)].market_cap == 1000.0 and bars[D(2025, 1, 2)].open == 9.0
    assert bars[D(2025, 1, 3)].close is None and bars[D(2025, 1, 3)].volume == 50
    uni = tmp_path / "universe.csv"
    uni.write_text("Symbol,Security\nAAA,A Corp\n BBB ,B Corp\nAAA,dup\n")
    assert sorted(r.Symbol for r in read_universe(spark, str(uni)).collect()) == ["AAA", "BBB"]
    env = tmp_path / "env.json"
    env.write_text(json.dumps({"results": [{"ticker": "AAA", "date": "2025-01-02", "open": 1, "close": 2, "market_cap": 3}]}) + "\n")
    got = read_json_days(spark, str(env)).collect()
    assert [tuple(r) for r in got] == [("AAA", D(2025, 1, 2), 1.0, 2.0, 3.0)]


def test_json_pages_are_bounded(spark, tmp_path):
    bars = daily_bars(spark, SF_SMALL)
    out = str(tmp_path / "pages")
    write_json_days(bars, out, page_size=4)
    env = spark.read.json(out)
    sizes = [r.n for r in env.select(F.size("results").alias("n")).collect()]
    assert max(sizes) <= 16 and sum(sizes) == bars.count()
    assert rows(read_json_days(spark, out)) == rows(bars.select("ticker", "date", "open", "close", "market_cap"))


def test_csv_export_round_trip(spark, tmp_path, f3_bars):
    from evenbasket.operators.equal_weight import equal_weight_index

    perf = equal_weight_index(f3_bars, n=2).performance()
    path = str(tmp_path / "perf_csv")
    export_csv(perf, path, order=["date"])
    assert rows(read_csv_export(spark, path, PERFORMANCE)) == rows(perf)


def test_streaming_ingest_matches_batch_upsert(spark, store, tmp_path):
    bars = daily_bars(spark, SF_SMALL)
    landing = tmp_path / "landing"
    bars.withColumn("seq", F.lit(-1).cast("bigint")).write.parquet(str(landing / "d1"))
    batch = upsert_batch(bars).withColumnRenamed("_seq", "seq").withColumn("seq", F.col("seq").cast("bigint"))
    batch.write.parquet(str(landing / "d2"))
    ckpt = str(tmp_path / "ckpt")
    ingest_available(spark, str(landing) + "/*", store, ckpt)  # one micro-batch: seq decides
    want = rows(upsert(bars, upsert_batch(bars), order="_seq"))
    assert rows(store.read("stock_data")) == want
    # a second run finds nothing new and leaves the table unchanged
    ingest_available(spark, str(landing) + "/*", store, ckpt)
    assert rows(store.read("stock_data")) == want


def test_streaming_later_drop_wins_across_micro_batches(spark, store, tmp_path):
    import time

    landing = tmp_path / "drops"
    base = make_bars(spark, F3_ROWS[:3])
    for i, price in enumerate([1.0, 2.0, 3.0]):
        base.withColumn("close", F.lit(price)).withColumn("seq", F.lit(0).cast("bigint")).coalesce(1).write.parquet(
            str(landing / f"drop{i}")
        )
        time.sleep(1.1)  # distinct modification times: arrival order
    ingest_available(spark, str(landing) + "/*", store, str(tmp_path / "ck"), max_files=1)
    assert {r.close for r in store.read("stock_data").collect()} == {3.0}


@pytest.mark.parametrize("split", ["1997-01-01", "2001-10-01"])
def test_extend_equals_full_rebuild(spark, tmp_path, split):
    from evenbasket.operators.equal_weight import equal_weight_index
    from evenbasket.plans.build import extend_index_tables

    store = TableStore(spark, str(tmp_path / "wh"), f"x_{os.urandom(4).hex()}")
    store.create_all()
    bars = monthly_bars(spark, SF_SMALL)
    store.overwrite("stock_data", bars.where(F.col("date") < split))
    build_index_tables(store, n=5)
    store.upsert("stock_data", bars.where(F.col("date") >= split), keys=["date", "ticker"])
    if split == "2001-10-01":
        # a previous attempt died after writing the new holdings: the re-run must not duplicate them
        first = equal_weight_index(bars, n=5).constituents().where(F.col("date") >= split)
        Run(store, "extend", store.pinned().parameters, split).write("constituents", first)
    assert extend_index_tables(store, n=5) is not None
    assert extend_index_tables(store, n=5) is None  # nothing new the second time
    full = equal_weight_index(bars, n=5)
    for name, got, want, keys in [
        ("performance", store.read("performance"), full.performance(), ["date"]),
        ("constituents", store.read("constituents"), full.constituents(), ["date", "ticker"]),
        ("rebalancing_log", store.read("rebalancing_log"), full.rebalancing_log(), ["date", "ticker"]),
    ]:
        got_rows, want_rows = got.collect(), want.collect()
        assert len(got_rows) == len(want_rows), name  # no duplicated dates
        g = {tuple(r[k] for k in keys): r for r in got_rows}
        w = {tuple(r[k] for k in keys): r for r in want_rows}
        assert set(g) == set(w), name
        for k, r in w.items():
            for c, v in r.asDict().items():
                x = g[k][c]
                if isinstance(v, float):
                    assert x == pytest.approx(v, rel=1e-12, abs=1e-9), (name, k, c)
                else:
                    assert x == v, (name, k, c)
    store.drop()


def test_wide_csv_landing_round_trip(spark, tmp_path):
    from evenbasket.operators.reshape import bars_to_wide

    bars = monthly_bars(spark, SF_SMALL)
    path = str(tmp_path / "wide_csv")
    bars_to_wide(bars).write.option("header", True).csv(path)
    back = read_wide_bars(spark, path).where(F.col("close").isNotNull())
    cols = ["date", "ticker", "open", "high", "low", "close", "volume"]
    assert rows(back.select(cols)) == rows(bars.select(cols))
