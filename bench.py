"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run end to end from the raw parquet tables (bar aggregation,
member selection, index chain, output) into the `noop` sink: one warm-up, then
the median of $BENCH_REPEAT runs. N = 100 members, the reference's setting.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evenbasket.operators import metrics as M  # noqa: E402
from evenbasket.operators import price_average as V1  # noqa: E402
from evenbasket.operators.equal_weight import equal_weight_index  # noqa: E402
from evenbasket.operators.quality import quality_report  # noqa: E402
from evenbasket.operators.selection import select_members  # noqa: E402
from evenbasket.operators.upsert import upsert  # noqa: E402
from evenbasket.plans import registry as R  # noqa: E402
from evenbasket.plans.registry import upsert_batch  # noqa: E402
from evenbasket.session import checkpoint_dir, local_session  # noqa: E402
from evenbasket.sources.bars import daily_bars, monthly_bars  # noqa: E402

N = 100


def build_queries(sf: str):
    def ix1(spark):
        return equal_weight_index(monthly_bars(spark, sf), n=N, materialize=True)

    def ix2(spark):
        return equal_weight_index(daily_bars(spark, sf), n=N, materialize=True)

    return {
        "performance_monthly": lambda s: ix1(s).performance(),
        "rebalancing_log_monthly": lambda s: ix1(s).rebalancing_log(),
        "constituents_monthly": lambda s: ix1(s).constituents(),
        "performance_daily": lambda s: ix2(s).performance(),
        "rebalancing_log_daily": lambda s: ix2(s).rebalancing_log(),
        "summary_metrics_daily": lambda s: (lambda ix: M.summary_metrics(ix.performance(), ix.rebalancing_log(), 30, "max"))(ix2(s)),
        "top_n_per_date_monthly": lambda s: select_members(monthly_bars(s, sf), N),
        "price_average_index_monthly": lambda s: V1.price_average_index(monthly_bars(s, sf), N),
        "composition_changes_monthly": lambda s: V1.composition_changes(monthly_bars(s, sf), N, align="trading"),
        "upsert_bars_daily": lambda s: (lambda b: upsert(b, upsert_batch(b), order="_seq"))(daily_bars(s, sf)),
        "quality_report_daily": lambda s: quality_report(daily_bars(s, sf)),
        # jobs over stored tables, with the registered queries' 20 members
        "delete_by_key_monthly": lambda s: R.q_delete_by_key(s, sf),
        "table_upsert_daily": lambda s: R.q_table_upsert(s, sf),
        "performance_extended_monthly": lambda s: R.q_performance_extended(s, sf),
        "daily_workflow_monthly": lambda s: R.q_daily_workflow_extended(s, sf),
        "performance_carry_sparse": lambda s: R.q_performance_carry(s, sf),
    }


def run_once(spark, fn) -> float:
    t0 = time.perf_counter()
    fn(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, app="evenbasket-bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    results = {}
    for name, fn in build_queries(sf).items():
        run_once(spark, fn)  # warm-up
        results[name] = round(statistics.median(run_once(spark, fn) for _ in range(repeat)), 4)
    total = round(sum(results.values()), 4)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": results,
                "sf": float(sf_name) if sf_name.replace(".", "").isdigit() else sf,
                "cpus": cpus,
                "repeat": repeat,
                "members": N,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
