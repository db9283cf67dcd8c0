"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line.  Each query is forced with a ``noop`` write (full
execution, no transfer of result rows to Python).  ``raw_landing``,
``fact_build`` and ``zone_day_build`` are the one-time warehouse build
(adapter joins -> monthly raw files; clean, de-duplicate, key, write the
fact; collapse to zone x day); every other query reads those written tables,
as the analyses of a warehouse do.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "profile_key_cardinality",
    "exclusion_counts",
    "dq_gate_report",
    "did_volume",
    "did_means",
    "placebo_did",
    "parallel_trends",
    "did_boundary_sensitivity",
    "segment_top25",
    "segment_concentration",
    "mart_metric_slices",
    "mart_hour_heatmap",
    "serving_fact",
    "did_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE

    from cordon.plans import catalog
    from cordon.plans.warehouse import tpch_warehouse
    from cordon.session import local_session

    spark = local_session(cpus=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    qs = catalog.queries()
    times: dict[str, float] = {}

    # JVM class loading / JIT of the first jobs, reported on its own line
    t0 = time.perf_counter()
    spark.read.parquet(f"{sf_dir}/region.parquet").groupBy("r_name").count().collect()
    times["session_warmup"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    wh = tpch_warehouse(spark, sf_dir, catalog.CFG)
    wh.raw_path  # land the raw trips once (monthly Parquet)
    times["raw_landing"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    wh.fact_path  # build and write the fact once
    times["fact_build"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    wh.zone_day_path  # the shared zone x day aggregate, written once
    times["zone_day_build"] = round(time.perf_counter() - t0, 3)

    for name in names:
        t = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
