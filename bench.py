"""Benchmark: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced to completion with the ``noop`` sink (full execution, no
driver collection) and timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparktab.plans import catalog  # noqa: E402
from sparktab.session import get_spark  # noqa: E402



def small_workflow(spark, sf_dir: str) -> float:
    """Seconds of the whole linear workflow (J5) on 545 rows of customers as CSV, warm."""
    from sparktab.plans.jobs import JobSpec, run_offline_workflow
    from sparktab.session import scratch_path

    path = scratch_path(spark, "bench-customers")
    spark.read.parquet(f"{sf_dir}/customer.parquet").orderBy("c_custkey").limit(545).coalesce(1).write.option(
        "header", True).csv(path)
    best = float("inf")
    for _ in range(3):
        spec = JobSpec(path, "c_acctbal", scratch_path(spark, "bench-ledger"), exclude=("c_name",), data_format="csv",
                       index_column="c_custkey")
        t0 = time.perf_counter()
        run_offline_workflow(spark, spec)
        best = min(best, time.perf_counter() - t0)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    log_dir = os.environ.get("BENCH_EVENT_LOG")  # optional: Spark event log for stage times
    conf = ({"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
             "spark.eventLog.compress": "false"} if log_dir else None)
    spark = get_spark(f"local[{cpus}]", app="sparktab-bench", shuffle_partitions=int(cpus) * 2, conf=conf)
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("sparktab.spread", "true")  # the test tables are files of one row group
    names = list(catalog.queries())
    only = os.environ.get("BENCH_QUERIES")
    if only:
        names = [n for n in names if n in only.split(",")]
    # warm-up: JVM, Python workers, parquet footers
    catalog.queries()["split_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)  # lets tools/stage_times.py attribute stages
        t0 = time.perf_counter()
        df = catalog.queries()[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    extra = {} if only else {"workflow_545_rows": small_workflow(spark, sf_dir)}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "extra": extra, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
