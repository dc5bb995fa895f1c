"""Benchmark: the six reports and the run-all job at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each report is timed stand-alone (scan -> raw mapping -> clean -> report,
executed with the ``noop`` sink so only the computation is measured), and
``run_all`` is the batch job: clean once, share the inputs, build all six
reports, submitted concurrently (``run_all_serial``: one after another, as
the reference does).  Median of ``BENCH_REPEAT`` (default 3) runs after one warm-up.
Prints one JSON line.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll import pipeline  # noqa: E402
from tillroll.catalog import RUN_DATE, cleaned  # noqa: E402
from tillroll.plans import REPORTS  # noqa: E402
from tillroll.session import local_session  # noqa: E402


def noop(df, _name=None):
    df.write.format("noop").mode("overwrite").save()


def time_report(spark, sf_dir, name):
    t0 = time.perf_counter()
    r = REPORTS[name]
    noop(r.transform(**cleaned(spark, sf_dir, *r.inputs), date=RUN_DATE))
    return time.perf_counter() - t0


def time_run_all(spark, sf_dir, parallelism=1):
    cfg = pipeline.JobConfig(sf_dir=sf_dir, run_date=RUN_DATE, materialize="cache", parallelism=parallelism)
    t0 = time.perf_counter()
    results = pipeline.run(spark, cfg, sink=noop)
    elapsed = time.perf_counter() - t0
    if not all(results.values()):
        raise RuntimeError(f"run_all failed: {results}")
    return elapsed


def main() -> None:
    logging.disable(logging.CRITICAL)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 2), app="tillroll-bench")

    time_run_all(spark, sf_dir, len(REPORTS))  # warm-up: JIT, file listing, class loading
    timings: dict[str, list[float]] = {name: [] for name in REPORTS}
    timings["run_all_serial"] = []
    timings["run_all"] = []
    for _ in range(repeat):
        for name in REPORTS:
            timings[name].append(time_report(spark, sf_dir, name))
        timings["run_all_serial"].append(time_run_all(spark, sf_dir, 1))
        timings["run_all"].append(time_run_all(spark, sf_dir, len(REPORTS)))
    med = {k: round(statistics.median(v), 3) for k, v in timings.items()}
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "run_all_sec",
        "value": med["run_all"],
        "unit": "sec",
        "queries": med,
        "reports_total_sec": round(sum(med[k] for k in REPORTS), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()
