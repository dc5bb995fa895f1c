"""Scale probe: the batch job on synthetic inputs generated on the executors.

Usage: python scripts/scale_run.py [--data DIR] [--run-all-only] [scale ...]      (default: 1000 3000)

With ``--data DIR`` the generated tables are written once as parquet under
``DIR/scale-<scale>/`` (reused when present) and the timings read them back,
so generation cost is excluded.

``scale`` multiplies the upstream default table sizes (1000 customers, 500
products, 5000 orders, 2000 items, 5000 transactions); items are generated
at 3 per order to resemble real baskets.  Inputs are planned, not written,
so the probe needs no disk beyond Spark's shuffle files.  Prints per-report
seconds (each report cleaning its own inputs) and the batch job (clean once,
share inputs and intermediates) run serially and concurrently.
"""

from __future__ import annotations

import json
import logging
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll import pipeline  # noqa: E402
from tillroll.plans import REPORTS  # noqa: E402
from tillroll.plans.cleaning import clean_all  # noqa: E402
from tillroll.session import local_session  # noqa: E402
from tillroll.sources import synthetic  # noqa: E402


def main() -> None:
    logging.disable(logging.CRITICAL)
    args = sys.argv[1:]
    data = None
    run_all_only = "--run-all-only" in args
    args = [a for a in args if a != "--run-all-only"]
    if "--data" in args:
        i = args.index("--data")
        data = args[i + 1]
        del args[i:i + 2]
    scales = [float(a) for a in args] or [1000.0, 3000.0]
    spark = local_session(8, shuffle_partitions=64, app="tillroll-scale")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    for scale in scales:
        sizes = {k: int(v * scale) for k, v in synthetic.DEFAULT_SIZES.items()}
        if scale != 1:  # scale 1 keeps the upstream defaults exactly (2000 items)
            sizes["order_items"] = 3 * sizes["orders"]
        raw = synthetic.generate(spark, sizes=sizes, seed=11, partitions=64)
        if data:
            base = os.path.join(data, f"scale-{int(scale)}")
            for t, df in raw.items():
                path = os.path.join(base, t)
                if not os.path.exists(os.path.join(path, "_SUCCESS")):
                    df.write.mode("overwrite").parquet(path)
            raw = {t: spark.read.parquet(os.path.join(base, t)) for t in raw}
        total_rows = sum(sizes.values())
        out = {}
        for name, rep in ([] if run_all_only else REPORTS.items()):
            clean = clean_all({t: raw[t] for t in rep.inputs})
            t0 = time.perf_counter()
            rep.transform(**clean, date="20250101").write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t0, 2)
        for label, par in (("run_all_serial", 1), ("run_all", len(REPORTS))):
            cfg = pipeline.JobConfig(run_date="20250101", parallelism=par, materialize="cache")
            t0 = time.perf_counter()
            pipeline.run(spark, cfg, sink=lambda df, _n: df.write.format("noop").mode("overwrite").save(), raw=raw)
            out[label] = round(time.perf_counter() - t0, 2)
        print(json.dumps({"scale": scale, "rows": sizes, "input_rows": total_rows, "seconds": out,
                          "reports_total_sec": round(sum(out.get(n, 0.0) for n in REPORTS), 2)}))
    spark.stop()


if __name__ == "__main__":
    main()
