"""``python -m tillroll.streaming --landing URI --output-base URI [--continuous]``"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from tillroll import streaming
from tillroll.plans import REPORTS


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="Run the batch job for every new drop in a landing area")
    p.add_argument("--landing", required=True, help="URI holding <yyyyMMdd>/<table>.csv drops")
    p.add_argument("--output-base", required=True)
    p.add_argument("--reports", default=",".join(REPORTS))
    p.add_argument("--checkpoint-location", default=None)
    p.add_argument("--continuous", action="store_true", help="keep polling instead of stopping when caught up")
    p.add_argument("--interval", default="5 minutes")
    p.add_argument("--parallelism", type=int, default=1)
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, stream=sys.stdout, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("tillroll-arrivals").getOrCreate()
    q = streaming.start(
        spark, a.landing, a.output_base, reports=tuple(r for r in a.reports.split(",") if r),
        checkpoint_location=a.checkpoint_location, available_now=not a.continuous,
        processing_time=a.interval, parallelism=a.parallelism,
    )
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
