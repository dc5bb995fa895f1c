"""Run the batch job when a new input drop lands.

The reports themselves are batch snapshots; what is continuous upstream is
the arrival of input drops.  The scheduler the job was written for waits for
a file of the drop to appear and then submits the batch job.  Here that is a
Structured Streaming query over the landing area::

    <landing>/<yyyyMMdd>/{customers,products,orders,order_items,transactions}.csv

The stream watches for ``transactions.csv``, the last file written (the file source lists the landing
area and reads only file paths — the ``binaryFile`` content column is
pruned, so the trigger reads no data), and every micro-batch runs
the batch job once per new drop, with the folder name as the run date.
The streaming checkpoint records which drops were handled: a restarted
query continues with the drops it has not seen.  A drop whose reports fail,
or whose other tables are not there yet, fails the micro-batch, so it is
retried on restart; since the sink replaces
whole run-date partitions, a replay cannot duplicate a snapshot.
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll import pipeline
from tillroll.functions import parse_run_date
from tillroll.plans import REPORTS
from tillroll.session import checkpoint_root

log = logging.getLogger("tillroll.streaming")

#: The last of the five files that a drop is written in: when it is there, all are.
MARKER = "transactions.csv"
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arrivals(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of newly arrived marker files (one row per drop)."""
    reader = spark.readStream.format("binaryFile").schema(_FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # The marker may be one file or a directory of part files (as Spark
    # writes it); hidden and ``_temporary`` entries of an unfinished write
    # are never listed.
    return reader.load(f"{landing.rstrip('/')}/*/{MARKER}").select("path")


def drop_dirs(paths) -> list[tuple[str, str | None]]:
    """(drop directory, run date) for each marker path; the date is None
    for a folder whose name is not a yyyyMMdd date."""
    out = set()
    for p in paths:
        cut = p.rfind(f"/{MARKER}")
        if cut < 0:
            continue
        folder = p[:cut]
        name = folder.rsplit("/", 1)[-1]
        try:
            parse_run_date(name)
        except ValueError:
            out.add((folder, None))
            continue
        out.add((folder, name))
    return sorted(out, key=lambda x: (x[1] is None, x[1] or "", x[0]))


def default_checkpoint(spark: SparkSession, landing: str) -> str:
    """A stable per-landing-area location under the cluster checkpoint dir."""
    digest = hashlib.sha1(landing.rstrip("/").encode()).hexdigest()[:16]
    return f"{checkpoint_root(spark).rstrip('/')}/arrival-{digest}"


def start(spark: SparkSession, landing: str, output_base: str, *, reports=tuple(REPORTS),
          checkpoint_location: str | None = None, available_now: bool = True,
          processing_time: str = "5 minutes", max_files_per_trigger: int | None = None,
          materialize: str = "cache", parallelism: int = 1, write_mode: str = "overwrite",
          sink=None) -> StreamingQuery:
    """Start the arrival-triggered job.

    ``available_now`` handles every drop present now and stops (a scheduled
    run); otherwise the query keeps polling every ``processing_time``."""

    def process(batch: DataFrame, epoch_id: int) -> None:
        # part files of one drop collapse to one marker path on the executors;
        # the driver sees one row per new drop (bounded by drops, not data)
        marker = F.regexp_replace("path", f"/{MARKER}(/.*)?$", f"/{MARKER}").alias("path")
        paths = [r.path for r in batch.select(marker).distinct().toLocalIterator()]
        failed = []
        for folder, run_date in drop_dirs(paths):
            if run_date is None:
                # fails the batch after the other drops: skipped, it would be recorded as handled
                failed.append(f"{folder}: not a yyyyMMdd folder")
                continue
            cfg = pipeline.JobConfig(
                input_base=folder, output_base=output_base, run_date=run_date, reports=tuple(reports),
                materialize=materialize, parallelism=parallelism, write_mode=write_mode,
            )
            try:
                results = pipeline.run(spark, cfg, sink=sink)
            except Exception:  # noqa: BLE001 - one drop's failure leaves the others to run
                log.exception("drop %s failed", run_date)
                results = {"inputs": False}
            log.info("epoch %d drop %s: %s", epoch_id, run_date, results)
            failed += [f"{run_date}/{n}" for n, ok in results.items() if not ok]
        if failed:
            raise RuntimeError(f"reports failed, batch will be retried: {failed}")

    writer = (
        arrivals(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_location or default_checkpoint(spark, landing))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
