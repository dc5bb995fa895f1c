"""The batch job — read and clean the inputs once, share them across
the selected reports, write each report to its date-partitioned table, and
report per-report success.

    spark-submit -m tillroll.pipeline --input-base s3a://bucket/raw \\
        --output-base s3a://bucket/warehouse --date 20240131 [--reports a,b]

Sharing the cleaned inputs: every cleaned table read by two or more of the
selected reports is materialised once.  ``cache`` (the default) persists it
MEMORY_AND_DISK — blocks lost with an executor are recomputed from lineage.
``checkpoint`` writes it to the cluster's ``spark.checkpoint.dir`` (shared
storage) and cuts the lineage: a lost executor costs a re-read, not a
re-clean, and the hash partitioning on the table key is kept, so later joins
on that key still skip their shuffle.  ``table`` writes it as parquet to the same
shared folder and reads it back: durable and columnar (each report reads
only its columns).  Tables de-duplicated on their join key are bucketed on
it, aligned with their de-duplication shuffle (one file per bucket) and
read back through the catalog, so they stay co-partitioned — a join of two
tables bucketed on ``order_id`` needs no shuffle.  ``none`` re-plans each report from the
sources (Catalyst then prunes each input to the columns that report reads).
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession

from tillroll import schemas, sinks
from tillroll.functions import parse_run_date
from tillroll.plans import DERIVED, REPORTS
from tillroll.plans.cleaning import clean_all, loss_counts
from tillroll.session import checkpoint_root, configure, remove_path, scratch_path
from tillroll.sources import csv as csv_source
from tillroll.sources import testdata

log = logging.getLogger("tillroll")

MATERIALIZE = ("cache", "checkpoint", "table", "none")

# Bucketing key of each shared cleaned table: its de-duplication key, which
# is also the key its reports join it on.  The table comes out of its
# de-duplication hash-partitioned on that key, so with as many buckets as
# that shuffle has partitions each write task holds whole buckets: one file
# per bucket, no extra shuffle.  Items (de-duplicated on the item id, joined
# on other keys) and the item roll-up are written as plain parquet.
BUCKET_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "transactions": "order_id",
}


def shuffle_partitions(spark: SparkSession) -> int:
    """Initial partition count of a shuffle (AQE's initial number if set)."""
    initial = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(initial or spark.conf.get("spark.sql.shuffle.partitions"))


@dataclass
class JobConfig:
    """Job parameters.  Exactly one input: ``input_base`` (one CSV per table,
    ``<base>/<table>.csv``) or ``sf_dir`` (the TPC-H-style test tables)."""

    output_base: str | None = None
    input_base: str | None = None
    sf_dir: str | None = None
    run_date: str = field(default_factory=lambda: dt.date.today().strftime("%Y%m%d"))
    reports: tuple[str, ...] = tuple(REPORTS)
    write_mode: str = "overwrite"
    output_format: str = "parquet"
    materialize: str = "cache"
    infer_schema: bool = False
    parallelism: int = 1


    def validate(self, require_input: bool = True) -> JobConfig:
        parse_run_date(self.run_date)
        if require_input and (self.input_base is None) == (self.sf_dir is None):
            raise ValueError("give exactly one of input_base / sf_dir")
        unknown = [r for r in self.reports if r not in REPORTS]
        if unknown:
            raise ValueError(f"unknown reports: {unknown}; known: {list(REPORTS)}")
        if self.materialize not in MATERIALIZE:
            raise ValueError(f"materialize must be one of {MATERIALIZE}")
        if self.write_mode not in ("overwrite", "append"):
            raise ValueError("write_mode must be overwrite or append")
        if self.parallelism < 1:
            raise ValueError("parallelism must be >= 1")
        return self


def parse_args(argv: list[str] | None = None) -> JobConfig:
    p = argparse.ArgumentParser(description="Clean the sales inputs and build the reports")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--input-base", help="URI holding <table>.csv for the five raw tables")
    src.add_argument("--sf-dir", help="directory of TPC-H-style parquet test tables")
    p.add_argument("--output-base", required=True, help="URI under which report tables are written")
    p.add_argument("--date", default=dt.date.today().strftime("%Y%m%d"), help="run date yyyyMMdd")
    p.add_argument("--reports", default=",".join(REPORTS), help="comma-separated report names")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])
    p.add_argument("--format", default="parquet")
    p.add_argument("--materialize", default="cache", choices=MATERIALIZE)
    p.add_argument("--infer-schema", action="store_true", help="infer CSV column types")
    p.add_argument("--parallelism", type=int, default=1,
                   help="reports submitted concurrently (Spark schedules their jobs side by side)")
    a = p.parse_args(argv)
    return JobConfig(
        output_base=a.output_base, input_base=a.input_base, sf_dir=a.sf_dir, run_date=a.date,
        reports=tuple(r for r in a.reports.split(",") if r), write_mode=a.mode,
        output_format=a.format, materialize=a.materialize, infer_schema=a.infer_schema,
        parallelism=a.parallelism,
    ).validate()


def needed_tables(reports) -> list[str]:
    seen: list[str] = []
    for r in reports:
        for t in REPORTS[r].inputs:
            if t not in seen:
                seen.append(t)
    return seen


def load_raw(spark: SparkSession, cfg: JobConfig, tables) -> dict[str, DataFrame]:
    if cfg.input_base is not None:
        return csv_source.read_raw_tables(spark, cfg.input_base, tables, cfg.infer_schema)
    return testdata.raw_tables(spark, cfg.sf_dir, tables)


def load_clean(spark: SparkSession, cfg: JobConfig, tables) -> dict[str, DataFrame]:
    return clean_all(load_raw(spark, cfg, tables))


def observe_losses(raw: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """The raw tables with counts of the rows that cleaning drops, taken while the job
    reads them (no pass of its own), and where the counts arrive."""
    seen = {t: Observation(f"cleaning of {t}") for t in raw}
    return {t: df.observe(seen[t], *loss_counts(df, t)) for t, df in raw.items()}, seen


def log_losses(seen: dict[str, Observation], wait: float = 10.0) -> dict[str, dict[str, int]]:
    """Log the counts that have arrived.  A table that no finished report has read has none;
    it is waited for shortly and left out."""
    counts: dict[str, dict[str, int]] = {}

    def arrive(table: str) -> None:
        counts[table] = seen[table].get

    # daemons: a count that never arrives must not hold the process
    arriving = {t: threading.Thread(target=arrive, args=(t,), daemon=True) for t in seen}
    for thread in arriving.values():
        thread.start()
    for t, thread in arriving.items():
        thread.join(wait)
        if t in counts:
            log.info("cleaning %s: %s", t, ", ".join(f"{k} {v}" for k, v in counts[t].items()))
        else:
            log.info("cleaning %s: not counted", t)
    return counts


def share(spark: SparkSession, frames: dict[str, DataFrame], uses: dict[str, int], how: str,
          parallelism: int = 1) -> tuple[dict[str, DataFrame], Callable[[], None]]:
    """Materialise the frames that more than one report reads (``uses``).

    Returns the frames to use and a ``release`` callback that drops what was
    created (cached blocks; written tables with their files).  A failure drops
    what other frames have created, then raises.  Materialisation is eager (one job per
    frame, submitted concurrently up to ``parallelism``) so that reports
    running side by side never compute the same frame twice."""
    shared = [] if how == "none" else [t for t in frames if uses.get(t, 0) >= 2]
    if how in ("checkpoint", "table"):
        checkpoint_root(spark)
    run_id = uuid.uuid4().hex[:12]
    created: list[str] = []
    written: list[str] = []
    cached: list[DataFrame] = []

    def materialise(t: str) -> DataFrame:
        df = frames[t]
        if how == "checkpoint":
            return df.checkpoint(eager=True)
        if how == "table":
            path = scratch_path(spark, f"shared-{t}")
            written.append(path)
            if t not in BUCKET_KEYS:
                df.write.mode("overwrite").parquet(path)
                return spark.read.parquet(path)
            name = f"tillroll_{run_id}_{t}"
            created.append(name)
            (df.write.format("parquet").bucketBy(shuffle_partitions(spark), BUCKET_KEYS[t])
             .option("path", path).mode("overwrite").saveAsTable(name))
            return spark.table(name)
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(df)
        df.count()
        return df

    def release() -> None:
        for df in cached:
            df.unpersist()
        for name in created:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in written:
            remove_path(spark, path)

    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(shared) or 1))) as pool:
            done = dict(zip(shared, pool.map(materialise, shared)))
    except BaseException:
        release()
        raise

    return {t: done.get(t, df) for t, df in frames.items()}, release


def input_uses(reports, derived=()) -> dict[str, int]:
    """How many readers each cleaned table has: the reports that read it other
    than through the shared ``derived`` frames, and those frames."""
    uses: dict[str, int] = {}
    readers = [DERIVED[d].inputs for d in derived]
    for r in reports:
        through = {t for d in REPORTS[r].derived if d in derived for t in DERIVED[d].inputs}
        readers.append([t for t in REPORTS[r].inputs if t not in through])
    for tables in readers:
        for t in tables:
            uses[t] = uses.get(t, 0) + 1
    return uses


def derived_uses(reports) -> dict[str, int]:
    """How many of ``reports`` read each shared intermediate."""
    uses: dict[str, int] = {}
    for r in reports:
        for d in REPORTS[r].derived:
            uses[d] = uses.get(d, 0) + 1
    return uses


def run_report(name: str, tables: dict[str, DataFrame], cfg: JobConfig, sink=None) -> bool:
    """Build and write one report; any failure is logged and returned as False."""
    report = REPORTS[name]
    log.info("starting %s", name)
    try:
        extra = {d: tables[d] for d in report.derived if d in tables}
        df = report.transform(**{t: tables[t] for t in report.inputs}, **extra, date=cfg.run_date)
        if sink is not None:
            sink(df, name)
        else:
            sinks.write_report(df, cfg.output_base, name, mode=cfg.write_mode, fmt=cfg.output_format)
        log.info("done %s", name)
        return True
    except Exception:  # noqa: BLE001 - isolate one report's failure from the others
        log.exception("failed %s", name)
        return False


def run(spark: SparkSession, cfg: JobConfig, sink=None, raw: dict[str, DataFrame] | None = None) -> dict[str, bool]:
    """Run the selected reports; return {report: succeeded}.

    ``raw`` supplies already-loaded raw tables instead of the configured
    input.  Reading/cleaning errors abort the job (nothing could succeed
    without the inputs); a report error only fails that report."""
    cfg.validate(require_input=raw is None)
    configure(spark)
    needed = needed_tables(cfg.reports)
    raw = load_raw(spark, cfg, needed) if raw is None else {t: raw[t] for t in needed}
    watched, losses = observe_losses(raw)
    tables = clean_all(watched)
    d_uses = derived_uses(cfg.reports)
    # intermediates read by several reports are built once from the shared inputs
    derived = [d for d, n in d_uses.items() if n >= 2 and cfg.materialize != "none"]
    shared, release_inputs = share(spark, tables, input_uses(cfg.reports, derived), cfg.materialize, cfg.parallelism)
    releases = [release_inputs]
    try:
        frames, broken = dict(shared), set()
        for d in derived:
            try:
                built = {d: DERIVED[d].build(*[shared[t] for t in DERIVED[d].inputs])}
                got, release = share(spark, built, d_uses, cfg.materialize, cfg.parallelism)
                releases.append(release)
                frames.update(got)
            except Exception:  # noqa: BLE001 - only the reports that read it fail
                log.exception("failed intermediate %s", d)
                broken.add(d)
        results = {n: False for n in cfg.reports if broken & set(REPORTS[n].derived)}
        todo = [n for n in cfg.reports if n not in results]
        if cfg.parallelism > 1:
            with ThreadPoolExecutor(max_workers=cfg.parallelism) as pool:
                futures = {n: pool.submit(run_report, n, frames, cfg, sink) for n in todo}
                results.update({n: f.result() for n, f in futures.items()})
        else:
            results.update({name: run_report(name, frames, cfg, sink) for name in todo})
        results = {n: results[n] for n in cfg.reports}
        if any(results.values()):
            log_losses(losses)
    finally:
        for release in reversed(releases):
            release()
    ok = [n for n, v in results.items() if v]
    log.info("%d/%d reports succeeded for %s; failed: %s", len(ok), len(results), cfg.run_date,
             [n for n, v in results.items() if not v])
    return results


def run_results(spark: SparkSession, cfg: JobConfig, sink=None) -> DataFrame:
    """Run the job and return it as rows: (report, status, n_rows).

    ``status`` is ``succeeded`` or ``failed``; ``n_rows`` counts the run date's
    partition as read back from the sink, 0 for a report that left none."""
    from pyspark.sql import functions as F

    done = run(spark, cfg, sink)
    out = spark.createDataFrame([(n, "succeeded" if ok else "failed") for n, ok in done.items()], "report string, status string")
    counts = None
    for name, ok in done.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(sinks.table_path(cfg.output_base, name))
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            continue
        back = sinks.read_report(spark, cfg.output_base, name, schemas.REPORT[name], cfg.run_date, cfg.output_format)
        rows = back.groupBy(F.lit(name).alias("report")).agg(F.count(F.lit(1)).alias("n_rows"))
        counts = rows if counts is None else counts.union(rows)
    if counts is None:
        return out.withColumn("n_rows", F.lit(0).cast("long"))
    return out.join(counts, "report", "left").select("report", "status", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, stream=sys.stdout, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    cfg = parse_args(argv)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    try:
        results = run(spark, cfg)
    finally:
        spark.stop()
    return 0 if all(results.values()) else 1


if __name__ == "__main__":
    sys.exit(main())
