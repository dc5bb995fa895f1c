"""Named queries over the test tables: every cleaner, report and sub-result
as ``(spark, sf_dir) -> DataFrame``.

Each query plans the raw inputs it needs from the TPC-H-style test tables
(``sources.testdata``), cleans them, and applies one operator.  Nothing is
executed here; the caller decides the action.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import REPORTS
from tillroll.plans import cleaning
from tillroll.plans import customer_profile as r4
from tillroll.plans import customer_retention as r6
from tillroll.plans import customer_transactions as r5
from tillroll.plans import monthly_performance as r3
from tillroll.plans import monthly_sales as r2
from tillroll.plans import order_summary as r1
from tillroll.sources import testdata

# Fixed value: the run date of every fixture (FIXTURES.md).
RUN_DATE = "20011231"

Query = Callable[[SparkSession, str], DataFrame]


def cleaned(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return cleaning.clean_all(testdata.raw_tables(spark, sf_dir, names))


def _clean_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return cleaned(spark, sf_dir, table)[table]

    q.__name__ = f"clean_{table}"
    return q


def _report_query(name: str) -> Query:
    report = REPORTS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.transform(**cleaned(spark, sf_dir, *report.inputs), date=RUN_DATE)

    q.__name__ = name
    return q


def _sub(fn, inputs: tuple[str, ...], **extra) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(**cleaned(spark, sf_dir, *inputs), **extra)

    q.__name__ = fn.__name__
    return q


def _shared_query(name: str) -> Query:
    """A report as the batch job builds it: on the shared item roll-up,
    materialised once."""
    report = REPORTS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tillroll import pipeline
        from tillroll.plans import DERIVED

        clean = cleaned(spark, sf_dir, *report.inputs)
        frames = {d: DERIVED[d].build(*[clean[t] for t in DERIVED[d].inputs]) for d in report.derived}
        frames, _ = pipeline.share(spark, frames, dict.fromkeys(frames, 2), "checkpoint")
        return report.transform(**clean, **frames, date=RUN_DATE)

    q.__name__ = f"{name}_shared"
    return q


def _csv_roundtrip(spark: SparkSession, sf_dir: str, infer_schema: bool = False) -> DataFrame:
    """order_summary computed from the five raw tables written to CSV and
    read back through the CSV source, as text or with inferred types."""
    from tillroll.session import scratch_path
    from tillroll.sources import csv

    base = scratch_path(spark, "csv-roundtrip")
    # the five tables as text are as much as all shuffles of the report
    csv.write_raw_tables(testdata.raw_tables(spark, sf_dir), base, compression="snappy")
    clean = cleaning.clean_all(csv.read_raw_tables(spark, base, infer_schema=infer_schema))
    return REPORTS["order_summary"].transform(**clean, date=RUN_DATE)


def _csv_roundtrip_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_roundtrip(spark, sf_dir, infer_schema=True)


def _sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """monthly_performance appended twice for the run date: both snapshots stay."""
    from tillroll import schemas, sinks
    from tillroll.session import scratch_path

    base = scratch_path(spark, "sink-append")
    clean = cleaned(spark, sf_dir, "orders", "transactions")
    for _ in range(2):
        sinks.write_report(r3.transform(**clean, date=RUN_DATE), base, "monthly_performance", mode="append")
    return sinks.read_report(spark, base, "monthly_performance", schemas.REPORT["monthly_performance"],
                             run_date=RUN_DATE)


def _sink_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """monthly_performance written twice for the run date and once for
    another date through the partition-overwrite sink, read back for the
    run date: exactly one snapshot must remain."""
    from tillroll import schemas, sinks
    from tillroll.session import scratch_path

    base = scratch_path(spark, "sink")
    clean = cleaned(spark, sf_dir, "orders", "transactions")
    for date in (RUN_DATE, RUN_DATE, "20020101"):
        sinks.write_report(r3.transform(**clean, date=date), base, "monthly_performance")
    return sinks.read_report(spark, base, "monthly_performance", schemas.REPORT["monthly_performance"],
                             run_date=RUN_DATE)


def _ordered_query(name: str) -> Query:
    """A report with its display order as a column."""
    report = REPORTS[name]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.positioned(report.transform(**cleaned(spark, sf_dir, *report.inputs), date=RUN_DATE))

    q.__name__ = f"{name}_ordered"
    return q


def _cleaning_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that each cleaner reads and drops, by reason."""
    return cleaning.losses(testdata.raw_tables(spark, sf_dir))


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products as CSV lines, some cut after three fields and some with a field
    too many: the rejected records, and the ids that the cleaner keeps of the rest."""
    from pyspark.sql import functions as F

    from tillroll.schemas import RAW_COLUMNS
    from tillroll.session import scratch_path
    from tillroll.sources import csv

    base, columns = scratch_path(spark, "csv-rejects"), RAW_COLUMNS["products"]
    k = F.substring("product_id", 2, 18).cast("long")
    text = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    line = F.when(k % 13 == 5, F.concat_ws(",", *text[:3])).when(k % 17 == 3, F.concat_ws(",", *text, F.lit("extra"))).otherwise(F.concat_ws(",", *text))
    lines = testdata.raw_products(spark, sf_dir).select(line.alias(",".join(columns)))
    # one column under another separator: lines are written as they stand
    lines.write.option("header", "true").option("sep", "\u0001").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(base)
    good, bad = csv.read_raw_csv_checked(spark, base, "products")
    kept = cleaning.clean_products(good).select(F.lit("kept").alias("kind"), F.col("product_id").alias("record"))
    return bad.select(F.lit("rejected").alias("kind"), "record").union(kept)


def _snapshot_query(as_of: str | None) -> Query:
    """monthly_performance kept for three run dates, read as of one, or the latest."""

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tillroll import schemas, sinks
        from tillroll.session import scratch_path

        base = scratch_path(spark, "snapshots")
        clean = cleaned(spark, sf_dir, "orders", "transactions")
        for date in (RUN_DATE, "20020101", "20020301"):
            sinks.write_report(r3.transform(**clean, date=date), base, "monthly_performance")
        return sinks.read_snapshot(spark, base, "monthly_performance", schemas.REPORT["monthly_performance"], as_of)

    q.__name__ = "report_as_of" if as_of else "report_latest"
    return q


def _run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job through the sink with one report that fails: status and rows read back of each."""
    from tillroll import pipeline, sinks
    from tillroll.session import scratch_path

    base = scratch_path(spark, "run-results")

    def sink(df: DataFrame, name: str) -> None:
        if name == "customer_retention":
            raise RuntimeError("planted: this report fails")
        sinks.write_report(df, base, name)

    reports = ("order_summary", "monthly_performance", "customer_transactions", "customer_retention")
    # side by side: a report's last tasks leave cores to the others
    cfg = pipeline.JobConfig(output_base=base, sf_dir=sf_dir, run_date=RUN_DATE, reports=reports, parallelism=len(reports))
    return pipeline.run_results(spark, cfg, sink)


QUERIES: dict[str, Query] = {
    **{f"clean_{t}": _clean_query(t) for t in cleaning.CLEANERS},
    "order_item_totals": _sub(r1.order_item_totals, ("order_items",)),
    "top_category_per_order": _sub(r1.top_category_per_order, ("order_items", "products")),
    "order_summary": _report_query("order_summary"),
    "sales_lines": _sub(r2.sales_lines, ("orders", "customers", "order_items", "products", "transactions")),
    "monthly_sales": _report_query("monthly_sales"),
    "monthly_kpis": _sub(r3.monthly_kpis, ("orders", "transactions")),
    "monthly_performance": _report_query("monthly_performance"),
    "customer_order_metrics": _sub(r4.customer_order_metrics, ("orders", "customers"), date=RUN_DATE),
    "favorite_category": _sub(r4.favorite_category, ("orders", "order_items", "products")),
    "last_order": _sub(r4.last_order, ("orders",)),
    "customer_profile_summary": _report_query("customer_profile_summary"),
    "customer_txn_metrics": _sub(r5.customer_txn_metrics, ("orders", "customers", "transactions")),
    "preferred_payment": _sub(r5.preferred_payment, ("orders", "transactions")),
    "customer_transactions": _report_query("customer_transactions"),
    "cohort_sizes": _sub(r6.cohort_sizes, ("customers",)),
    "cohort_activity": _sub(r6.cohort_activity, ("orders", "customers")),
    "customer_retention": _report_query("customer_retention"),
    "order_summary_shared": _shared_query("order_summary"),
    "monthly_sales_shared": _shared_query("monthly_sales"),
    "customer_profile_shared": _shared_query("customer_profile_summary"),
    "csv_roundtrip": _csv_roundtrip,
    "csv_roundtrip_inferred": _csv_roundtrip_inferred,
    "sink_append": _sink_append,
    "sink_partition_overwrite": _sink_partition_overwrite,
    "monthly_sales_ordered": _ordered_query("monthly_sales"),
    "monthly_performance_ordered": _ordered_query("monthly_performance"),
    "customer_retention_ordered": _ordered_query("customer_retention"),
    "cleaning_losses": _cleaning_losses,
    "csv_rejects": _csv_rejects,
    "sink_report_as_of": _snapshot_query("20020215"),
    "sink_report_latest": _snapshot_query(None),
    "sink_run_results": _run_results,
}
