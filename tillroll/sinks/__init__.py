"""S3: the report sink — a table partitioned by ``ingestion_date``.

The reference appends each run to a day-partitioned warehouse table, so a
retried or repeated run duplicates that day's snapshot.  Here the default is
*dynamic partition overwrite*: a run replaces exactly the partitions
(run dates) it writes and leaves every other day untouched, so reruns are
idempotent.  ``mode="append"`` keeps the reference behaviour.

Tables are directories of parquet files (any Hadoop filesystem URI);
``save_as_table`` additionally registers them in the session catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PARTITION_COLUMN = "ingestion_date"


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def write_report(df: DataFrame, base: str, table: str, mode: str = "overwrite",
                 fmt: str = "parquet", save_as_table: str | None = None) -> str:
    """Write ``df`` partitioned by ``ingestion_date``; return the table path.

    ``mode="overwrite"`` replaces only the run dates present in ``df``;
    ``mode="append"`` adds rows (a rerun duplicates them)."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, got {mode!r}")
    if PARTITION_COLUMN not in df.columns:
        raise ValueError(f"report has no {PARTITION_COLUMN} column")
    path = table_path(base, table)
    writer = (
        df.write.format(fmt)
        .mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION_COLUMN)
    )
    if save_as_table:
        writer.option("path", path).saveAsTable(save_as_table)
    else:
        writer.save(path)
    return path


def read_report(spark: SparkSession, base: str, table: str, schema: StructType | None = None,
                run_date=None, fmt: str = "parquet") -> DataFrame:
    """Read a report table back (optionally one run date, pruned by partition)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(table_path(base, table))
    if schema is not None:
        df = df.select(*schema.fieldNames())
    if run_date is not None:
        from tillroll.functions import run_date_lit

        df = df.filter(F.col(PARTITION_COLUMN) == run_date_lit(run_date))
    return df


def read_snapshot(spark: SparkSession, base: str, table: str, schema: StructType | None = None, as_of=None,
                  fmt: str = "parquet") -> DataFrame:
    """The snapshot of a report table as of a run date: that of the latest date
    written up to ``as_of`` (without one, the latest of all); no rows if there is none.

    The date comes from a subquery over the partition column alone, which reads no
    data column; the scan then prunes its partitions by it at run time, so one
    partition is read however many days are kept."""
    from tillroll.functions import run_date_lit

    df = read_report(spark, base, table, schema, fmt=fmt)
    dates = df.select(PARTITION_COLUMN)
    if as_of is not None:
        dates = dates.where(F.col(PARTITION_COLUMN) <= run_date_lit(as_of))
    return df.where(F.col(PARTITION_COLUMN) == dates.agg(F.max(PARTITION_COLUMN)).scalar())


def snapshots(spark: SparkSession, base: str, table: str, fmt: str = "parquet") -> DataFrame:
    """(ingestion_date, n_rows) of every snapshot that is kept."""
    return spark.read.format(fmt).load(table_path(base, table)).groupBy(PARTITION_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))
