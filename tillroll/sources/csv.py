"""The raw CSV inputs, one file (or directory of part files) per table
under a base URI (any Hadoop filesystem: ``file:``, ``hdfs:``, object stores).

Schema inference costs an extra pass over every file and silently turns a
whole column into text when a single value is bad.  Here every column is
read as text and parsed by the cleaners with lenient casts; inference
stays available as an option.  Columns are matched by header name, so a
file with its columns in another order or with extra columns reads the
same; a missing column is an error, and so are part files of one table whose
headers differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.schemas import RAW_COLUMNS, TABLES

# Whitespace is data (the cleaners decide what to trim), so neither side
# strips it; NULL is written and read as an empty field, and an empty text
# value reads as NULL too (CSV files from the upstream generator do not tell
# the two apart).
_IO_OPTIONS = {
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "escape": '"',
}


def table_uri(base: str, table: str, suffix: str = ".csv") -> str:
    return f"{base.rstrip('/')}/{table}{suffix}"


def read_raw_csv(spark: SparkSession, path: str, table: str, infer_schema: bool = False) -> DataFrame:
    """One raw table; every column text unless ``infer_schema``."""
    reader = spark.read.options(**_IO_OPTIONS).option("mode", "PERMISSIVE")
    found = reader.option("inferSchema", "true" if infer_schema else "false").csv(path)
    # names come from one file's header; every part file's own is checked against
    # them while it is read, so parts in different column orders fail
    df = reader.option("enforceSchema", "false").schema(found.schema).csv(path)
    missing = [c for c in RAW_COLUMNS[table] if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*RAW_COLUMNS[table])


CORRUPT = "_corrupt_record"


def read_raw_csv_checked(spark: SparkSession, path: str, table: str) -> tuple[DataFrame, DataFrame]:
    """One raw table as text, and its rejects: (table_name, record) of the records
    whose number of fields is not that of the header, each as it stands in the file.

    ``read_raw_csv`` pads short records with NULL and cuts long ones; here they are
    out of the table.  Both sides are one parse with Spark's corrupt-record column;
    a record is a line, so a file stays splittable."""
    reader = spark.read.options(**_IO_OPTIONS).option("mode", "PERMISSIVE")
    found = reader.option("inferSchema", "false").csv(path)
    missing = [c for c in RAW_COLUMNS[table] if c not in found.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    schema = StructType([*found.schema.fields, StructField(CORRUPT, StringType())])
    checked = reader.option("enforceSchema", "false").option("columnNameOfCorruptRecord", CORRUPT)
    names = [F.col(f"`{c}`") for c in found.columns]
    # always true, but it reads every column: a record is held against the columns that
    # a query reads, so one that reads fewer would let short and long records pass
    whole = F.length(F.concat_ws("", *names)) >= 0
    parsed = checked.schema(schema).csv(path).where(whole)
    good = parsed.where(F.col(CORRUPT).isNull()).select(*RAW_COLUMNS[table])
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(F.lit(table).alias("table_name"), F.col(CORRUPT).alias("record"))
    return good, bad


def read_raw_tables(spark: SparkSession, base: str, names=None, infer_schema: bool = False,
                    suffix: str = ".csv") -> dict[str, DataFrame]:
    names = TABLES if names is None else tuple(names)
    return {t: read_raw_csv(spark, table_uri(base, t, suffix), t, infer_schema) for t in names}


def _one_line(name: str) -> Column:
    broken = F.col(name).rlike("[\\r\\n]")
    return F.when(broken, F.raise_error(F.lit(f"column {name} holds text with a line break")).cast("string")).otherwise(F.col(name))


#: Rows of a compressed part file, which one task reads whole.
PACKED_ROWS = 1 << 20


def write_raw_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Write a raw table as header CSV (part files under ``path``).  Text with a
    line break, which the splittable reader cannot read back, fails the write.

    ``compression`` is a codec of Spark's text files; the reader knows it by the files'
    names.  Compressed files are not split, so each holds ``PACKED_ROWS`` rows at most."""
    texts = {f.name: _one_line(f.name) for f in df.schema.fields if isinstance(f.dataType, StringType)}
    df = df.withColumns(texts)
    writer = df.write.options(**_IO_OPTIONS)
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)
    writer.mode(mode).csv(path)


def write_raw_tables(tables: dict[str, DataFrame], base: str, suffix: str = ".csv", compression: str | None = None) -> None:
    for t, df in tables.items():
        write_raw_csv(df, table_uri(base, t, suffix), compression=compression)
