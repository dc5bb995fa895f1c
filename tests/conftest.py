from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.schemas import CLEAN  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
RUN_DATE = "20011231"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    # spark.checkpoint.dir is taken from the installation's defaults when set;
    # tillroll.session.checkpoint_root creates a private one only when unset.
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def make(spark, table: str, rows):
    """A cleaned table from literal rows (tuples in CLEAN column order)."""
    return spark.createDataFrame(rows, CLEAN[table])


def rows_by(df, key: str) -> dict:
    return {r[key]: r.asDict() for r in df.collect()}


def shape(schema):
    """Column names and types, ignoring nullability."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
