"""Oracle parity: every registered query against its DuckDB SQL on the
sf0.001 tables (the driver runs the same comparison at sf0.01)."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tillroll.catalog import QUERIES

VIEWS = "region nation customer supplier part orders lineitem".split()


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), len(lines)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_report_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


# Spark type -> DuckDB type name of the same values
SAME_TYPE = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SAME_TYPE.get(t, t) for c, t in df.dtypes} == d_types
    cur = duck.execute(E.oracle_sql()[name])
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert digest(df.columns, s_rows) == digest(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "order_id"
