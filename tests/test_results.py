"""Positions, losses of cleaning, rejected records, snapshots and the run as a result."""

import datetime as dt
import logging
import random

import pytest
from pyspark.sql import functions as F

from conftest import RUN_DATE, SF_SMALL
from tillroll import pipeline, sinks
from tillroll.catalog import QUERIES
from tillroll.operators import with_position
from tillroll.plans import REPORTS, cleaning
from tillroll.sources import csv, testdata


def test_position_is_the_place_in_the_total_order(spark):
    rng = random.Random(0)
    rows = [(rng.choice([None, *range(40)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    got = with_position(df, [F.col("a").asc_nulls_first(), F.col("b").desc()])
    assert got.columns == ["a", "b", "position"]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -r[1]))
    assert [(r.a, r.b) for r in sorted(got.collect(), key=lambda r: r.position)] == want
    assert sorted(r.position for r in got.collect()) == list(range(1, 501))
    assert with_position(df.limit(0), [F.col("a")]).count() == 0
    # a column of the range exchange's many equal keys does not lose rows
    same = with_position(spark.range(300).selectExpr("1 as k", "id"), [F.col("k"), F.col("id")])
    assert same.where("position <> id + 1").count() == 0


def test_position_of_reports_survives_a_write(spark, tmp_path):
    report = REPORTS["monthly_performance"]
    got = QUERIES["monthly_performance_ordered"](spark, SF_SMALL)
    got.repartition(5).write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).orderBy("position").drop("position").collect()
    assert back == report.ordered(QUERIES["monthly_performance"](spark, SF_SMALL)).collect()
    with pytest.raises(ValueError):
        REPORTS["order_summary"].positioned(got)


def test_losses_add_up_to_the_rows_read(spark):
    raw = testdata.raw_tables(spark, SF_SMALL)
    got = {}
    for r in cleaning.losses(raw).collect():
        got.setdefault(r.table_name, {})[r.reason] = r.n_rows
    for table, df in raw.items():
        assert sum(got[table].values()) == df.count()
        assert got[table]["kept"] == cleaning.CLEANERS[table](df).count()


def test_reasons(spark):
    rows = [("I1", "O1", "P1", "2", "1.5"), ("I1", "O1", "P1", "2", "1.5"), (None, "O1", "P1", "0", "x"), ("I2", "O1", None, "1", "1"), ("I3", "O1", "P1", "many", "1"),
            ("I4", "O1", "P1", "99999999999", "1"), ("I5", "O1", "P1", "0", "1"), ("I6", "O1", "P1", "1", "-2"), ("I7", "O1", "P1", None, "1"), ("I8", "O1", "P1", "3.7", "oops")]
    items = spark.createDataFrame(rows, "order_item_id string, order_id string, product_id string, quantity string, price_per_unit string")
    orders = spark.createDataFrame([("O1", "C1", None), ("O2", "C1", "pending"), ("O3", None, "shipped"), ("O4", "C1", " SHIPPED ")], "order_id string, customer_id string, order_status string")
    orders = orders.selectExpr("*", "null order_date", "null total_amount", "null discount_amount", "null payment_method")
    got = {(r.table_name, r.reason): r.n_rows for r in cleaning.losses({"order_items": items, "orders": orders}).collect()}
    assert got == {("order_items", "null_key"): 2, ("order_items", "unparseable"): 3, ("order_items", "out_of_range"): 3, ("order_items", "kept"): 1, ("order_items", "duplicate"): 1,
                   ("orders", "bad_status"): 2, ("orders", "null_key"): 1, ("orders", "kept"): 1}
    assert cleaning.clean_order_items(items).count() == 1 and cleaning.clean_orders(orders).count() == 1


@pytest.mark.parametrize("how", ["none", "cache"])
def test_job_logs_what_cleaning_drops(spark, tmp_path, caplog, how):
    spark.catalog.clearCache()
    cfg = pipeline.JobConfig(output_base=str(tmp_path), sf_dir=SF_SMALL, run_date=RUN_DATE, reports=("monthly_performance", "customer_retention"), materialize=how)
    with caplog.at_level(logging.INFO, logger="tillroll"):
        assert all(pipeline.run(spark, cfg).values())
    want = {}
    for r in QUERIES["cleaning_losses"](spark, SF_SMALL).collect():
        want.setdefault(r.table_name, {})[r.reason] = r.n_rows
    lines = [m for m in caplog.messages if m.startswith("cleaning ")]
    assert {m.split(":")[0].split()[1] for m in lines} == {"orders", "customers", "transactions"}
    for m in lines:
        table, counts = m.split(":")[0].split()[1], dict(p.split() for p in m.split(": ")[1].split(", "))
        assert int(counts.pop("read")) == sum(want[table].values())
        assert {k: int(v) for k, v in counts.items() if int(v)} == {k: v for k, v in want[table].items() if k not in ("kept", "duplicate")}


def test_counts_that_never_arrive_do_not_block(spark):
    watched, seen = pipeline.observe_losses({"customers": testdata.raw_customers(spark, SF_SMALL)})
    assert pipeline.log_losses(seen, wait=0.2) == {} and set(watched) == {"customers"}


def test_rejected_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text("product_id,product_name,category,sub_category,brand,unit_price\nP1,n,c,s,b,1\nP2,n,c\nP3,n,c,s,b,1,more\nP4,,,,,\n")
    (tmp_path / "b.csv").write_text('product_id,product_name,category,sub_category,brand,unit_price\nP5,"a, b",c,s,b,2\nonly\n')
    good, bad = csv.read_raw_csv_checked(spark, str(tmp_path), "products")
    assert sorted(r.product_id for r in good.collect()) == ["P1", "P4", "P5"]
    assert {(r.table_name, r.record) for r in bad.collect()} == {("products", "P2,n,c"), ("products", "P3,n,c,s,b,1,more"), ("products", "only")}
    # a query that reads one column, or none, rejects the same
    assert sorted(r[0] for r in good.select("product_id").collect()) == ["P1", "P4", "P5"]
    assert good.count() == 3 and bad.count() == 3
    assert good.columns == ["product_id", "product_name", "category", "sub_category", "brand", "unit_price"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv").write_text("product_id,brand\nP1,b\n")
    with pytest.raises(ValueError, match="missing columns"):
        csv.read_raw_csv_checked(spark, str(tmp_path / "c"), "products")


def test_snapshots(spark, tmp_path):
    for day, n in (("2024-01-31", 3), ("2024-02-29", 5), ("2024-03-31", 4)):
        df = spark.range(n).withColumn("ingestion_date", F.lit(day).cast("date"))
        sinks.write_report(df, str(tmp_path), "t")
    read = lambda as_of=None: sorted({r.ingestion_date.isoformat() for r in sinks.read_snapshot(spark, str(tmp_path), "t", as_of=as_of).collect()})
    assert read() == ["2024-03-31"] and read("20240331") == ["2024-03-31"]
    assert read("20240330") == ["2024-02-29"] and read(dt.date(2024, 1, 31)) == ["2024-01-31"] and read("20240130") == []
    assert {(r.ingestion_date.isoformat(), r.n_rows) for r in sinks.snapshots(spark, str(tmp_path), "t").collect()} == {("2024-01-31", 3), ("2024-02-29", 5), ("2024-03-31", 4)}


def test_a_snapshot_reads_one_partition(spark, tmp_path):
    for day in ("2024-01-31", "2024-02-29", "2024-03-31"):
        sinks.write_report(spark.range(10).withColumn("ingestion_date", F.lit(day).cast("date")), str(tmp_path), "t")
    df = sinks.read_snapshot(spark, str(tmp_path), "t", as_of="20240310")
    assert len(df.collect()) == 10
    plan = df._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan.toString() and "Subquery" in plan.toString()
    # the subquery for the date reads no column but the partition's own
    scans = [line for line in plan.toString().splitlines() if "ReadSchema" in line]
    assert any("ReadSchema: struct<>" in line for line in scans)
    assert {r[0].split("ingestion_date=")[1][:10] for r in df.select(F.input_file_name()).distinct().collect()} == {"2024-02-29"}


def test_run_as_a_result(spark, tmp_path):
    def sink(df, name):
        if name == "customer_transactions":
            raise RuntimeError("planted")
        sinks.write_report(df, str(tmp_path), name)

    cfg = pipeline.JobConfig(output_base=str(tmp_path), sf_dir=SF_SMALL, run_date=RUN_DATE, reports=("monthly_performance", "customer_transactions"))
    got = {r.report: (r.status, r.n_rows) for r in pipeline.run_results(spark, cfg, sink).collect()}
    assert got == {"monthly_performance": ("succeeded", QUERIES["monthly_performance"](spark, SF_SMALL).count()), "customer_transactions": ("failed", 0)}
    assert not (tmp_path / "customer_transactions").exists()
