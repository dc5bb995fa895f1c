"""Sources, sink and runner: CSV input, rerun idempotence, two dates side by
side, append semantics, failure isolation, materialisation modes."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import shape, RUN_DATE, SF_SMALL
from tillroll import pipeline, schemas, sinks
from tillroll.catalog import cleaned
from tillroll.plans import REPORTS
from tillroll.sources import csv as csv_source
from tillroll.sources import testdata


@pytest.fixture(scope="module")
def csv_base(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("raw_csv"))
    csv_source.write_raw_tables(testdata.raw_tables(spark, SF_SMALL), base)
    return base


def test_csv_round_trip_equals_direct(spark, csv_base):
    from_csv = pipeline.load_clean(spark, pipeline.JobConfig(input_base=csv_base, output_base="x"),
                                   list(schemas.TABLES))
    direct = cleaned(spark, SF_SMALL, *schemas.TABLES)
    for t in schemas.TABLES:
        assert shape(from_csv[t].schema) == shape(schemas.CLEAN[t])
        a = sorted(map(tuple, from_csv[t].collect()), key=repr)
        b = sorted(map(tuple, direct[t].collect()), key=repr)
        assert a == b, t


def test_csv_reader_handles_dirty_text(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(
        "order_id,customer_id,order_date,order_status,total_amount,discount_amount,payment_method\n"
        "O1,C1,2020-01-02 10:00:00, Completed ,12.5,oops,cash\n"
        "O2,C1,not-a-date,SHIPPED,,1,\"card, visa\"\n"
        ",C1,2020-01-02,shipped,1,1,cash\n"
    )
    raw = csv_source.read_raw_csv(spark, str(path), "orders")
    out = {r.order_id: r for r in pipeline.clean_all({"orders": raw})["orders"].collect()}
    assert set(out) == {"O1", "O2"}
    assert (out["O1"].order_status, out["O1"].total_amount, out["O1"].discount_amount) == ("completed", 12.5, None)
    assert (out["O2"].order_date, out["O2"].total_amount, out["O2"].payment_method) == (None, None, "card, visa")


def test_csv_columns_matched_by_header_name(spark, tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text(
        "order_id,note,transaction_status,transaction_id,transaction_amount,transaction_date\n"
        "O1,x,SUCCESS ,T1,12.50,2020-01-02 10:00:00\n"
    )
    raw = csv_source.read_raw_csv(spark, str(path), "transactions")
    assert raw.columns == schemas.RAW_COLUMNS["transactions"]
    assert all(t == "string" for _, t in raw.dtypes)
    r = pipeline.clean_all({"transactions": raw})["transactions"].first()
    assert (r.transaction_id, r.transaction_status, r.transaction_amount) == ("T1", "success", 12.5)
    bad = tmp_path / "orders.csv"
    bad.write_text("order_id,customer_id\nO1,C1\n")
    with pytest.raises(ValueError):
        csv_source.read_raw_csv(spark, str(bad), "orders")


def test_csv_inferred_schema_option(spark, csv_base):
    raw = csv_source.read_raw_tables(spark, csv_base, ["order_items"], infer_schema=True)["order_items"]
    assert raw.columns == schemas.RAW_COLUMNS["order_items"]
    assert pipeline.clean_all({"order_items": raw})["order_items"].count() == 4493


def count_by_date(spark, base, table):
    df = spark.read.parquet(sinks.table_path(base, table))
    return {r[0].isoformat(): r[1] for r in df.groupBy("ingestion_date").count().collect()}


def test_sink_overwrite_is_idempotent_and_keeps_other_dates(spark, tmp_path):
    base = str(tmp_path / "wh")
    clean = cleaned(spark, SF_SMALL, "orders", "transactions")
    perf = REPORTS["monthly_performance"].transform
    n = perf(**clean, date=RUN_DATE).count()
    sinks.write_report(perf(**clean, date=RUN_DATE), base, "monthly_performance")
    sinks.write_report(perf(**clean, date="20020101"), base, "monthly_performance")
    sinks.write_report(perf(**clean, date=RUN_DATE), base, "monthly_performance")
    assert count_by_date(spark, base, "monthly_performance") == {"2001-12-31": n, "2002-01-01": n}
    back = sinks.read_report(spark, base, "monthly_performance", schemas.REPORT["monthly_performance"],
                             run_date=RUN_DATE)
    assert shape(back.schema) == shape(schemas.REPORT["monthly_performance"]) and back.count() == n


def test_sink_append_duplicates_like_the_reference(spark, tmp_path):
    base = str(tmp_path / "wh")
    clean = cleaned(spark, SF_SMALL, "orders", "customers")
    ret = REPORTS["customer_retention"].transform
    n = ret(**clean, date=RUN_DATE).count()
    for _ in range(2):
        sinks.write_report(ret(**clean, date=RUN_DATE), base, "customer_retention", mode="append")
    assert count_by_date(spark, base, "customer_retention") == {"2001-12-31": 2 * n}


def test_sink_rejects_bad_input(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_report(spark.range(1), str(tmp_path), "t")
    with pytest.raises(ValueError):
        sinks.write_report(spark.range(1).withColumn("ingestion_date", F.current_date()), str(tmp_path), "t",
                           mode="merge")


@pytest.mark.parametrize("how", ["cache", "checkpoint", "table", "none"])
def test_run_all_writes_every_report(spark, tmp_path, how):
    out = str(tmp_path / "wh")
    cfg = pipeline.JobConfig(sf_dir=SF_SMALL, output_base=out, run_date=RUN_DATE, materialize=how)
    results = pipeline.run(spark, cfg)
    assert results == {name: True for name in REPORTS}
    for name in REPORTS:
        assert os.path.isdir(os.path.join(out, name, "ingestion_date=2001-12-31"))
    n = spark.read.parquet(os.path.join(out, "order_summary")).count()
    assert n == cleaned(spark, SF_SMALL, "orders")["orders"].count()


def test_one_failing_report_does_not_stop_the_others(spark, tmp_path, monkeypatch):
    from tillroll.plans import Report

    def broken(**_kw):
        raise RuntimeError("boom")

    monkeypatch.setitem(REPORTS, "monthly_sales", Report("monthly_sales", ("orders",), broken))
    cfg = pipeline.JobConfig(sf_dir=SF_SMALL, output_base=str(tmp_path / "wh"), run_date=RUN_DATE,
                             reports=("monthly_sales", "customer_retention"))
    results = pipeline.run(spark, cfg)
    assert results == {"monthly_sales": False, "customer_retention": True}


def test_cli_exit_code_and_arguments(spark, tmp_path, monkeypatch, csv_base):
    cfg = pipeline.parse_args(["--input-base", csv_base, "--output-base", str(tmp_path / "wh"),
                               "--date", RUN_DATE, "--reports", "customer_retention,monthly_performance"])
    assert cfg.reports == ("customer_retention", "monthly_performance")
    assert pipeline.needed_tables(cfg.reports) == ["orders", "customers", "transactions"]
    with pytest.raises(ValueError):
        pipeline.JobConfig(sf_dir=SF_SMALL, output_base="x", run_date="2001-12-31").validate()
    with pytest.raises(ValueError):
        pipeline.JobConfig(sf_dir=SF_SMALL, output_base="x", reports=("nope",)).validate()
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    rc = pipeline.main(["--input-base", csv_base, "--output-base", str(tmp_path / "wh2"), "--date", RUN_DATE,
                        "--reports", "customer_retention"])
    assert rc == 0


def test_table_materialisation_keeps_order_id_co_partitioning(spark):
    import re

    tables = cleaned(spark, SF_SMALL, "orders", "transactions", "customers")
    reports = ["monthly_performance", "customer_transactions"]
    shared, release = pipeline.share(spark, tables, pipeline.input_uses(reports), "table")
    try:
        assert all(shared[t] is not tables[t] for t in ("orders", "transactions"))
        assert shared["customers"] is tables["customers"]  # read by one report only: not materialised
        # bucketing is aligned with the de-duplication shuffle: at most one file per bucket
        files = [f for f in shared["orders"].inputFiles() if f.endswith(".parquet")]
        assert 0 < len(files) <= pipeline.shuffle_partitions(spark)
        out = REPORTS["monthly_performance"].transform(shared["orders"], shared["transactions"], RUN_DATE)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange hashpartitioning\(order_id", plan)
    finally:
        release()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tillroll_")]


def test_save_as_table_sink(spark, tmp_path):
    clean = cleaned(spark, SF_SMALL, "orders", "customers")
    df = REPORTS["customer_retention"].transform(**clean, date=RUN_DATE)
    sinks.write_report(df, str(tmp_path / "wh"), "customer_retention", save_as_table="retention_sink_test")
    try:
        assert spark.table("retention_sink_test").count() == df.count()
    finally:
        spark.sql("DROP TABLE IF EXISTS retention_sink_test")


def test_checkpoint_root_is_read_from_the_session(spark):
    from tillroll.session import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/") + "/x-")


def test_shared_intermediates_give_stand_alone_results(spark):
    names = ("order_summary", "monthly_sales", "customer_profile_summary")
    got = {}

    def sink(df, name):
        got[name] = sorted(map(tuple, df.collect()), key=repr)

    cfg = pipeline.JobConfig(sf_dir=SF_SMALL, run_date=RUN_DATE, reports=names, parallelism=3)
    assert pipeline.derived_uses(names) == {"order_category_lines": 3}
    assert pipeline.run(spark, cfg, sink=sink) == {n: True for n in names}
    for n in names:
        rep = REPORTS[n]
        alone = rep.transform(**cleaned(spark, SF_SMALL, *rep.inputs), date=RUN_DATE)
        assert got[n] == sorted(map(tuple, alone.collect()), key=repr), n


def test_only_what_is_read_twice_is_shared():
    """order_items and products reach their readers through the roll-up alone."""
    uses = pipeline.input_uses(tuple(REPORTS), ["order_category_lines"])
    assert uses["order_items"] == uses["products"] == 1
    assert uses["orders"] == 6 and uses["transactions"] == 4 and uses["customers"] == 5
    assert pipeline.input_uses(("order_summary",))["order_items"] == 1


@pytest.mark.parametrize("how", ["cache", "table"])
def test_a_failing_intermediate_fails_only_its_readers(spark, tmp_path, monkeypatch, how):
    from tillroll.plans import DERIVED, Derived

    def broken(order_items, products):
        raise RuntimeError("boom")

    monkeypatch.setitem(DERIVED, "order_category_lines", Derived("order_category_lines", ("order_items", "products"), broken))
    spark.catalog.clearCache()
    before = len(spark.catalog.listTables())
    cfg = pipeline.JobConfig(sf_dir=SF_SMALL, output_base=str(tmp_path / "wh"), run_date=RUN_DATE, materialize=how)
    results = pipeline.run(spark, cfg)
    readers = {"order_summary", "monthly_sales", "customer_profile_summary"}
    assert results == {n: n not in readers for n in REPORTS}
    assert len(spark.catalog.listTables()) == before
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_failing_materialisation_releases_the_others(spark):
    good = spark.range(5).toDF("x")
    bad = spark.range(5).selectExpr("raise_error('boom') as x")
    spark.catalog.clearCache()
    for how in ("cache", "table"):
        with pytest.raises(Exception, match="boom"):
            pipeline.share(spark, {"good": good, "bad": bad}, {"good": 2, "bad": 2}, how)
        assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_written_shared_tables_are_deleted(spark):
    frames, release = pipeline.share(spark, {"x": spark.range(5).toDF("x")}, {"x": 2}, "table")
    files = frames["x"].inputFiles()
    assert files and all(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in files)
    release()
    assert not any(os.path.exists(f.removeprefix("file:").replace("///", "/")) for f in files)


def test_csv_parts_with_other_headers_fail(spark, tmp_path):
    d = tmp_path / "transactions.csv"
    d.mkdir()
    (d / "a.csv").write_text("order_id,transaction_id,transaction_date,transaction_amount,transaction_status\nO1,T1,2020-01-01,1.0,success\n")
    (d / "b.csv").write_text("transaction_id,order_id,transaction_date,transaction_amount,transaction_status\nT2,O2,2020-01-01,1.0,success\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_source.read_raw_csv(spark, str(d), "transactions").collect()


def test_csv_write_refuses_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("P1", "a\nb")], "product_id string, product_name string")
    with pytest.raises(Exception, match="line break"):
        csv_source.write_raw_csv(df, str(tmp_path / "products.csv"))


def test_session_without_a_checkpoint_folder():
    """In a session that has none set, local mode uses a private folder and a cluster refuses."""
    import subprocess
    import sys

    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
from tillroll import pipeline
from tillroll.catalog import QUERIES
s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()
assert s.conf.get('spark.checkpoint.dir', None) is None
assert QUERIES['csv_roundtrip'](s, {SF_SMALL!r}).count() > 0
cfg = pipeline.JobConfig(sf_dir={SF_SMALL!r}, run_date={RUN_DATE!r}, reports=('customer_retention', 'monthly_performance'), materialize='table')
assert all(pipeline.run(s, cfg, sink=lambda df, n: df.count()).values())
print('RAN')
"""
    env = {**os.environ, "SPARK_CONF_DIR": os.path.dirname(os.path.abspath(__file__))}
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=300)
    assert "RAN" in got.stdout, got.stderr[-2000:]


def test_run_on_preloaded_raw_tables(spark):
    from tillroll.sources import testdata

    raw = testdata.raw_tables(spark, SF_SMALL)
    got = {}
    cfg = pipeline.JobConfig(run_date=RUN_DATE, reports=("customer_retention",))
    assert pipeline.run(spark, cfg, sink=lambda df, n: got.setdefault(n, df.count()), raw=raw) == \
        {"customer_retention": True}
    assert got["customer_retention"] > 0
