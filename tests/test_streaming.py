"""The arrival trigger: each new drop is processed once, in date order, and a
restarted query picks up only the drops it has not seen."""

import os

from tillroll import streaming
from tillroll.sources import synthetic as syn

SIZES = {"customers": 50, "products": 20, "orders": 200, "order_items": 300, "transactions": 200}
REPORTS = ("monthly_performance", "customer_retention")


def drop(spark, landing, date, seed):
    syn.write_csv(spark, os.path.join(landing, date), sizes=SIZES, seed=seed, partitions=1)


def test_drop_dirs_parsing():
    m = streaming.MARKER
    got = streaming.drop_dirs([f"file:/l/20240102/{m}", f"file:/l/20240101/{m}/part-0.csv",
                               f"file:/l/tmp/{m}", f"file:/l/20240101/{m}/part-1.csv"])
    assert got == [("file:/l/20240101", "20240101"), ("file:/l/20240102", "20240102"), ("file:/l/tmp", None)]


def test_a_bad_drop_fails_after_the_good_ones(spark, tmp_path):
    import pytest

    landing = str(tmp_path / "landing")
    drop(spark, landing, "not-a-date", 1)
    drop(spark, landing, "20240109", 2)
    seen = []
    q = streaming.start(spark, landing, str(tmp_path / "wh"), reports=("customer_retention",),
                        checkpoint_location=str(tmp_path / "ckpt"), sink=lambda df, name: seen.append(name))
    with pytest.raises(Exception, match="not-a-date"):
        q.awaitTermination()
    assert seen == ["customer_retention"]


def test_a_drop_still_being_written_is_left_alone(spark, tmp_path):
    landing = tmp_path / "landing" / "20240110"
    landing.mkdir(parents=True)
    (landing / "orders.csv").write_text("order_id\n")
    seen = []
    q = streaming.start(spark, str(tmp_path / "landing"), str(tmp_path / "wh"), reports=("customer_retention",),
                        checkpoint_location=str(tmp_path / "ckpt"), sink=lambda df, name: seen.append(name))
    q.awaitTermination()
    assert seen == []


def test_each_drop_runs_once(spark, tmp_path):
    landing, out, ckpt = (str(tmp_path / x) for x in ("landing", "wh", "ckpt"))
    drop(spark, landing, "20240101", 1)
    drop(spark, landing, "20240102", 2)
    seen = []

    def sink(df, name):
        seen.append((name, df.select("ingestion_date").distinct().first()[0].isoformat()))

    q = streaming.start(spark, landing, out, reports=REPORTS, checkpoint_location=ckpt, sink=sink)
    q.awaitTermination()
    assert sorted(seen) == sorted((r, d) for r in REPORTS for d in ("2024-01-01", "2024-01-02"))

    seen.clear()
    drop(spark, landing, "20240103", 3)
    q = streaming.start(spark, landing, out, reports=REPORTS, checkpoint_location=ckpt, sink=sink)
    q.awaitTermination()
    assert sorted(seen) == [(r, "2024-01-03") for r in sorted(REPORTS)]


def test_writes_partitioned_reports(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "wh")
    drop(spark, landing, "20240105", 4)
    q = streaming.start(spark, landing, out, reports=("customer_retention",),
                        checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination()
    assert os.path.isdir(os.path.join(out, "customer_retention", "ingestion_date=2024-01-05"))


def test_incomplete_drop_fails_the_batch(spark, tmp_path):
    import pytest

    landing = tmp_path / "landing" / "20240107"
    landing.mkdir(parents=True)
    (landing / streaming.MARKER).write_text("transaction_id,order_id,transaction_date,transaction_amount,transaction_status\n")
    q = streaming.start(spark, str(tmp_path / "landing"), str(tmp_path / "wh"), reports=("customer_retention",),
                        checkpoint_location=str(tmp_path / "ckpt"))
    with pytest.raises(Exception):
        q.awaitTermination()


def test_continuous_mode_processes_and_stops(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "wh")
    drop(spark, landing, "20240108", 6)
    seen = []
    q = streaming.start(spark, landing, out, reports=("customer_retention",), available_now=False,
                        processing_time="1 second", checkpoint_location=str(tmp_path / "ckpt"),
                        sink=lambda df, name: seen.append(name))
    try:
        q.processAllAvailable()
        assert seen == ["customer_retention"]
        assert q.isActive
    finally:
        q.stop()
    assert not q.isActive
