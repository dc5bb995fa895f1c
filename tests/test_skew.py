"""Hot keys: one customer owning a third of all orders and one product a
third of all item lines (derived from the driver's tables).

Aggregations absorb such keys with map-side partial aggregation and every
top-1 with a partial WindowGroupLimit.  The joins whose fact side is hot
(items to products, orders to customers) spread each key over salts."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import RUN_DATE, SF_CHECK
from tillroll.catalog import cleaned
from tillroll.plans import REPORTS

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture(scope="module")
def skewed(spark):
    t = cleaned(spark, SF_CHECK, *REPORTS["order_summary"].inputs)
    third = lambda key: F.abs(F.hash(key)) % 3 == 0
    t["orders"] = t["orders"].withColumn(
        "customer_id", F.when(third("order_id"), F.lit("C7")).otherwise(F.col("customer_id")))
    t["order_items"] = t["order_items"].withColumn(
        "product_id", F.when(third("order_item_id"), F.lit("P7")).otherwise(F.col("product_id")))
    return t


def collect(spark, t, name, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rep = REPORTS[name]
        df = rep.transform(**{x: t[x] for x in rep.inputs}, date=RUN_DATE)
        rows = sorted(map(tuple, df.collect()), key=repr)
        return rows, df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


JOINS = {"order_summary": ["product_id", "customer_id"], "monthly_sales": ["product_id"], "customer_profile_summary": ["product_id"]}


@pytest.mark.parametrize("name", list(JOINS))
def test_hot_joins_are_salted_and_results_unchanged(spark, skewed, name, monkeypatch):
    from tillroll import operators

    spark.catalog.clearCache()
    rows, plan = collect(spark, skewed, name, SKEW_CONF)
    for key in JOINS[name]:
        assert re.search(rf"SortMergeJoin \[{key}#\d+, __tillroll_salt#\d+\]", plan), key
    monkeypatch.setattr(operators, "SALTS", 1)
    plain, _ = collect(spark, skewed, name, SKEW_CONF)
    assert rows == plain


@pytest.mark.parametrize("how", ["none", "cache", "table"])
@pytest.mark.parametrize("fact, dimension, key, spread_by", [
    ("order_items", "products", "product_id", "order_item_id"), ("orders", "customers", "customer_id", "order_id")])
def test_largest_task_of_a_hot_join(spark, skewed, fact, dimension, key, spread_by, how):
    """With a third of the rows on one key, the largest task of the join reads
    well below a third of them, from plain, cached and bucketed inputs alike."""
    from tillroll import pipeline
    from tillroll.operators import salted_left_join

    conf = {**SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t, release = pipeline.share(spark, {x: skewed[x] for x in (fact, dimension)}, {fact: 2, dimension: 2}, how)
        joined = salted_left_join(t[fact], t[dimension].select(key), key, spread_by)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == t[fact].count()
        assert max(sizes) < 0.2 * sum(sizes), sizes
        release()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def many_partitions(spark):
    conf = {**SKEW_CONF, "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_order(skewed):
    """A third of the item lines on one order that qualifies as a sale."""
    t = dict(skewed)
    ok = t["transactions"].filter("transaction_status = 'success'").select("order_id")
    order = t["orders"].filter("order_status = 'completed'").join(ok, "order_id", "left_semi").agg(F.min("order_id")).first()[0]
    hot = F.abs(F.hash("order_item_id", F.lit(5))) % 3 == 0
    t["order_items"] = cleaned(skewed["orders"].sparkSession, SF_CHECK, "order_items")["order_items"].withColumn(
        "order_id", F.when(hot, F.lit(order)).otherwise(F.col("order_id")))
    return t, order


def task_sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_hot_order_in_the_roll_up(spark, skewed, many_partitions):
    """Rows that reach the order_id exchange: no task reads a fifth of the lines."""
    from tillroll.plans import order_lines

    t, order = hot_order(skewed)
    lines = order_lines.order_category_lines(t["order_items"], t["products"])
    n = t["order_items"].count()
    hot = t["order_items"].filter(F.col("order_id") == order).count()
    assert hot > 0.3 * n
    got = lines.filter(F.col("order_id") == order).agg(F.sum("cat_count"), F.sum("units")).first()
    want = t["order_items"].filter(F.col("order_id") == order).agg(F.count("*"), F.sum("quantity")).first()
    assert tuple(got) == tuple(want)
    # what one order sends to its task: at most one row for each product and salt
    products = t["order_items"].filter(F.col("order_id") == order).select("product_id").distinct().count()
    assert products < 0.2 * n
    plan = lines._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("hashpartitioning(order_id")
    assert "HashAggregate(keys=[order_id" in plan[exchange:] or "Aggregate(keys=[order_id" in plan[exchange:]


def test_hot_order_in_the_sales_lines(spark, skewed, many_partitions):
    from tillroll.operators import salted_join
    from tillroll.plans import monthly_sales

    t, order = hot_order(skewed)
    q = monthly_sales.qualifying_orders(t["orders"], t["customers"], t["transactions"])
    sizes = task_sizes(salted_join(t["order_items"], q, "order_id", "order_item_id", "inner"))
    assert max(sizes) < 0.2 * t["order_items"].count(), sizes
    args = [t[x] for x in ("orders", "customers", "order_items", "products", "transactions")]
    got = monthly_sales.sales_lines(*args)
    want = t["order_items"].join(q, "order_id").count()
    assert got.count() == want


def test_only_heavy_keys_are_copied(spark, many_partitions):
    """Without skew the dimension is not copied; with it, its heavy rows only, in
    proportion; the result is that of a plain join, NULL keys included."""
    from tillroll import operators

    n = 40_000
    dim = spark.range(1000).selectExpr("concat('k', id) as k", "id * 2 as v")
    even = spark.range(n).selectExpr("concat('k', id % 1100) as k", "id")
    heavy = lambda f: spark.range(1).select(operators.heavy_keys(f, "k", 48).alias("m")).first()["m"]
    assert heavy(even) == {}
    third = even.withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("k7")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(F.col("k")))
    found = heavy(third)
    assert set(found) == {"k7"} and 16 <= found["k7"] <= 20
    assert heavy(third.limit(0)) == {}
    for facts in (even, third):
        for how in ("left", "inner"):
            salted = operators.salted_join(facts, dim, "k", "id", how)
            plain = facts.join(dim, "k", how)
            assert salted.columns == plain.columns
            assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    sizes = task_sizes(operators.salted_join(third, dim, "k", "id"))
    assert max(sizes) < 0.15 * n, sizes
    # the same share of more rows: the largest task grows with the rows, not faster
    wide = spark.range(4 * n).select(F.when(F.col("id") % 3 == 0, F.lit("k7")).otherwise(F.concat(F.lit("k"), F.col("id") % 1100)).alias("k"), "id")
    assert max(task_sizes(operators.salted_join(wide, dim, "k", "id"))) < 0.15 * 4 * n


def test_a_small_dimension_is_not_salted(spark):
    from tillroll import operators

    dim = spark.range(100).selectExpr("concat('k', id) as k", "id * 2 as v")
    facts = spark.range(1000).selectExpr("concat('k', id % 200) as k", "id")
    plan = operators.salted_join(facts, dim, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "salt" not in plan and "approx_top_k" not in plan


def test_hot_customer_totals(spark, skewed):
    rep = REPORTS["customer_profile_summary"]
    df = rep.transform(**{x: skewed[x] for x in rep.inputs}, date=RUN_DATE)
    hot = df.filter(F.col("customer_id") == "C7").first()
    assert hot.total_orders == skewed["orders"].filter(F.col("customer_id") == "C7").count()


def test_a_third_of_rows_copies_of_one_key(spark):
    """De-duplication when one key's copies are a third of the table: the
    kept row is the smallest copy, and the partial top-1 runs before the
    shuffle, so each map task sends at most one copy of the hot key."""
    from tillroll.plans.cleaning import clean_order_items
    from tillroll.sources import testdata

    raw = testdata.raw_order_items(spark, SF_CHECK)
    hot = F.abs(F.hash("order_item_id", "quantity")) % 3 == 0
    copies = raw.withColumn("order_item_id", F.when(hot, F.lit("I-HOT")).otherwise(F.col("order_item_id")))
    out = clean_order_items(copies)
    kept = out.filter(F.col("order_item_id") == "I-HOT").collect()
    assert len(kept) == 1
    valid = copies.filter((F.col("order_item_id") == "I-HOT") & F.col("product_id").isNotNull()
                          & (F.col("quantity") > 0) & (F.col("price_per_unit") > 0))
    smallest = valid.orderBy("order_id", "product_id", "quantity", "price_per_unit").first()
    assert (kept[0].order_id, kept[0].product_id, kept[0].quantity, kept[0].price_per_unit) == \
        (smallest.order_id, smallest.product_id, smallest.quantity, smallest.price_per_unit)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", plan)
