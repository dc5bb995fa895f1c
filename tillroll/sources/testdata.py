"""Adapter from the TPC-H-style test tables to the five raw sales inputs.

The mapping (which table feeds which input, and which rows are made dirty
on purpose so every cleaning rule has work to do) is fixed in FIXTURES.md;
this is its DataFrame form.  All of it is narrow projection/filter work on
the scans plus one union per table; the only joins are customer -> nation ->
region, whose right sides are the fixed 25-row and 5-row TPC-H dimensions
(Spark broadcasts them on its own size statistics).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, TimestampNTZType

SOURCE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(StringType())


def _ts(d: _dt.date) -> Column:
    return F.lit(_dt.datetime(d.year, d.month, d.day)).cast(TimestampNTZType())


def _null(dtype) -> Column:
    return F.lit(None).cast(dtype)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    main = (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("C"), _s(k)).alias("customer_id"),
            F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("customer_name"),
            F.when(k % 53 == 52, _null(StringType()))
            .otherwise(F.concat(F.lit(" "), "c_name", F.lit("@Example.COM ")))
            .alias("email"),
            F.when(k % 61 == 60, _null(TimestampNTZType()))
            .otherwise(F.date_add(F.lit(_dt.date(1995, 1, 1)), ((k * 37) % 2000).cast(IntegerType()))
                       .cast(TimestampNTZType()))
            .alias("signup_date"),
            F.concat(F.lit(" "), "r_name").alias("region"),
            F.concat("c_mktsegment", F.lit(" ")).alias("customer_segment"),
        )
    )
    dups = c.filter(k % 40 == 7).select(
        F.concat(F.lit("C"), _s(k)),
        F.concat("c_name", F.lit(" (dup)")),
        F.concat("c_name", F.lit("@dup.example.com")),
        _ts(_dt.date(1996, 1, 1)),
        F.lit("EUROPE"),
        F.col("c_mktsegment"),
    )
    return main.unionAll(dups)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    main = p.select(
        F.when(k % 97 == 96, _null(StringType())).otherwise(F.concat(F.lit("P"), _s(k))).alias("product_id"),
        F.concat(F.lit(" "), "p_name").alias("product_name"),
        F.concat("p_type", F.lit(" ")).alias("category"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("sub_category"),
        F.col("p_brand").alias("brand"),
        F.when(k % 89 == 88, F.lit("n/a"))
        .otherwise(_s(F.col("p_retailprice").cast("decimal(18,2)")))
        .alias("unit_price"),
    )
    promo = p.filter((k % 50 == 7) & (k % 97 != 96)).select(
        F.concat(F.lit("P"), _s(k)), F.col("p_name"), F.lit("PROMO"), F.col("p_name"), F.col("p_brand"),
        F.lit("1.00"),
    )
    return main.unionAll(promo)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    pri = F.col("o_orderpriority")
    # Order priority -> payment method.
    payment = (
        F.when(pri == "1-URGENT", "credit_card")
        .when(pri == "2-HIGH", "paypal")
        .when(pri == "3-MEDIUM", "cash")
        .when(pri == "4-NOT SPECIFIED", "bank_transfer")
        .otherwise("gift_card")
    )
    status = (
        F.when(k % 97 == 96, "pending")
        .when(k % 20 < 14, " Completed ")
        .when(k % 20 < 18, "SHIPPED")
        .when(k % 20 == 18, "returned")
        .otherwise("cancelled")
    )
    main = o.select(
        F.concat(F.lit("O"), _s(k)).alias("order_id"),
        # every 29th order is of a customer that no customer row has
        F.when(k % 503 == 502, _null(StringType()))
        .otherwise(F.concat(F.when(k % 29 == 28, "X").otherwise("C"), _s("o_custkey"))).alias("customer_id"),
        F.when(k % 401 == 400, _null(TimestampNTZType())).otherwise(F.col("o_orderdate").cast(TimestampNTZType()))
        .alias("order_date"),
        status.alias("order_status"),
        F.when(k % 211 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice").cast(DoubleType())).alias("total_amount"),
        ((k % 5001).cast(DoubleType()) / F.lit(100)).alias("discount_amount"),
        payment.alias("payment_method"),
    )
    late = o.filter(k % 100 == 50).select(
        F.concat(F.lit("O"), _s(k)),
        F.concat(F.lit("C"), _s("o_custkey")),
        _ts(_dt.date(1994, 12, 31)),
        F.when(k % 200 == 50, "pending").otherwise("shipped"),
        F.col("o_totalprice").cast(DoubleType()),
        F.lit(0.0),
        F.lit("cash"),
    )
    return main.unionAll(late)


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ok, ln, q = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity")
    return li.select(
        F.concat(F.lit("I"), _s(ok), F.lit("-"), _s(ln)).alias("order_item_id"),
        F.concat(F.lit("O"), _s(ok)).alias("order_id"),
        F.when(F.col("l_partkey") % 151 == 150, _null(StringType()))
        .otherwise(F.concat(F.lit("P"), _s("l_partkey"))).alias("product_id"),
        F.when(q == 50, F.lit(0)).otherwise(q.cast(IntegerType())).alias("quantity"),
        F.when((q == 1) & (ln == 7), -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
        .alias("price_per_unit"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    return li.select(
        F.when(ok % 307 == 306, _null(StringType()))
        .otherwise(F.concat(F.lit("T"), _s(ok), F.lit("-"), _s(ln), F.lit("-"), _s("l_partkey"), F.lit("-"),
                            _s("l_suppkey")))
        .alias("transaction_id"),
        F.concat(F.lit("O"), _s(ok)).alias("order_id"),
        F.when((ok % 211 == 5) & (ln == 1), _null(TimestampNTZType()))
        .otherwise(F.col("l_shipdate").cast(TimestampNTZType())).alias("transaction_date"),
        F.col("l_extendedprice").alias("transaction_amount"),
        F.when((ok * 7 + ln) % 20 == 0, " Failed").otherwise("SUCCESS ").alias("transaction_status"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "transactions": raw_transactions,
}


def raw_tables(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """The raw inputs (lazily planned) for the tables in ``names`` (default all)."""
    names = list(RAW_BUILDERS) if names is None else list(names)
    return {n: RAW_BUILDERS[n](spark, sf_dir) for n in names}
