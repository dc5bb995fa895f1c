"""Synthetic raw inputs at any scale, generated on the executors.

The upstream generator draws the five raw tables row by row in one process.
Here every table is ``spark.range(n)`` plus deterministic column
expressions: each random draw is a hash of (row id, seed, column), so the
output is reproducible, needs no driver-side state, and a billion rows
cost the same code as a thousand.  Foreign keys are drawn with replacement
by hashing into the parent's id range and re-deriving the parent's key
arithmetically, so no join is needed to produce a valid reference.
Person and company names are plain numbered labels (no name library).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default table sizes of the upstream generator.
DEFAULT_SIZES = {"customers": 1000, "products": 500, "orders": 5000, "order_items": 2000, "transactions": 5000}

# Value domains and weights of the upstream generator.
SEGMENTS = ["Regular", "Premium", "VIP", "Loyal", "Occasional"]
REGIONS = ["North America", "Europe", "Asia", "South America", "Australia", "Africa", "Middle East",
           "Southeast Asia"]
CATEGORIES = {
    "Electronics": ["Mobile Phones", "Laptops", "Accessories", "Cameras", "TVs"],
    "Clothing": ["Men", "Women", "Kids", "Accessories", "Footwear"],
    "Home & Kitchen": ["Appliances", "Furniture", "Kitchenware", "Bedding", "Decor"],
    "Books": ["Fiction", "Non-Fiction", "Comics", "Textbooks", "E-books"],
    "Toys": ["Action Figures", "Dolls", "Educational", "Board Games", "Outdoor"],
    "Sports": ["Fitness", "Outdoor Gear", "Team Sports", "Cycling", "Running"],
    "Beauty": ["Skincare", "Makeup", "Haircare", "Fragrances", "Nail Care"],
    "Automotive": ["Car Accessories", "Motorcycle", "Tools", "Electronics", "Parts"],
}
CATEGORY_WEIGHTS = [0.30, 0.20, 0.20, 0.10, 0.08, 0.06, 0.04, 0.02]
ORDER_STATUSES = ["completed", "shipped", "returned", "cancelled"]
ORDER_STATUS_WEIGHTS = [0.70, 0.20, 0.05, 0.05]
PAYMENT_METHODS = ["credit_card", "paypal", "cash", "bank_transfer", "gift_card"]
TRANSACTION_STATUSES = ["success", "failed"]
TRANSACTION_STATUS_WEIGHTS = [0.95, 0.05]
SIGNUP_RANGE = (_dt.datetime(2018, 1, 1), _dt.datetime(2024, 10, 1))
ACTIVITY_RANGE = (_dt.datetime(2019, 1, 1), _dt.datetime(2024, 12, 31))
UNIT_PRICE_RANGE = (5.0, 1500.0)
ORDER_TOTAL_RANGE = (5.0, 1000.0)
DISCOUNT_RANGE = (0.0, 50.0)
QUANTITY_RANGE = (1, 5)
ITEM_PRICE_RANGE = (1.0, 300.0)
TRANSACTION_AMOUNT_RANGE = (5.0, 1000.0)

_2_POW_53 = float(2**53)


def _u(seed: int, column: str) -> Column:
    """Uniform draw in [0, 1) from (row id, seed, column)."""
    h = F.xxhash64(F.col("id"), F.lit(seed), F.lit(column))
    return F.pmod(h, F.lit(2**53)).cast("double") / F.lit(_2_POW_53)


def _index(seed: int, column: str, n: int) -> Column:
    """Uniform integer in [0, n)."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(column)), F.lit(n))


def _key(prefix: str, seed: int, idx: Column) -> Column:
    """A UUID-shaped key derived from (table, seed, index): unique per index."""
    h = F.md5(F.concat_ws(":", F.lit(prefix), F.lit(seed), idx.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def _choice(u: Column, values: list[str], weights: list[float] | None = None) -> Column:
    """Pick from ``values`` with ``weights`` (uniform by default) using draw ``u``."""
    weights = weights or [1.0 / len(values)] * len(values)
    total = sum(weights)
    expr, acc = None, 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w / total
        expr = F.when(u < acc, F.lit(v)) if expr is None else expr.when(u < acc, F.lit(v))
    return F.lit(values[-1]) if expr is None else expr.otherwise(F.lit(values[-1]))


def _uniform(u: Column, lo: float, hi: float) -> Column:
    return F.round(F.lit(lo) + u * F.lit(hi - lo), 2)


def _timestamp(u: Column, rng: tuple[_dt.datetime, _dt.datetime]) -> Column:
    lo, hi = (int(x.replace(tzinfo=_dt.timezone.utc).timestamp()) for x in rng)
    secs = F.lit(lo) + F.floor(u * F.lit(hi - lo + 1)).cast("long")
    return F.timestamp_seconds(secs).cast("timestamp_ntz")


def customers(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    return spark.range(n, numPartitions=partitions).select(
        _key("customer", seed, F.col("id")).alias("customer_id"),
        F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("customer_name"),
        F.concat(F.lit("customer"), F.col("id").cast("string"), F.lit("@example.com")).alias("email"),
        _timestamp(_u(seed, "signup"), SIGNUP_RANGE).alias("signup_date"),
        _choice(_u(seed, "region"), REGIONS).alias("region"),
        _choice(_u(seed, "segment"), SEGMENTS).alias("customer_segment"),
    )


def products(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    cats = list(CATEGORIES)
    category = _choice(_u(seed, "category"), cats, CATEGORY_WEIGHTS)
    sub_u = _u(seed, "sub_category")
    sub = F.lit(None).cast("string")
    for c in reversed(cats):
        sub = F.when(category == c, _choice(sub_u, CATEGORIES[c])).otherwise(sub)
    return spark.range(n, numPartitions=partitions).select(
        _key("product", seed, F.col("id")).alias("product_id"),
        F.concat(F.lit("Product "), F.col("id").cast("string")).alias("product_name"),
        category.alias("category"),
        sub.alias("sub_category"),
        F.concat(F.lit("Brand "), (F.col("id") % 97).cast("string")).alias("brand"),
        _uniform(_u(seed, "unit_price"), *UNIT_PRICE_RANGE).alias("unit_price"),
    )


def orders(spark: SparkSession, n: int, n_customers: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    return spark.range(n, numPartitions=partitions).select(
        _key("order", seed, F.col("id")).alias("order_id"),
        _key("customer", seed, _index(seed, "customer", n_customers)).alias("customer_id"),
        _timestamp(_u(seed, "order_date"), ACTIVITY_RANGE).alias("order_date"),
        _choice(_u(seed, "status"), ORDER_STATUSES, ORDER_STATUS_WEIGHTS).alias("order_status"),
        _uniform(_u(seed, "total"), *ORDER_TOTAL_RANGE).alias("total_amount"),
        _uniform(_u(seed, "discount"), *DISCOUNT_RANGE).alias("discount_amount"),
        _choice(_u(seed, "payment"), PAYMENT_METHODS).alias("payment_method"),
    )


def order_items(spark: SparkSession, n: int, n_orders: int, n_products: int, seed: int = 0,
                partitions: int | None = None) -> DataFrame:
    qlo, qhi = QUANTITY_RANGE
    return spark.range(n, numPartitions=partitions).select(
        _key("order_item", seed, F.col("id")).alias("order_item_id"),
        _key("order", seed, _index(seed, "item_order", n_orders)).alias("order_id"),
        _key("product", seed, _index(seed, "item_product", n_products)).alias("product_id"),
        (F.lit(qlo) + _index(seed, "quantity", qhi - qlo + 1)).cast("int").alias("quantity"),
        _uniform(_u(seed, "item_price"), *ITEM_PRICE_RANGE).alias("price_per_unit"),
    )


def transactions(spark: SparkSession, n: int, n_orders: int, seed: int = 0,
                 partitions: int | None = None) -> DataFrame:
    return spark.range(n, numPartitions=partitions).select(
        _key("transaction", seed, F.col("id")).alias("transaction_id"),
        _key("order", seed, _index(seed, "txn_order", n_orders)).alias("order_id"),
        _timestamp(_u(seed, "txn_date"), ACTIVITY_RANGE).alias("transaction_date"),
        _uniform(_u(seed, "txn_amount"), *TRANSACTION_AMOUNT_RANGE).alias("transaction_amount"),
        _choice(_u(seed, "txn_status"), TRANSACTION_STATUSES, TRANSACTION_STATUS_WEIGHTS)
        .alias("transaction_status"),
    )


def generate(spark: SparkSession, sizes: dict[str, int] | None = None, scale: float = 1.0, seed: int = 0,
             partitions: int | None = None) -> dict[str, DataFrame]:
    """The five raw tables; ``sizes`` default to the upstream defaults times ``scale``."""
    s = {k: max(1, int(round(v * scale))) for k, v in {**DEFAULT_SIZES, **(sizes or {})}.items()}
    return {
        "customers": customers(spark, s["customers"], seed, partitions),
        "products": products(spark, s["products"], seed, partitions),
        "orders": orders(spark, s["orders"], s["customers"], seed, partitions),
        "order_items": order_items(spark, s["order_items"], s["orders"], s["products"], seed, partitions),
        "transactions": transactions(spark, s["transactions"], s["orders"], seed, partitions),
    }


def write_csv(spark: SparkSession, base: str, **kwargs) -> dict[str, str]:
    """Generate and write ``<base>/<table>.csv`` for the five tables (the
    input layout the batch job reads); returns the paths."""
    from tillroll.sources import csv as csv_source

    tables = generate(spark, **kwargs)
    csv_source.write_raw_tables(tables, base)
    return {t: csv_source.table_uri(base, t) for t in tables}
