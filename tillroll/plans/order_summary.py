"""R1 order_summary: one row per cleaned order, enriched with customer
attributes, item totals, top category and the kept transaction.

Plan shape: the two order-level inputs (the item summary — totals and top
category from one roll-up — and the kept transaction) are keyed and
partitioned on ``order_id``, like the cleaned orders themselves (their
de-duplication shuffles on ``order_id``), so the order-level joins are
co-partitioned sort-merge joins.  The customer
join comes last, so the wide order rows are shuffled by ``customer_id`` at
most once (or not at all when the customer side is small enough for
Spark to broadcast on its own size statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_round, money_sum, money_total, round2, run_date_lit
from tillroll.operators import first_by, salted_left_join, top1_per_key
from tillroll.plans.order_lines import lines_or_build

CUSTOMER_ATTRS = ["customer_name", "email", "region", "customer_segment", "signup_date"]


def order_category_counts(order_items: DataFrame, products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """(order_id, category, cat_count): item lines per order and category.
    Unknown products form a NULL category that counts like any other."""
    return lines_or_build(lines, order_items, products).select("order_id", "category", "cat_count")


def top_category_per_order(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The category with the most item lines (not units) per order;
    ties go to the smallest category name, NULL last."""
    occ = order_category_counts(order_items, products)
    return top1_per_key(
        occ, ["order_id"], [F.col("cat_count").desc(), F.col("category").asc_nulls_last()]
    ).select("order_id", F.col("category").alias("top_category"))


def order_item_totals(order_items: DataFrame) -> DataFrame:
    """Lines, units and revenue per order."""
    return order_items.groupBy("order_id").agg(
        F.count("order_item_id").alias("total_line_items"),
        F.sum("quantity").alias("total_quantity"),
        money_round(money_sum(F.col("quantity") * F.col("price_per_unit"))).alias("items_revenue"),
    )


def order_item_summary(order_items: DataFrame, products: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """R1a + R1b in one pass: item lines, units, revenue and top category per
    order, rolled up from the per-(order, category) lines; the top category
    is one more aggregate of the same roll-up (most lines, then smallest
    category, NULL last).  Money is summed exactly, so the two-level sum
    equals the one-level sum."""
    cat = F.col("category")
    return lines_or_build(lines, order_items, products).groupBy("order_id").agg(
        F.sum("cat_count").alias("total_line_items"),
        F.sum("units").alias("total_quantity"),
        money_round(money_total("revenue")).alias("items_revenue"),
        first_by(cat, [-F.col("cat_count"), cat.isNull(), cat]).alias("top_category"),
    )


def transform(orders, customers, order_items, products, transactions, date,
              order_category_lines: DataFrame | None = None) -> DataFrame:
    txn = transactions.select(
        "order_id", "transaction_id", "transaction_status", "transaction_date", "transaction_amount"
    )
    items = order_item_summary(order_items, products, order_category_lines)
    per_order = orders.join(items, "order_id", "left").join(txn, "order_id", "left")
    enriched = salted_left_join(per_order, customers.select("customer_id", *CUSTOMER_ATTRS), "customer_id", "order_id", orders)
    total, discount = F.col("total_amount"), F.col("discount_amount")
    return enriched.select(
        "order_id", "customer_id", *CUSTOMER_ATTRS,
        "order_date", "order_status", "payment_method", "total_amount", "discount_amount",
        F.when(total > 0, round2(discount / total * F.lit(100))).otherwise(F.lit(0.0)).alias("discount_pct"),
        round2(total - discount).alias("net_amount"),
        "total_line_items", "total_quantity", "items_revenue", "top_category",
        "transaction_id", "transaction_status", "transaction_date", "transaction_amount",
        run_date_lit(date).alias("ingestion_date"),
    )
