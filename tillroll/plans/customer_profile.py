"""R4 customer_profile_summary: per customer with at least one cleaned
order — spend, recency, tenure, favourite category and last order.

Plan shape.  Orders are aggregated per ``customer_id`` *before* the
customer attributes are attached (map-side partial aggregation absorbs a
customer that owns a large share of orders; the attribute join then sees
one row per customer).  The reference groups by customer_id plus five
attributes after the join; the attributes are functionally dependent on
customer_id (customers are unique), so the result is identical.

``completed_orders`` is the reference's ``count(DISTINCT order_id) FILTER
(status = 'completed')``; cleaned orders are unique per order_id and no
join here multiplies them, so it is a plain conditional count (no
distinct aggregation).

The last order (status and payment method of the latest order) is one
more aggregate of the same per-customer roll-up, so orders are shuffled
by customer once.  The favourite category reuses the per-(order, category)
line counts shared with R1 (``order_lines``), joined to orders on
``order_id`` (inner: item lines of dropped orders would form a NULL
customer that the final left join discards anyway).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_mean, money_round, money_sum, run_date_lit
from tillroll.operators import count_where, first_by, top1_per_key
from tillroll.plans.order_summary import order_category_counts

ATTRS = ["customer_name", "email", "region", "customer_segment", "signup_date"]


def _latest_first(date_col: str = "order_date", tie: str = "order_id") -> list:
    """Ascending sort key for "latest date first, NULL dates last, then the
    smallest id" (usable by ``first_by``)."""
    d = F.col(date_col)
    return [d.isNull(), -F.unix_date(d), F.col(tie)]


def _per_customer(orders: DataFrame, with_last: bool) -> DataFrame:
    last = first_by(F.struct("order_status", "payment_method"), _latest_first())
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        count_where(F.col("order_status") == "completed").alias("completed_orders"),
        money_sum("total_amount").alias("_spent"),
        F.count("total_amount").alias("_n_amount"),
        money_sum("discount_amount").alias("_discounts"),
        F.min("order_date").alias("first_purchase_date"),
        F.max("order_date").alias("last_purchase_date"),
        *([last.alias("_last")] if with_last else []),
    )


def _metrics(per_customer: DataFrame, customers: DataFrame, date) -> DataFrame:
    last = F.col("last_purchase_date")
    return per_customer.join(customers.select("customer_id", *ATTRS), "customer_id", "left").select(
        "customer_id", *ATTRS, "total_orders", "completed_orders",
        money_round("_spent").alias("total_spent"),
        money_mean("_spent", "_n_amount").alias("avg_order_value"),
        money_round("_discounts").alias("total_discounts_received"),
        "first_purchase_date", "last_purchase_date",
        F.datediff(run_date_lit(date), last).alias("days_since_last_purchase"),
        F.datediff(last, F.col("signup_date")).alias("customer_tenure_days"),
        *([F.col("_last")] if "_last" in per_customer.columns else []),
    )


def customer_order_metrics(orders: DataFrame, customers: DataFrame, date) -> DataFrame:
    """Order counts, spend, first/last purchase, recency, tenure."""
    return _metrics(_per_customer(orders, with_last=False), customers, date)


def favorite_category(orders: DataFrame, order_items: DataFrame, products: DataFrame,
                      lines: DataFrame | None = None) -> DataFrame:
    """Per customer, the category with the most item lines over all
    their cleaned orders; ties to the smallest category, NULL last."""
    per_customer_cat = (
        order_category_counts(order_items, products, lines)
        .join(orders.select("order_id", "customer_id"), "order_id", "inner")
        .groupBy("customer_id", "category")
        .agg(F.sum("cat_count").alias("item_count"))
    )
    return top1_per_key(
        per_customer_cat, ["customer_id"], [F.col("item_count").desc(), F.col("category").asc_nulls_last()]
    ).select("customer_id", F.col("category").alias("favorite_category"))


def last_order(orders: DataFrame) -> DataFrame:
    """Status and payment method of each customer's latest order
    (latest date, NULL dates last; ties to the smallest order_id)."""
    return top1_per_key(
        orders.select("customer_id", "order_id", "order_date", "order_status", "payment_method"),
        ["customer_id"],
        [F.col("order_date").desc_nulls_last(), F.col("order_id").asc_nulls_last()],
    ).select(
        "customer_id",
        F.col("order_status").alias("last_order_status"),
        F.col("payment_method").alias("last_payment_method"),
    )


def transform(orders, customers, order_items, products, date,
              order_category_lines: DataFrame | None = None) -> DataFrame:
    # The last order (R4c) is one more aggregate of the per-customer roll-up
    # (one shuffle of the orders by customer, not two).
    return (
        _metrics(_per_customer(orders, with_last=True), customers, date)
        .join(favorite_category(orders, order_items, products, order_category_lines), "customer_id", "left")
        .select(
            "customer_id", *ATTRS, "total_orders", "completed_orders", "total_spent", "avg_order_value",
            "total_discounts_received", "first_purchase_date", "last_purchase_date",
            "days_since_last_purchase", "customer_tenure_days", "favorite_category",
            F.col("_last.order_status").alias("last_order_status"),
            F.col("_last.payment_method").alias("last_payment_method"),
            run_date_lit(date).alias("ingestion_date"),
        )
    )
