"""R3 monthly_performance: monthly order KPIs, status counts, rates and
month-over-month growth.

Revenue, discounts and averages cover every status; every rate divides by
all orders of the month.  Growth compares with the previous *existing*
month row (a calendar gap is not filled; the NULL-date month sorts first).

Plan shape: orders and their kept transaction are both partitioned on
``order_id`` by their cleaners, so the status lookup is a co-partitioned
join.  The monthly aggregate has map-side partial aggregation (the one
exact distinct count, of customers, is planned by Spark as a two-step
aggregate on (year, month, customer_id)).  The growth window runs on the
aggregated months only: one row per calendar month, so the single-partition
window is bounded by the number of months in the data, never by rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import growth_pct, money_round, money_sum, pct, ratio2, run_date_lit
from tillroll.operators import count_where

STATUSES = ["completed", "shipped", "returned", "cancelled"]


def monthly_kpis(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """The per-month aggregate and its rates (no growth)."""
    status = F.col("order_status")
    enriched = orders.select(
        "order_id", "customer_id", "order_status", "total_amount", "discount_amount",
        F.year("order_date").alias("year"), F.month("order_date").alias("month"),
    ).join(transactions.select("order_id", "transaction_status"), "order_id", "left")
    m = enriched.groupBy("year", "month").agg(
        F.count("order_id").alias("total_orders"),
        *[count_where(status == s).alias(f"{s}_orders") for s in STATUSES],
        F.count_distinct("customer_id").alias("unique_customers"),
        money_round(money_sum("total_amount")).alias("total_revenue"),
        money_round(money_sum("discount_amount")).alias("total_discounts"),
        count_where(F.col("transaction_status") == "success").alias("successful_transactions"),
    )
    return m.select(
        "year", "month", "total_orders", *[f"{s}_orders" for s in STATUSES], "unique_customers",
        "total_revenue",
        ratio2("total_revenue", "total_orders").alias("avg_order_value"),
        "total_discounts",
        pct("completed_orders", "total_orders").alias("completion_rate_pct"),
        pct("returned_orders", "total_orders").alias("return_rate_pct"),
        pct("cancelled_orders", "total_orders").alias("cancellation_rate_pct"),
        "successful_transactions",
        pct("successful_transactions", "total_orders").alias("transaction_success_rate_pct"),
    )


def with_growth(kpis: DataFrame) -> DataFrame:
    """Month-over-month growth of revenue and order count.

    Input must be one row per (year, month) — an already-aggregated,
    bounded table — because the ordering window has no partition key."""
    w = Window.orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first())
    return kpis.select(
        "*",
        growth_pct("total_revenue", F.lag("total_revenue").over(w)).alias("revenue_mom_growth_pct"),
        growth_pct("total_orders", F.lag("total_orders").over(w)).alias("orders_mom_growth_pct"),
    )


def transform(orders, transactions, date) -> DataFrame:
    out = with_growth(monthly_kpis(orders, transactions))
    return out.select("*", run_date_lit(date).alias("ingestion_date"))
