"""R2 monthly_sales: revenue, units, distinct orders and customers by
(year, month, region, category), over item lines of ``completed`` orders
whose kept transaction is ``success``.

Plan shape.  The qualifying filters run on the order and transaction
tables before any join (the reference's left joins are null-rejected by
the filter, i.e. inner joins).  Instead of two exact COUNT DISTINCTs over
item rows (which Spark executes by replicating every row once per
distinct column), the report aggregates in three levels, each with
map-side partial aggregation:

1. item lines -> (order_id, category): revenue of the cent-rounded lines
   and units (the per-(order, category) lines shared with order_summary and
   customer_profile_summary, see ``order_lines``);
2. joined with the qualifying orders (co-partitioned on order_id) ->
   (year, month, category, customer_id): number of orders (each
   (order, category) pair is unique after level 1, so a plain count is the
   distinct order count); the customer's region is attached to these rows;
3. -> (year, month, region, category): sums, and a plain count of
   customers (unique after level 2, each with one region).

A hot customer or group is absorbed by the partial aggregates, a hot order by
the two stages of level 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_round, money_total, ratio2, round2, run_date_lit
from tillroll.operators import salted_join, salted_left_join
from tillroll.plans.order_lines import lines_or_build

GROUP = ["year", "month", "region", "category"]


def qualifying_orders(orders: DataFrame, customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """(order_id, customer_id, order_date, year, month, region) of completed
    orders with a successful kept transaction."""
    ok_txn = transactions.filter(F.col("transaction_status") == "success").select("order_id")
    return (
        orders.filter(F.col("order_status") == "completed")
        .select("order_id", "customer_id", "order_date")
        .join(ok_txn, "order_id", "left_semi")
        .transform(salted_left_join, customers.select("customer_id", "region"), "customer_id", "order_id", orders)
        .select(
            "order_id", "customer_id", "order_date",
            F.year("order_date").alias("year"), F.month("order_date").alias("month"), "region",
        )
    )


def sales_lines(orders, customers, order_items, products, transactions) -> DataFrame:
    """The qualifying item lines with their attributes and the
    per-line revenue rounded to cents."""
    q = qualifying_orders(orders, customers, transactions)
    return (
        # an order's lines may be most of the table: heavy orders are split
        order_items.transform(salted_join, q, "order_id", "order_item_id", "inner")
        .transform(salted_left_join, products.select("product_id", "category", "sub_category"), "product_id", "order_item_id", order_items)
        .select(
            "order_item_id", "order_id", "customer_id", "product_id", "category", "sub_category", "region",
            "order_date", "year", "month", "quantity", "price_per_unit",
            round2(F.col("quantity") * F.col("price_per_unit")).alias("line_revenue"),
        )
    )


def transform(orders, customers, order_items, products, transactions, date,
              order_category_lines: DataFrame | None = None) -> DataFrame:
    per_order_cat = lines_or_build(order_category_lines, order_items, products).select(
        "order_id", "category", F.col("line_revenue").alias("revenue"), "units"
    )
    ok_txn = transactions.filter(F.col("transaction_status") == "success").select("order_id")
    qualifying = (
        orders.filter(F.col("order_status") == "completed")
        .join(ok_txn, "order_id", "left_semi")  # both sides partitioned on order_id by their cleaners
        .select("order_id", "customer_id", F.year("order_date").alias("year"), F.month("order_date").alias("month"))
    )
    # region depends on the customer only: attach it after reducing to one row
    # per (month, category, customer) instead of shuffling every order to it
    per_customer = (
        per_order_cat.join(qualifying, "order_id", "inner")
        .groupBy("year", "month", "category", "customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), money_total("revenue").alias("revenue"), F.sum("units").alias("units"))
        .join(customers.select("customer_id", "region"), "customer_id", "left")
    )
    out = per_customer.groupBy(*GROUP).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        money_round(money_total("revenue")).alias("gross_revenue"),
        F.sum("units").alias("total_units_sold"),
    )
    return out.select(
        *GROUP, "total_orders", "unique_customers", "gross_revenue", "total_units_sold",
        ratio2("gross_revenue", "total_orders").alias("avg_order_value"),
        run_date_lit(date).alias("ingestion_date"),
    )
