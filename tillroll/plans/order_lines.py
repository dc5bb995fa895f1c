"""The item lines of every order rolled up per (order, category).

Three reports read item lines per order and category: order_summary (line
count, units, revenue, top category), monthly_sales (units and revenue of
cent-rounded lines) and the favourite category of customer_profile_summary
(line count).  Each needs the item -> product join and a roll-up of every
item row — at scale the costliest step of those reports.  This one
aggregate carries what all three need, so the batch job computes it once.
Money is summed exactly (order-independent), so the sums it holds are the
same as summing the lines directly.

The roll-up has two stages, so an order that owns a third of all lines sends
its task at most one row for each product and salt (or for each category and map
task), not its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_sum, money_total, round2
from tillroll.operators import _SALT, salted_join


def order_category_lines(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """(order_id, category, cat_count, units, revenue, line_revenue).

    ``cat_count`` counts item lines, ``units`` sums quantities, ``revenue``
    is the money sum of quantity x price, ``line_revenue`` that of the
    cent-rounded line amounts.  Items of unknown products form a NULL
    category, which counts like any other."""
    amount = F.col("quantity") * F.col("price_per_unit")
    lines = salted_join(
        order_items.select("order_id", "product_id", "order_item_id", "quantity", "price_per_unit"),
        products.select("product_id", "category"), "product_id", "order_item_id", keep_salt=True,
    )
    # Before the order_id exchange: where the join left the lines partitioned on
    # (product, salt), one row for each of those and order, with no exchange; after
    # a broadcast join, one for each (order, category), summed on the map side.
    here = ["product_id", _SALT] if _SALT in lines.columns else []
    partial = lines.groupBy("order_id", "category", *here).agg(
        F.count("order_item_id").alias("cat_count"),
        F.sum("quantity").alias("units"),
        money_sum(amount).alias("revenue"),
        money_sum(round2(amount)).alias("line_revenue"),
    )
    return (
        # on order_id alone: every reader joins or groups by it, with no shuffle of its own
        partial.repartition("order_id")
        .groupBy("order_id", "category")
        .agg(
            F.sum("cat_count").alias("cat_count"),
            F.sum("units").alias("units"),
            money_total("revenue").alias("revenue"),
            money_total("line_revenue").alias("line_revenue"),
        )
    )


def lines_or_build(lines: DataFrame | None, order_items: DataFrame, products: DataFrame) -> DataFrame:
    return lines if lines is not None else order_category_lines(order_items, products)
