"""R6 customer_retention: signup-cohort x activity-month retention matrix.

A cohort is the (year, month) of signup; a customer is active in a month
when they placed any cleaned order (any status) that month.  Activity
before the signup month and customers without a signup date are dropped;
months with no activity have no row.  ``cohort_size`` counts every
cleaned customer of the cohort, ordering or not.

Plan shape.  Orders are first reduced to distinct (customer_id, year,
month) with map-side partial aggregation — a customer with a huge number
of orders contributes one row per active month.  After the inner join to
the (unique) customers, every (customer, cohort, activity month) is
unique, so ``active_customers`` is a plain count instead of an exact
distinct count.  Both sides of the final join are aggregates with at most
one row per cohort (and activity month); no broadcast is forced — AQE
broadcasts on measured size and falls back to a sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import months_between_periods, pct, run_date_lit

COHORT = ["cohort_year", "cohort_month"]


def _cohorts(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.year("signup_date").alias("cohort_year"),
        F.month("signup_date").alias("cohort_month"),
    )


def cohort_sizes(customers: DataFrame) -> DataFrame:
    """Customers per signup (year, month); NULL signup forms its own cohort."""
    return _cohorts(customers).groupBy(*COHORT).agg(F.count("customer_id").alias("cohort_size"))


def cohort_activity(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct active customers per cohort and activity month."""
    active_months = (
        orders.select(
            "customer_id",
            F.year("order_date").alias("activity_year"),
            F.month("order_date").alias("activity_month"),
        )
        .distinct()
    )
    period = months_between_periods(
        F.col("activity_year"), F.col("activity_month"), F.col("cohort_year"), F.col("cohort_month")
    )
    return (
        active_months.join(_cohorts(customers), "customer_id", "inner")
        .withColumn("periods_since_cohort", period)
        .filter(F.col("periods_since_cohort") >= 0)
        .groupBy(*COHORT, "activity_year", "activity_month", "periods_since_cohort")
        .agg(F.count("customer_id").alias("active_customers"))
    )


def transform(orders, customers, date) -> DataFrame:
    activity = cohort_activity(orders, customers)
    # Both sides are small aggregates (one row per cohort, and per cohort and
    # activity month); Spark picks the join from their measured sizes.
    return activity.join(cohort_sizes(customers), COHORT, "left").select(
        *COHORT, "activity_year", "activity_month", "periods_since_cohort", "cohort_size",
        "active_customers",
        pct("active_customers", "cohort_size").alias("retention_rate_pct"),
        run_date_lit(date).alias("ingestion_date"),
    )
