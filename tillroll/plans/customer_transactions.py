"""R5 customer_transactions: per customer with at least one kept
transaction — counts, success rate, value statistics and preferred
payment method.  Transactions whose order was dropped by cleaning keep
going as one all-NULL customer row (its preferred payment is NULL: a
NULL key never joins).

Plan shape.  Transactions and orders are both partitioned on ``order_id``
by their cleaners, so their join is co-partitioned.  One aggregate at
(customer_id, payment_method) grain — partial on the map side, so a hot
customer or the NULL customer is absorbed — feeds *both* the customer
metrics and the preferred payment method: both come out of the second,
small roll-up per customer (the top-1 is one more aggregate of it).  Customer attributes are attached to the
one-row-per-customer result, not to every transaction; the reference's
group-by on the five attributes is equivalent because they depend on
customer_id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import money_mean, money_round, money_sum, money_total, pct, round2, run_date_lit
from tillroll.operators import count_where, first_by

ATTRS = ["customer_name", "email", "region", "customer_segment"]


def customer_payment_stats(orders: DataFrame, transactions: DataFrame) -> DataFrame:
    """Transaction statistics per (customer_id, payment_method)."""
    status = F.col("transaction_status")
    return (
        transactions.join(orders.select("order_id", "customer_id", "payment_method"), "order_id", "left")
        .groupBy("customer_id", "payment_method")
        .agg(
            F.count("transaction_id").alias("n_txn"),
            count_where(status == "success").alias("n_success"),
            count_where(status == "failed").alias("n_failed"),
            money_sum("transaction_amount").alias("amount_sum"),
            F.count("transaction_amount").alias("amount_n"),
            F.max("transaction_amount").alias("amount_max"),
            F.min("transaction_amount").alias("amount_min"),
            F.min("transaction_date").alias("first_date"),
            F.max("transaction_date").alias("last_date"),
        )
    )


def _txn_metrics(stats: DataFrame, customers: DataFrame) -> DataFrame:
    pm, cid = F.col("payment_method"), F.col("customer_id")
    per_customer = stats.groupBy("customer_id").agg(
        F.sum("n_txn").alias("total_transactions"),
        F.sum("n_success").alias("successful_transactions"),
        F.sum("n_failed").alias("failed_transactions"),
        money_total("amount_sum").alias("_sum"),
        F.sum("amount_n").alias("_n"),
        F.max("amount_max").alias("_max"),
        F.min("amount_min").alias("_min"),
        F.min("first_date").alias("first_transaction_date"),
        F.max("last_date").alias("last_transaction_date"),
        # preferred payment: most transactions, then smallest method, NULL last
        F.when(cid.isNotNull(), first_by(pm, [-F.col("n_txn"), pm.isNull(), pm]))
        .alias("preferred_payment_method"),
    )
    return per_customer.join(customers.select("customer_id", *ATTRS), "customer_id", "left").select(
        "customer_id", *ATTRS, "total_transactions", "successful_transactions", "failed_transactions",
        pct("successful_transactions", "total_transactions").alias("transaction_success_rate_pct"),
        money_round("_sum").alias("total_transaction_value"),
        money_mean("_sum", "_n").alias("avg_transaction_value"),
        round2("_max").alias("max_transaction_value"),
        round2("_min").alias("min_transaction_value"),
        "first_transaction_date", "last_transaction_date", "preferred_payment_method",
    )


def customer_txn_metrics(orders, customers, transactions) -> DataFrame:
    """The per-customer transaction metrics (with the NULL customer)."""
    return _txn_metrics(customer_payment_stats(orders, transactions), customers).drop("preferred_payment_method")


def preferred_payment(orders, transactions) -> DataFrame:
    """The payment method used by most of a customer's transactions;
    ties to the smallest method name, NULL last."""
    return (
        customer_payment_stats(orders, transactions)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(first_by("payment_method", [-F.col("n_txn"), F.col("payment_method").isNull(),
                                          F.col("payment_method")]).alias("preferred_payment_method"))
    )


def transform(orders, customers, transactions, date) -> DataFrame:
    return _txn_metrics(customer_payment_stats(orders, transactions), customers).select(
        "customer_id", *ATTRS, "total_transactions", "successful_transactions", "failed_transactions",
        "transaction_success_rate_pct", "total_transaction_value", "avg_transaction_value",
        "max_transaction_value", "min_transaction_value", "first_transaction_date",
        "last_transaction_date", "preferred_payment_method", run_date_lit(date).alias("ingestion_date"),
    )
