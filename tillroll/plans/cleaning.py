"""The five cleaners.

Each takes a raw DataFrame (CSV text or already-typed columns) and returns
the cleaned table in the column order of ``schemas.CLEAN``.  Parsing is
lenient (bad text -> NULL) so one malformed value never fails the batch.
Row filters run before de-duplication, so an invalid row never shadows a
valid duplicate of the same key.

Every de-duplication is one shuffle on the key, with a map-side partial
top-1 in front of it (see ``operators.top1_per_key``); the cleaned table
therefore comes out hash-partitioned on its key, which the reports reuse
for their joins on ``order_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions import clean_code, clean_text, to_day, to_double, to_int
from tillroll.operators import dedup_by_key, drop_null_keys, top1_per_key
from tillroll.schemas import CLEAN

# The accepted order statuses, after trim + lower-case.
VALID_ORDER_STATUSES = ["completed", "shipped", "returned", "cancelled"]


def clean_customers(df: DataFrame) -> DataFrame:
    out = drop_null_keys(df, ["customer_id", "email"]).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        clean_text("customer_name").alias("customer_name"),
        clean_code("email").alias("email"),
        to_day("signup_date").alias("signup_date"),
        clean_text("region").alias("region"),
        clean_text("customer_segment").alias("customer_segment"),
    )
    return dedup_by_key(out, ["customer_id"])


def clean_products(df: DataFrame) -> DataFrame:
    out = drop_null_keys(df, ["product_id"]).select(
        F.col("product_id").cast("string").alias("product_id"),
        clean_text("product_name").alias("product_name"),
        clean_text("category").alias("category"),
        clean_text("sub_category").alias("sub_category"),
        clean_text("brand").alias("brand"),
        to_double("unit_price").alias("unit_price"),
    )
    return dedup_by_key(out, ["product_id"])


def clean_orders(df: DataFrame) -> DataFrame:
    out = (
        drop_null_keys(df, ["order_id", "customer_id"])
        .select(
            F.col("order_id").cast("string").alias("order_id"),
            F.col("customer_id").cast("string").alias("customer_id"),
            to_day("order_date").alias("order_date"),
            clean_code("order_status").alias("order_status"),
            to_double("total_amount").alias("total_amount"),
            to_double("discount_amount").alias("discount_amount"),
            F.col("payment_method").cast("string").alias("payment_method"),
        )
        .filter(F.col("order_status").isin(VALID_ORDER_STATUSES))
    )
    return dedup_by_key(out, ["order_id"])


def clean_order_items(df: DataFrame) -> DataFrame:
    out = (
        drop_null_keys(df, ["order_item_id", "order_id", "product_id"])
        .select(
            F.col("order_item_id").cast("string").alias("order_item_id"),
            F.col("order_id").cast("string").alias("order_id"),
            F.col("product_id").cast("string").alias("product_id"),
            to_int("quantity").alias("quantity"),
            to_double("price_per_unit").alias("price_per_unit"),
        )
        .filter((F.col("quantity") > 0) & (F.col("price_per_unit") > 0))
    )
    return dedup_by_key(out, ["order_item_id"])


def clean_transactions(df: DataFrame) -> DataFrame:
    """One transaction per order: the latest by day; ties broken by
    transaction_id, then amount, then status (all ascending, NULLs last)."""
    out = drop_null_keys(df, ["transaction_id", "order_id"]).select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("order_id").cast("string").alias("order_id"),
        to_day("transaction_date").alias("transaction_date"),
        to_double("transaction_amount").alias("transaction_amount"),
        clean_code("transaction_status").alias("transaction_status"),
    )
    return top1_per_key(
        out,
        ["order_id"],
        [
            F.col("transaction_date").desc_nulls_last(),
            F.col("transaction_id").asc_nulls_last(),
            F.col("transaction_amount").asc_nulls_last(),
            F.col("transaction_status").asc_nulls_last(),
        ],
    )


# Key columns that must not be NULL, and the key that rows are de-duplicated on.
REQUIRED = {
    "customers": ["customer_id", "email"],
    "products": ["product_id"],
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_item_id", "order_id", "product_id"],
    "transactions": ["transaction_id", "order_id"],
}
UNIQUE = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "order_items": "order_item_id", "transactions": "order_id"}
#: Why a cleaner drops a row, in the order in which the rules are tried.
REASONS = ("null_key", "bad_status", "unparseable", "out_of_range")


def _null_key(df: DataFrame, table: str) -> Column:
    out = F.lit(False)
    for c in REQUIRED[table]:
        out = out | F.col(c).isNull()
        if dict(df.dtypes)[c] in ("float", "double"):
            out = out | F.isnan(F.col(c))
    return out


def drop_reason(df: DataFrame, table: str) -> Column:
    """Why the cleaner drops a raw row of ``table`` before de-duplication; NULL if it stays.

    ``unparseable``: a quantity or price that is there but is no number in range;
    ``out_of_range``: missing, zero or negative."""
    why = F.when(_null_key(df, table), "null_key")
    if table == "orders":
        status = clean_code("order_status")
        why = why.when(status.isNull() | ~status.isin(VALID_ORDER_STATUSES), "bad_status")
    if table == "order_items":
        quantity, price = to_int("quantity"), to_double("price_per_unit")
        why = why.when((F.col("quantity").isNotNull() & quantity.isNull()) | (F.col("price_per_unit").isNotNull() & price.isNull()), "unparseable")
        why = why.when(quantity.isNull() | price.isNull() | (quantity <= 0) | (price <= 0), "out_of_range")
    return why


def loss_counts(df: DataFrame, table: str) -> list[Column]:
    """Aggregates over raw rows, for ``Dataset.observe``: rows read, and dropped by reason."""
    why = drop_reason(df, table)
    return [F.count(F.lit(1)).alias("read"), *[F.count_if(why == r).alias(r) for r in REASONS]]


def losses(raw: dict[str, DataFrame]) -> DataFrame:
    """(table_name, reason, n_rows): rows that each cleaner reads and drops by reason,
    ``duplicate`` for those that share a kept row's key, and rows ``kept``.
    Reasons that no row has are left out; the others add up to the rows read.

    One scan and one partial aggregate by reason for each table; duplicates are counted by key."""
    out = None
    for table, df in raw.items():
        reasons = df.select(drop_reason(df, table).alias("reason"), F.col(UNIQUE[table]).cast("string").alias("key"))
        dropped = reasons.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n_rows"))
        keys = reasons.where("reason is null").groupBy("key").agg(F.count("*").alias("n"))
        kept = keys.select(F.explode(F.array(F.struct(F.lit("kept").alias("reason"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("duplicate").alias("reason"), (F.col("n") - 1).alias("n")))).alias("x"))
        kept = kept.groupBy("x.reason").agg(F.sum("x.n").alias("n_rows")).where("n_rows > 0")
        rows = dropped.union(kept).select(F.lit(table).alias("table_name"), "reason", "n_rows")
        out = rows if out is None else out.union(rows)
    return out


CLEANERS = {
    "customers": clean_customers,
    "products": clean_products,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "transactions": clean_transactions,
}


def clean_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Clean every raw table present in ``raw``."""
    out = {name: CLEANERS[name](df) for name, df in raw.items()}
    for name, df in out.items():
        expected = [f.name for f in CLEAN[name].fields]
        assert df.columns == expected, (name, df.columns)
    return out
