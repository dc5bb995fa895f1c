"""Declared schemas: the five raw inputs as they arrive in CSV (all text), the
five cleaned tables, and the six report outputs (column order and type)."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

S, D, I, L, DT = StringType(), DoubleType(), IntegerType(), LongType(), DateType()


def _struct(fields: list[tuple[str, DataType]]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# The input tables, their columns and order, as produced by the
# upstream generator (one CSV file per table, header row first).
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": ["customer_id", "customer_name", "email", "signup_date", "region", "customer_segment"],
    "products": ["product_id", "product_name", "category", "sub_category", "brand", "unit_price"],
    "orders": ["order_id", "customer_id", "order_date", "order_status", "total_amount",
               "discount_amount", "payment_method"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "price_per_unit"],
    "transactions": ["transaction_id", "order_id", "transaction_date", "transaction_amount",
                     "transaction_status"],
}

TABLES = tuple(RAW_COLUMNS)

# CSV is read with every column as text; the cleaners parse it leniently.
RAW_CSV: dict[str, StructType] = {t: _struct([(c, S) for c in cols]) for t, cols in RAW_COLUMNS.items()}

CLEAN: dict[str, StructType] = {
    "customers": _struct([("customer_id", S), ("customer_name", S), ("email", S), ("signup_date", DT),
                          ("region", S), ("customer_segment", S)]),
    "products": _struct([("product_id", S), ("product_name", S), ("category", S), ("sub_category", S),
                         ("brand", S), ("unit_price", D)]),
    "orders": _struct([("order_id", S), ("customer_id", S), ("order_date", DT), ("order_status", S),
                       ("total_amount", D), ("discount_amount", D), ("payment_method", S)]),
    "order_items": _struct([("order_item_id", S), ("order_id", S), ("product_id", S), ("quantity", I),
                            ("price_per_unit", D)]),
    "transactions": _struct([("transaction_id", S), ("order_id", S), ("transaction_date", DT),
                             ("transaction_amount", D), ("transaction_status", S)]),
}

REPORT: dict[str, StructType] = {
    "order_summary": _struct([
        ("order_id", S), ("customer_id", S), ("customer_name", S), ("email", S), ("region", S),
        ("customer_segment", S), ("signup_date", DT), ("order_date", DT), ("order_status", S),
        ("payment_method", S), ("total_amount", D), ("discount_amount", D), ("discount_pct", D),
        ("net_amount", D), ("total_line_items", L), ("total_quantity", L), ("items_revenue", D),
        ("top_category", S), ("transaction_id", S), ("transaction_status", S), ("transaction_date", DT),
        ("transaction_amount", D), ("ingestion_date", DT)]),
    "monthly_sales": _struct([
        ("year", I), ("month", I), ("region", S), ("category", S), ("total_orders", L),
        ("unique_customers", L), ("gross_revenue", D), ("total_units_sold", L), ("avg_order_value", D),
        ("ingestion_date", DT)]),
    "monthly_performance": _struct([
        ("year", I), ("month", I), ("total_orders", L), ("completed_orders", L), ("shipped_orders", L),
        ("returned_orders", L), ("cancelled_orders", L), ("unique_customers", L), ("total_revenue", D),
        ("avg_order_value", D), ("total_discounts", D), ("completion_rate_pct", D), ("return_rate_pct", D),
        ("cancellation_rate_pct", D), ("successful_transactions", L), ("transaction_success_rate_pct", D),
        ("revenue_mom_growth_pct", D), ("orders_mom_growth_pct", D), ("ingestion_date", DT)]),
    "customer_profile_summary": _struct([
        ("customer_id", S), ("customer_name", S), ("email", S), ("region", S), ("customer_segment", S),
        ("signup_date", DT), ("total_orders", L), ("completed_orders", L), ("total_spent", D),
        ("avg_order_value", D), ("total_discounts_received", D), ("first_purchase_date", DT),
        ("last_purchase_date", DT), ("days_since_last_purchase", I), ("customer_tenure_days", I),
        ("favorite_category", S), ("last_order_status", S), ("last_payment_method", S), ("ingestion_date", DT)]),
    "customer_transactions": _struct([
        ("customer_id", S), ("customer_name", S), ("email", S), ("region", S), ("customer_segment", S),
        ("total_transactions", L), ("successful_transactions", L), ("failed_transactions", L),
        ("transaction_success_rate_pct", D), ("total_transaction_value", D), ("avg_transaction_value", D),
        ("max_transaction_value", D), ("min_transaction_value", D), ("first_transaction_date", DT),
        ("last_transaction_date", DT), ("preferred_payment_method", S), ("ingestion_date", DT)]),
    "customer_retention": _struct([
        ("cohort_year", I), ("cohort_month", I), ("activity_year", I), ("activity_month", I),
        ("periods_since_cohort", I), ("cohort_size", L), ("active_customers", L), ("retention_rate_pct", D),
        ("ingestion_date", DT)]),
}
