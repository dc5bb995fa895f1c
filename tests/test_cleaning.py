"""C1-C5 on hand-written dirty rows, and the pre-registered counts of
FIXTURES.md on the driver's tables."""

import datetime as dt

import pytest

from conftest import shape, SF_SMALL, d
from tillroll.catalog import cleaned
from tillroll.plans.cleaning import (
    clean_customers,
    clean_order_items,
    clean_orders,
    clean_products,
    clean_transactions,
)
from tillroll.schemas import CLEAN, RAW_CSV


def raw(spark, table, rows):
    return spark.createDataFrame(rows, RAW_CSV[table])


def test_clean_customers_rules(spark):
    df = raw(spark, "customers", [
        ("C1", "  Ann ", " Ann@Example.COM ", "2020-01-05 10:00:00", " EUROPE", "VIP "),
        ("C1", "Ann (dup)", "ann@dup.com", "2019-01-01 00:00:00", "ASIA", "VIP"),
        ("C2", "Bob", None, "2020-01-01 00:00:00", "ASIA", "VIP"),          # NULL email -> dropped
        (None, "Nobody", "x@y.z", "2020-01-01 00:00:00", "ASIA", "VIP"),    # NULL id -> dropped
        ("C3", "\tTab", "t@t.t", "not a date", "ASIA", "VIP"),              # bad date -> NULL
    ])
    out = {r.customer_id: r for r in clean_customers(df).collect()}
    assert set(out) == {"C1", "C3"}
    # dedup keeps the smallest row by (name, email, ...): "Ann" < "Ann (dup)"
    assert out["C1"].customer_name == "Ann"
    assert out["C1"].email == "ann@example.com"
    assert out["C1"].signup_date == d("2020-01-05")
    assert (out["C1"].region, out["C1"].customer_segment) == ("EUROPE", "VIP")
    assert out["C3"].customer_name == "\tTab" and out["C3"].signup_date is None
    assert shape(clean_customers(df).schema) == shape(CLEAN["customers"])


def test_dedup_is_deterministic_in_both_input_orders(spark):
    a = ("C1", "Zed", "z@z.z", "2020-01-01", "R", "S")
    b = ("C1", "Amy", "a@a.a", "2020-01-01", "R", "S")
    for rows in ([a, b], [b, a]):
        out = clean_customers(raw(spark, "customers", rows).repartition(3)).collect()
        assert [r.customer_name for r in out] == ["Amy"]


def test_clean_products_rules(spark):
    df = raw(spark, "products", [
        ("P1", " Widget", "Tools ", " w ", "Acme", "12.50"),
        ("P1", "Widget", "PROMO", "w", "Acme", "1.00"),
        ("P2", "Gadget", "Toys", "g", "Acme", "n/a"),          # malformed price -> NULL, kept
        (None, "Ghost", "Toys", "g", "Acme", "1.00"),          # NULL id -> dropped
    ])
    out = {r.product_id: r for r in clean_products(df).collect()}
    assert set(out) == {"P1", "P2"}
    assert (out["P1"].category, out["P1"].unit_price) == ("PROMO", 1.0)   # "Widget"=="Widget", "PROMO" < "Tools"
    assert out["P2"].unit_price is None


def test_clean_orders_filter_before_dedup(spark):
    df = raw(spark, "orders", [
        ("O1", "C1", "2020-02-03 08:00:00", "pending", "10.0", "1.0", "cash"),      # invalid status
        ("O1", "C1", "2020-02-03 08:00:00", " Completed ", "10.0", "1.0", "cash"),  # valid duplicate wins
        ("O2", None, "2020-02-03 08:00:00", "shipped", "10.0", "1.0", "cash"),     # NULL customer
        ("O3", "C1", "2020-02-03", "CANCELLED", "abc", "", "Cash "),               # bad numbers -> NULL
    ])
    out = {r.order_id: r for r in clean_orders(df).collect()}
    assert set(out) == {"O1", "O3"}
    assert out["O1"].order_status == "completed"
    assert out["O3"].order_status == "cancelled"
    assert out["O3"].total_amount is None and out["O3"].discount_amount is None
    assert out["O3"].payment_method == "Cash "  # payment_method is not normalised


def test_clean_order_items_rules(spark):
    df = raw(spark, "order_items", [
        ("I1", "O1", "P1", "3.7", "2.5"),     # '3.7' -> 3
        ("I2", "O1", "P1", "0", "2.5"),       # quantity 0 -> dropped
        ("I3", "O1", "P1", "2", "-1"),        # negative price -> dropped
        ("I4", "O1", "P1", "1e30", "2.5"),    # int overflow -> NULL -> dropped
        ("I5", "O1", None, "1", "2.5"),       # NULL product -> dropped
        ("I6", "O1", "P1", "1", "NaN"),       # NaN passes > 0 (as in the reference)
        ("I7", "O2", "P1", "-2", "5"),        # invalid duplicate ...
        ("I7", "O1", "P9", "2", "5"),         # ... does not shadow the valid one
    ])
    out = {r.order_item_id: r for r in clean_order_items(df).collect()}
    assert set(out) == {"I1", "I6", "I7"}
    assert out["I1"].quantity == 3
    assert out["I6"].price_per_unit != out["I6"].price_per_unit  # NaN
    assert (out["I7"].order_id, out["I7"].product_id) == ("O1", "P9")


def test_clean_transactions_latest_per_order_by_day(spark):
    df = raw(spark, "transactions", [
        ("T1", "O1", "2020-01-01 23:59:00", "5.0", " Failed"),
        ("T2", "O1", "2020-01-02 00:01:00", "6.0", "SUCCESS "),
        ("T0", "O2", "2020-01-05 23:00:00", "1.0", "success"),   # same day as T9: the time is ignored,
        ("T9", "O2", "2020-01-05 01:00:00", "2.0", "failed"),    # tie broken by transaction_id
        ("T5", "O3", None, "1.0", "success"),                    # NULL date loses to any date
        ("T6", "O3", "2019-01-01", "1.0", "refunded"),           # status is not whitelisted
        (None, "O4", "2020-01-01", "1.0", "success"),            # NULL id -> dropped
    ])
    out = {r.order_id: r for r in clean_transactions(df).collect()}
    assert set(out) == {"O1", "O2", "O3"}
    assert (out["O1"].transaction_id, out["O1"].transaction_status) == ("T2", "success")
    assert out["O2"].transaction_id == "T0"
    assert (out["O3"].transaction_id, out["O3"].transaction_status) == ("T6", "refunded")


EXPECTED_CLEAN_SF0001 = {  # FIXTURES.md section 4
    "customers": 148, "products": 198, "orders": 1483, "order_items": 4493, "transactions": 1470,
}


@pytest.mark.parametrize("table", list(EXPECTED_CLEAN_SF0001))
def test_clean_counts_match_fixtures(spark, table):
    df = cleaned(spark, SF_SMALL, table)[table]
    assert df.count() == EXPECTED_CLEAN_SF0001[table]
    assert shape(df.schema) == shape(CLEAN[table])
    key = {"customers": "customer_id", "products": "product_id", "orders": "order_id",
           "order_items": "order_item_id", "transactions": "order_id"}[table]
    assert df.select(key).distinct().count() == df.count()


def test_raw_fixture_counts(spark):
    from tillroll.sources import testdata

    raw_counts = {t: df.count() for t, df in testdata.raw_tables(spark, SF_SMALL).items()}
    assert raw_counts == {"customers": 154, "products": 204, "orders": 1515, "order_items": 6000,
                          "transactions": 6000}


def test_parsed_types_from_typed_input(spark):
    """Cleaners accept typed columns too (the parquet adapter's timestamps/ints)."""
    df = spark.createDataFrame(
        [("I1", "O1", "P1", 2, 3.5)], "order_item_id string, order_id string, product_id string, "
                                      "quantity int, price_per_unit double")
    r = clean_order_items(df).first()
    assert (r.quantity, r.price_per_unit) == (2, 3.5)
    ts = spark.createDataFrame([("T1", "O1", dt.datetime(2020, 1, 1, 23, 0), 1.0, "success")],
                               "transaction_id string, order_id string, transaction_date timestamp_ntz, "
                               "transaction_amount double, transaction_status string")
    assert clean_transactions(ts).first().transaction_date == d("2020-01-01")


def test_fixture_null_paths_at_sf0001(spark):
    """FIXTURES.md section 4: what the mapping exercises, at sf0.001."""
    from pyspark.sql import functions as F

    from tillroll.sources import testdata

    raw = testdata.raw_tables(spark, SF_SMALL)
    c = cleaned(spark, SF_SMALL, "customers", "products", "orders", "order_items", "transactions")
    o, i, t = c["orders"], c["order_items"], c["transactions"]
    assert raw["orders"].filter(F.col("total_amount") == 0).count() == 8
    assert raw["orders"].filter(F.col("order_date").isNull()).count() == 3
    assert raw["products"].filter(F.col("unit_price") == "n/a").count() == 2
    assert raw["transactions"].filter(F.col("transaction_date").isNull()).count() == 6
    dup = lambda df, k: df.groupBy(k).count().filter("count > 1").count()
    assert dup(raw["customers"].filter(F.col("customer_id").isNotNull()), "customer_id") == 4
    assert dup(raw["products"].filter(F.col("product_id").isNotNull()), "product_id") == 4
    assert dup(raw["transactions"].filter(F.col("transaction_id").isNotNull()), "order_id") == 1362
    assert o.join(c["customers"], "customer_id", "left_anti").count() == 65
    assert o.join(i, "order_id", "left_anti").count() == 34
    assert o.join(t, "order_id", "left_anti").count() == 30
    assert t.join(o, "order_id", "left_anti").count() == 17
    qualifying = raw["order_items"].filter(
        F.col("product_id").isNotNull() & (F.col("quantity") > 0) & (F.col("price_per_unit") > 0))
    assert qualifying.join(c["products"], "product_id", "left_anti").count() == 51  # before dedup
    assert i.join(c["products"], "product_id", "left_anti").count() == 33           # after dedup


def test_transaction_tie_in_both_input_orders(spark):
    a = ("T2", "O1", "2020-01-01 10:00:00", "1.0", "success")
    b = ("T1", "O1", "2020-01-01 09:00:00", "2.0", "failed")
    for rows in ([a, b], [b, a]):
        out = clean_transactions(raw(spark, "transactions", rows).repartition(2)).collect()
        assert [r.transaction_id for r in out] == ["T1"]
