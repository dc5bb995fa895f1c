"""The six reports on one small hand-built world.  Every expected value is
worked out by hand in the comments; each test names the rules it covers."""

import datetime as dt

import pytest

from conftest import shape, d, make, rows_by
from tillroll.plans import REPORTS
from tillroll.plans import customer_profile as r4
from tillroll.plans import customer_retention as r6
from tillroll.plans import customer_transactions as r5
from tillroll.plans import monthly_performance as r3
from tillroll.plans import monthly_sales as r2
from tillroll.plans import order_summary as r1
from tillroll.schemas import REPORT

DATE = "20240101"


@pytest.fixture(scope="module")
def world(spark):
    customers = make(spark, "customers", [
        ("C1", "Ann", "ann@x.io", d("2020-01-15"), "EUROPE", "VIP"),
        ("C2", "Bob", "bob@x.io", d("2020-02-10"), "ASIA", "Regular"),
        ("C3", "Cid", "cid@x.io", None, "ASIA", "Regular"),           # NULL signup
        ("C4", "Dee", "dee@x.io", d("2020-01-20"), "EUROPE", "VIP"),  # never orders
    ])
    products = make(spark, "products", [
        ("P1", "p1", "A", "a1", "b", 1.0),
        ("P2", "p2", "B", "b1", "b", 1.0),
        ("P3", "p3", "A", "a2", "b", 1.0),
    ])
    orders = make(spark, "orders", [
        ("O1", "C1", d("2020-01-20"), "completed", 100.0, 10.0, "card"),
        ("O2", "C1", d("2020-03-05"), "cancelled", 50.0, 0.0, "cash"),
        ("O3", "C2", d("2020-01-25"), "completed", 0.0, 0.0, "card"),     # zero total
        ("O4", "C9", d("2020-05-01"), "shipped", 80.0, 8.0, "paypal"),    # customer unknown
        ("O5", "C2", d("2020-03-06"), "returned", -5.0, 1.0, "cash"),     # negative total
        ("O6", "C3", None, "completed", None, 1.0, "card"),               # NULL date and total
        ("O7", "C1", d("2019-12-01"), "completed", 20.0, 0.0, "card"),    # before signup month
    ])
    items = make(spark, "order_items", [
        ("I1", "O1", "P1", 2, 10.005),   # line 20.01
        ("I2", "O1", "P2", 1, 5.0),
        ("I3", "O1", "P3", 1, 1.0),      # O1: A has 2 lines, B 1 -> top A
        ("I4", "O3", "PX", 1, 3.0),      # unknown product -> NULL category
        ("I5", "O9", "P1", 1, 1.0),      # order was dropped
        ("I6", "O4", "P2", 2, 4.0),
        ("I7", "O7", "P1", 1, 2.0),
    ])
    txns = make(spark, "transactions", [
        ("T1", "O1", d("2020-01-21"), 100.0, "success"),
        ("T2", "O2", d("2020-03-06"), 50.0, "success"),
        ("T3", "O3", d("2020-01-26"), 0.5, "failed"),
        ("T4", "O4", d("2020-02-02"), 80.0, "success"),
        ("T7", "O7", d("2019-12-02"), 20.0, "success"),
        ("T8", "O8", d("2020-02-02"), 7.0, "success"),    # order dropped -> NULL customer
        ("T9", "O9", d("2020-02-03"), 3.0, "refunded"),   # ... and a status that is neither
    ])
    return dict(customers=customers, products=products, orders=orders, order_items=items, transactions=txns)


def run(name, world):
    rep = REPORTS[name]
    df = rep.transform(**{t: world[t] for t in rep.inputs}, date=DATE)
    assert shape(df.schema) == shape(REPORT[name]), name
    return df


def test_order_summary(world):
    """N1 no items -> NULL totals; N2 unknown customer kept with NULL
    attributes; N3 unknown product is a NULL category that can win; N16
    discount_pct 0 for zero/negative/NULL totals; line revenue rounding."""
    out = rows_by(run("order_summary", world), "order_id")
    assert len(out) == 7
    o1 = out["O1"]
    assert (o1["customer_name"], o1["region"], o1["signup_date"]) == ("Ann", "EUROPE", d("2020-01-15"))
    assert (o1["total_line_items"], o1["total_quantity"], o1["items_revenue"], o1["top_category"]) == (3, 4, 26.01, "A")
    assert (o1["discount_pct"], o1["net_amount"]) == (10.0, 90.0)
    assert (o1["transaction_id"], o1["transaction_status"], o1["transaction_amount"]) == ("T1", "success", 100.0)
    assert o1["ingestion_date"] == d("2024-01-01")
    assert out["O2"]["total_line_items"] is None and out["O2"]["top_category"] is None       # N1
    assert out["O4"]["customer_name"] is None and out["O4"]["customer_id"] == "C9"          # N2
    assert out["O4"]["top_category"] == "B"
    assert (out["O3"]["top_category"], out["O3"]["total_line_items"]) == (None, 1)          # N3
    assert out["O3"]["discount_pct"] == 0.0                                                 # N16 zero
    assert (out["O5"]["discount_pct"], out["O5"]["net_amount"]) == (0.0, -6.0)              # N16 negative
    assert (out["O6"]["discount_pct"], out["O6"]["net_amount"]) == (0.0, None)              # N16 NULL
    assert out["O6"]["transaction_id"] is None


def test_top_category_tie_breaks_to_smallest_then_null_last(spark):
    prods = make(spark, "products", [("P1", "x", "B", "s", "b", 1.0), ("P2", "x", "A", "s", "b", 1.0)])
    for rows in ([("I1", "O1", "P1", 1, 1.0), ("I2", "O1", "P2", 1, 1.0), ("I3", "O1", "PX", 1, 1.0)],
                 [("I3", "O1", "PX", 1, 1.0), ("I2", "O1", "P2", 1, 1.0), ("I1", "O1", "P1", 1, 1.0)]):
        items = make(spark, "order_items", rows)
        assert r1.order_item_summary(items, prods).first().top_category == "A"
        assert r1.top_category_per_order(items, prods).first().top_category == "A"
    only_null = make(spark, "order_items", [("I1", "O1", "PX", 1, 1.0), ("I2", "O1", "PY", 1, 1.0),
                                            ("I3", "O1", "P1", 1, 1.0)])
    assert r1.order_item_summary(only_null, prods).first().top_category is None  # 2 NULL lines beat 1 B


def test_monthly_sales(world):
    """N4 completed + success only, orders without items vanish; N5 lines
    rounded before summing, AOV per group, an order counts in each of its
    categories; J7/J9 effectively inner."""
    out = {(r.year, r.month, r.region, r.category): r for r in run("monthly_sales", world).collect()}
    assert set(out) == {(2020, 1, "EUROPE", "A"), (2020, 1, "EUROPE", "B"), (2019, 12, "EUROPE", "A")}
    a = out[(2020, 1, "EUROPE", "A")]
    assert (a.total_orders, a.unique_customers, a.gross_revenue, a.total_units_sold, a.avg_order_value) == \
        (1, 1, 21.01, 3, 21.01)
    b = out[(2020, 1, "EUROPE", "B")]
    assert (b.total_orders, b.gross_revenue, b.total_units_sold) == (1, 5.0, 1)
    assert out[(2019, 12, "EUROPE", "A")].gross_revenue == 2.0


def test_sales_lines(world):
    lines = {r.order_item_id: r for r in r2.sales_lines(world["orders"], world["customers"],
                                                        world["order_items"], world["products"],
                                                        world["transactions"]).collect()}
    assert set(lines) == {"I1", "I2", "I3", "I7"}
    assert lines["I1"].line_revenue == 20.01 and lines["I1"].region == "EUROPE"


def test_monthly_performance(world):
    """N6 all statuses in revenue and rates; N7 AOV on rounded revenue; N8
    growth against the previous existing month (gap not filled, NULL month
    first with NULL growth)."""
    rows = sorted(run("monthly_performance", world).collect(),
                  key=lambda r: (r.year is not None, r.year or 0, r.month or 0))
    keys = [(r.year, r.month) for r in rows]
    assert keys == [(None, None), (2019, 12), (2020, 1), (2020, 3), (2020, 5)]
    m = {k: r for k, r in zip(keys, rows)}
    nul = m[(None, None)]
    assert (nul.total_orders, nul.total_revenue, nul.revenue_mom_growth_pct, nul.orders_mom_growth_pct) == \
        (1, None, None, None)
    dec = m[(2019, 12)]
    assert (dec.revenue_mom_growth_pct, dec.orders_mom_growth_pct) == (None, 0.0)  # prev revenue NULL
    jan = m[(2020, 1)]
    assert (jan.total_orders, jan.completed_orders, jan.unique_customers, jan.total_revenue) == (2, 2, 2, 100.0)
    assert (jan.avg_order_value, jan.total_discounts, jan.completion_rate_pct) == (50.0, 10.0, 100.0)
    assert (jan.successful_transactions, jan.transaction_success_rate_pct) == (1, 50.0)
    assert (jan.revenue_mom_growth_pct, jan.orders_mom_growth_pct) == (400.0, 100.0)
    mar = m[(2020, 3)]  # February has no row: compared with January
    assert (mar.total_revenue, mar.returned_orders, mar.cancelled_orders) == (45.0, 1, 1)
    assert (mar.return_rate_pct, mar.cancellation_rate_pct) == (50.0, 50.0)
    assert (mar.revenue_mom_growth_pct, mar.orders_mom_growth_pct) == (-55.0, 0.0)
    may = m[(2020, 5)]
    assert (may.shipped_orders, may.revenue_mom_growth_pct, may.orders_mom_growth_pct) == (1, 77.78, -50.0)
    for r in rows:
        assert r.completed_orders + r.shipped_orders + r.returned_orders + r.cancelled_orders == r.total_orders


def test_customer_profile_summary(world):
    """N9 spend includes cancelled/returned, customers without orders absent,
    tenure may be negative; N10 favourite over all valid orders; N11 recency
    against the run date; N3 NULL category wins; W4 latest order."""
    out = rows_by(run("customer_profile_summary", world), "customer_id")
    assert set(out) == {"C1", "C2", "C3", "C9"}                                 # C4 has no order
    c1 = out["C1"]
    assert (c1["total_orders"], c1["completed_orders"], c1["total_spent"], c1["avg_order_value"]) == (3, 2, 170.0, 56.67)
    assert (c1["total_discounts_received"], c1["first_purchase_date"], c1["last_purchase_date"]) == \
        (10.0, d("2019-12-01"), d("2020-03-05"))
    assert c1["days_since_last_purchase"] == (dt.date(2024, 1, 1) - dt.date(2020, 3, 5)).days
    assert c1["customer_tenure_days"] == (dt.date(2020, 3, 5) - dt.date(2020, 1, 15)).days
    assert (c1["favorite_category"], c1["last_order_status"], c1["last_payment_method"]) == ("A", "cancelled", "cash")
    c2 = out["C2"]
    assert (c2["total_spent"], c2["favorite_category"], c2["last_order_status"]) == (-5.0, None, "returned")
    assert c2["customer_tenure_days"] == (dt.date(2020, 3, 6) - dt.date(2020, 2, 10)).days
    c3 = out["C3"]
    assert (c3["total_spent"], c3["avg_order_value"], c3["last_purchase_date"], c3["days_since_last_purchase"]) == \
        (None, None, None, None)
    assert (c3["last_order_status"], c3["last_payment_method"]) == ("completed", "card")
    c9 = out["C9"]
    assert (c9["customer_name"], c9["customer_tenure_days"], c9["favorite_category"]) == (None, None, "B")


def test_last_order_tie_breaks(spark):
    for rows in ([("O2", "C1", d("2020-01-01"), "shipped", 1.0, 0.0, "cash"),
                  ("O1", "C1", d("2020-01-01"), "completed", 1.0, 0.0, "card"),
                  ("O0", "C1", None, "returned", 1.0, 0.0, "gift")],):
        for ordered in (rows, rows[::-1]):
            r = r4.last_order(make(spark, "orders", ordered)).first()
            assert (r.last_order_status, r.last_payment_method) == ("completed", "card")


def test_customer_transactions(world):
    """N12 dropped orders -> one all-NULL customer with NULL preferred
    method; N13 success + failed need not equal total; W5 preferred."""
    rows = run("customer_transactions", world).collect()
    assert len(rows) == 4
    out = {r.customer_id: r for r in rows}
    c1 = out["C1"]
    assert (c1.total_transactions, c1.successful_transactions, c1.failed_transactions) == (3, 3, 0)
    assert (c1.transaction_success_rate_pct, c1.total_transaction_value, c1.avg_transaction_value) == (100.0, 170.0, 56.67)
    assert (c1.max_transaction_value, c1.min_transaction_value) == (100.0, 20.0)
    assert (c1.first_transaction_date, c1.last_transaction_date) == (d("2019-12-02"), d("2020-03-06"))
    assert c1.preferred_payment_method == "card"
    assert (out["C2"].failed_transactions, out["C2"].transaction_success_rate_pct) == (1, 0.0)
    assert (out["C9"].customer_name, out["C9"].preferred_payment_method) == (None, "paypal")
    n = out[None]
    assert (n.total_transactions, n.successful_transactions, n.failed_transactions) == (2, 1, 0)   # N13
    assert (n.transaction_success_rate_pct, n.preferred_payment_method, n.email) == (50.0, None, None)  # N12
    pp = {r.customer_id: r.preferred_payment_method
          for r in r5.preferred_payment(world["orders"], world["transactions"]).collect()}
    assert pp == {"C1": "card", "C2": "card", "C9": "paypal"}


def test_preferred_payment_tie_breaks(spark):
    orders = make(spark, "orders", [("O1", "C1", d("2020-01-01"), "completed", 1.0, 0.0, "paypal"),
                                    ("O2", "C1", d("2020-01-02"), "completed", 1.0, 0.0, "cash"),
                                    ("O3", "C1", d("2020-01-03"), "completed", 1.0, 0.0, None)])
    txns = make(spark, "transactions", [("T1", "O1", d("2020-01-01"), 1.0, "success"),
                                        ("T2", "O2", d("2020-01-02"), 1.0, "success"),
                                        ("T3", "O3", d("2020-01-03"), 1.0, "success")])
    r = r5.transform(orders, make(spark, "customers", []), txns, DATE).first()
    assert r.preferred_payment_method == "cash"


def test_customer_retention(world):
    """N14 any-status activity, pre-signup and NULL signup dropped, no rows
    for inactive months; N15 cohort size counts non-ordering customers; N2
    unknown customers dropped (inner join)."""
    rows = {(r.cohort_year, r.cohort_month, r.activity_year, r.activity_month): r
            for r in run("customer_retention", world).collect()}
    assert set(rows) == {(2020, 1, 2020, 1), (2020, 1, 2020, 3), (2020, 2, 2020, 3)}
    a = rows[(2020, 1, 2020, 1)]
    assert (a.periods_since_cohort, a.cohort_size, a.active_customers, a.retention_rate_pct) == (0, 2, 1, 50.0)
    assert rows[(2020, 1, 2020, 3)].periods_since_cohort == 2
    b = rows[(2020, 2, 2020, 3)]
    assert (b.periods_since_cohort, b.cohort_size, b.active_customers, b.retention_rate_pct) == (1, 1, 1, 100.0)
    sizes = {(r.cohort_year, r.cohort_month): r.cohort_size for r in r6.cohort_sizes(world["customers"]).collect()}
    assert sizes == {(2020, 1): 2, (2020, 2): 1, (None, None): 1}


def test_retention_counts_each_customer_once_per_month(spark):
    customers = make(spark, "customers", [("C1", "a", "e", d("2020-01-01"), "R", "S")])
    orders = make(spark, "orders", [(f"O{i}", "C1", d("2020-02-0%d" % (i + 1)), "completed", 1.0, 0.0, "x")
                                    for i in range(5)])
    r = r6.transform(orders, customers, DATE).first()
    assert (r.periods_since_cohort, r.active_customers, r.retention_rate_pct) == (1, 1, 100.0)


def test_monthly_kpis_unique_customers(spark):
    orders = make(spark, "orders", [("O1", "C1", d("2020-01-01"), "completed", 1.0, 0.0, "x"),
                                    ("O2", "C1", d("2020-01-02"), "shipped", 2.0, 0.0, "x"),
                                    ("O3", "C2", d("2020-01-03"), "shipped", 3.0, 0.0, "x")])
    r = r3.monthly_kpis(orders, make(spark, "transactions", [])).first()
    assert (r.total_orders, r.unique_customers, r.total_revenue, r.successful_transactions) == (3, 2, 6.0, 0)


def test_display_order_nulls_first(world):
    rep = REPORTS["monthly_performance"]
    rows = rep.ordered(run("monthly_performance", world)).collect()
    assert [(r.year, r.month) for r in rows] == [(None, None), (2019, 12), (2020, 1), (2020, 3), (2020, 5)]
    assert REPORTS["order_summary"].ordered(world["orders"]) is world["orders"]


def test_favorite_category_tie_breaks(spark):
    prods = make(spark, "products", [("P1", "x", "B", "s", "b", 1.0), ("P2", "x", "A", "s", "b", 1.0)])
    orders = make(spark, "orders", [("O1", "C1", d("2020-01-01"), "completed", 1.0, 0.0, "x"),
                                    ("O2", "C1", d("2020-01-02"), "completed", 1.0, 0.0, "x")])
    rows = [("I1", "O1", "P1", 1, 1.0), ("I2", "O2", "P2", 1, 1.0), ("I3", "O2", "PX", 1, 1.0)]
    for ordered in (rows, rows[::-1]):
        fav = r4.favorite_category(orders, make(spark, "order_items", ordered), prods).first()
        assert fav.favorite_category == "A"  # A, B and NULL tie at one line each


def test_tenure_can_be_negative(spark):
    """Tenure is last purchase minus signup, negative when every order
    predates the signup."""
    customers = make(spark, "customers", [("C1", "a", "e", d("2021-06-01"), "R", "S")])
    orders = make(spark, "orders", [("O1", "C1", d("2021-05-20"), "cancelled", 5.0, 0.0, "cash")])
    r = r4.customer_order_metrics(orders, customers, DATE).first()
    assert (r.customer_tenure_days, r.total_spent) == (-12, 5.0)
