"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the report definitions and the input mapping in FIXTURES.md,
not from the Spark plans: reports are spelled the direct way (left joins +
filters, COUNT DISTINCT, group by the attribute columns) while the Spark side
is restructured for scale, so a match checks the restructuring too.

The tables ``region nation customer part orders lineitem`` are the
pre-registered TPC-H-style views; everything else is a CTE.
"""

from __future__ import annotations

RUN_DATE_SQL = "DATE '2001-12-31'"  # run date 20011231 (FIXTURES.md)


def R2(x: str) -> str:
    """Cents rounding HALF_UP on the shortest decimal form of a double (the
    form Spark's round(double) works on), or on an exact decimal."""
    return f"CAST(round(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def MSUM(x: str) -> str:
    """Exact money sum: each value as DECIMAL(38,18) from its shortest form."""
    return f"sum(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)))"


def R2_MEAN(x: str) -> str:
    """HALF_UP cents of the exact mean of a money column, as double.  DuckDB
    divides decimals in double precision, so the exact sum's unscaled value
    (units of 1e-18) is divided in integers: round-half-up to cents."""
    u = f"CAST(replace(CAST({MSUM(x)} AS VARCHAR), '.', '') AS HUGEINT)"
    n = f"CAST(count({x}) AS HUGEINT)"
    unit = "CAST(10000000000000000 AS HUGEINT)"  # 1e16 units of 1e-18 per cent
    cents = f"sign({u}) * ((abs({u}) * 2 + {n} * {unit}) // (2 * {n} * {unit}))"
    return f"(CASE WHEN count({x}) = 0 THEN NULL ELSE CAST({cents} AS DOUBLE) / 100 END)"


# --- raw inputs: FIXTURES.md section 3, unchanged --------------------------------
RAW_CTES = """
raw_customers AS (
SELECT concat('C', CAST(c_custkey AS string)) AS customer_id,
       concat('  ', c_name, ' ') AS customer_name,
       CASE WHEN c_custkey % 53 = 52 THEN NULL ELSE concat(' ', c_name, '@Example.COM ') END AS email,
       CASE WHEN c_custkey % 61 = 60 THEN NULL
            ELSE CAST(DATE '1995-01-01' + CAST((c_custkey * 37) % 2000 AS int) AS timestamp) END AS signup_date,
       concat(' ', r_name) AS region,
       concat(c_mktsegment, ' ') AS customer_segment
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT concat('C', CAST(c_custkey AS string)), concat(c_name, ' (dup)'), concat(c_name, '@dup.example.com'),
       CAST(DATE '1996-01-01' AS timestamp), 'EUROPE', c_mktsegment
FROM customer WHERE c_custkey % 40 = 7
),
raw_products AS (
SELECT CASE WHEN p_partkey % 97 = 96 THEN NULL ELSE concat('P', CAST(p_partkey AS string)) END AS product_id,
       concat(' ', p_name) AS product_name, concat(p_type, ' ') AS category,
       concat(' ', p_name, ' ') AS sub_category, p_brand AS brand,
       CASE WHEN p_partkey % 89 = 88 THEN 'n/a'
            ELSE CAST(CAST(p_retailprice AS decimal(18,2)) AS string) END AS unit_price
FROM part
UNION ALL
SELECT concat('P', CAST(p_partkey AS string)), p_name, 'PROMO', p_name, p_brand, '1.00'
FROM part WHERE p_partkey % 50 = 7 AND p_partkey % 97 <> 96
),
raw_orders AS (
SELECT concat('O', CAST(o_orderkey AS string)) AS order_id,
       CASE WHEN o_orderkey % 503 = 502 THEN NULL WHEN o_orderkey % 29 = 28 THEN concat('X', CAST(o_custkey AS string))
            ELSE concat('C', CAST(o_custkey AS string)) END AS customer_id,
       CASE WHEN o_orderkey % 401 = 400 THEN NULL ELSE o_orderdate END AS order_date,
       CASE WHEN o_orderkey % 97 = 96 THEN 'pending'
            WHEN o_orderkey % 20 < 14 THEN ' Completed '
            WHEN o_orderkey % 20 < 18 THEN 'SHIPPED'
            WHEN o_orderkey % 20 = 18 THEN 'returned' ELSE 'cancelled' END AS order_status,
       CASE WHEN o_orderkey % 211 = 0 THEN CAST(0 AS double) ELSE o_totalprice END AS total_amount,
       CAST(o_orderkey % 5001 AS double) / 100 AS discount_amount,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'paypal'
            WHEN '3-MEDIUM' THEN 'cash' WHEN '4-NOT SPECIFIED' THEN 'bank_transfer' ELSE 'gift_card' END AS payment_method
FROM orders
UNION ALL
SELECT concat('O', CAST(o_orderkey AS string)), concat('C', CAST(o_custkey AS string)),
       CAST(DATE '1994-12-31' AS timestamp), CASE WHEN o_orderkey % 200 = 50 THEN 'pending' ELSE 'shipped' END,
       o_totalprice, CAST(0 AS double), 'cash'
FROM orders WHERE o_orderkey % 100 = 50
),
raw_order_items AS (
SELECT concat('I', CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string)) AS order_item_id,
       concat('O', CAST(l_orderkey AS string)) AS order_id,
       CASE WHEN l_partkey % 151 = 150 THEN NULL ELSE concat('P', CAST(l_partkey AS string)) END AS product_id,
       CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_quantity AS int) END AS quantity,
       CASE WHEN l_quantity = 1 AND l_linenumber = 7 THEN -l_extendedprice ELSE l_extendedprice END AS price_per_unit
FROM lineitem
),
raw_transactions AS (
SELECT CASE WHEN l_orderkey % 307 = 306 THEN NULL
            ELSE concat('T', CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string), '-',
                        CAST(l_partkey AS string), '-', CAST(l_suppkey AS string)) END AS transaction_id,
       concat('O', CAST(l_orderkey AS string)) AS order_id,
       CASE WHEN l_orderkey % 211 = 5 AND l_linenumber = 1 THEN NULL ELSE l_shipdate END AS transaction_date,
       l_extendedprice AS transaction_amount,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 20 = 0 THEN ' Failed' ELSE 'SUCCESS ' END AS transaction_status
FROM lineitem
)"""

# --- cleaned tables: the cleaning rules, with the fixed tie-break orders ----------
CLEAN_CTES = """
c_customers AS (
SELECT customer_id, customer_name, email, signup_date, region, customer_segment FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_name ASC NULLS LAST,
         email ASC NULLS LAST, signup_date ASC NULLS LAST, region ASC NULLS LAST,
         customer_segment ASC NULLS LAST) AS rn
  FROM (SELECT customer_id, trim(customer_name) AS customer_name, lower(trim(email)) AS email,
               TRY_CAST(signup_date AS DATE) AS signup_date, trim(region) AS region,
               trim(customer_segment) AS customer_segment
        FROM raw_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL) s
) d WHERE rn = 1
),
c_products AS (
SELECT product_id, product_name, category, sub_category, brand, unit_price FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name ASC NULLS LAST,
         category ASC NULLS LAST, sub_category ASC NULLS LAST, brand ASC NULLS LAST,
         unit_price ASC NULLS LAST) AS rn
  FROM (SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
               trim(sub_category) AS sub_category, trim(brand) AS brand,
               TRY_CAST(unit_price AS DOUBLE) AS unit_price
        FROM raw_products WHERE product_id IS NOT NULL) s
) d WHERE rn = 1
),
c_orders AS (
SELECT order_id, customer_id, order_date, order_status, total_amount, discount_amount, payment_method FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY customer_id ASC NULLS LAST,
         order_date ASC NULLS LAST, order_status ASC NULLS LAST, total_amount ASC NULLS LAST,
         discount_amount ASC NULLS LAST, payment_method ASC NULLS LAST) AS rn
  FROM (SELECT order_id, customer_id, TRY_CAST(order_date AS DATE) AS order_date,
               lower(trim(order_status)) AS order_status, TRY_CAST(total_amount AS DOUBLE) AS total_amount,
               TRY_CAST(discount_amount AS DOUBLE) AS discount_amount, payment_method
        FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL) s
  WHERE order_status IN ('completed', 'shipped', 'returned', 'cancelled')
) d WHERE rn = 1
),
c_items AS (
SELECT order_item_id, order_id, product_id, quantity, price_per_unit FROM (
  SELECT *, row_number() OVER (PARTITION BY order_item_id ORDER BY order_id ASC NULLS LAST,
         product_id ASC NULLS LAST, quantity ASC NULLS LAST, price_per_unit ASC NULLS LAST) AS rn
  FROM (SELECT order_item_id, order_id, product_id,
               TRY_CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS INTEGER) AS quantity,
               TRY_CAST(price_per_unit AS DOUBLE) AS price_per_unit
        FROM raw_order_items
        WHERE order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL) s
  WHERE quantity > 0 AND price_per_unit > 0
) d WHERE rn = 1
),
c_txns AS (
SELECT transaction_id, order_id, transaction_date, transaction_amount, transaction_status FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY transaction_date DESC NULLS LAST,
         transaction_id ASC NULLS LAST, transaction_amount ASC NULLS LAST,
         transaction_status ASC NULLS LAST) AS rn
  FROM (SELECT transaction_id, order_id, TRY_CAST(transaction_date AS DATE) AS transaction_date,
               TRY_CAST(transaction_amount AS DOUBLE) AS transaction_amount,
               lower(trim(transaction_status)) AS transaction_status
        FROM raw_transactions WHERE transaction_id IS NOT NULL AND order_id IS NOT NULL) s
) d WHERE rn = 1
)"""

# --- report building blocks ------------------------------------------------------
_ITEM_TOTALS = f"""
item_totals AS (
SELECT order_id, count(order_item_id) AS total_line_items, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       {R2(MSUM('quantity * price_per_unit'))} AS items_revenue
FROM c_items GROUP BY order_id
)"""

_TOP_CATEGORY = """
order_cat AS (
SELECT i.order_id, p.category, count(i.order_item_id) AS cat_count
FROM c_items i LEFT JOIN c_products p ON i.product_id = p.product_id
GROUP BY i.order_id, p.category
),
top_cat AS (
SELECT order_id, category AS top_category FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY cat_count DESC, category ASC NULLS LAST) AS rn
  FROM order_cat) r WHERE rn = 1
)"""

_ORDER_SUMMARY = f"""
order_summary AS (
SELECT o.order_id, o.customer_id, c.customer_name, c.email, c.region, c.customer_segment, c.signup_date,
       o.order_date, o.order_status, o.payment_method, o.total_amount, o.discount_amount,
       CASE WHEN o.total_amount > 0 THEN {R2('o.discount_amount / o.total_amount * 100')}
            ELSE CAST(0 AS DOUBLE) END AS discount_pct,
       {R2('o.total_amount - o.discount_amount')} AS net_amount,
       it.total_line_items, it.total_quantity, it.items_revenue, tc.top_category,
       t.transaction_id, t.transaction_status, t.transaction_date, t.transaction_amount,
       {RUN_DATE_SQL} AS ingestion_date
FROM c_orders o
LEFT JOIN c_customers c ON o.customer_id = c.customer_id
LEFT JOIN item_totals it ON o.order_id = it.order_id
LEFT JOIN top_cat tc ON o.order_id = tc.order_id
LEFT JOIN c_txns t ON o.order_id = t.order_id
)"""

_SALES_LINES = f"""
sales_lines AS (
SELECT i.order_item_id, i.order_id, o.customer_id, i.product_id, p.category, p.sub_category, c.region,
       o.order_date, CAST(year(o.order_date) AS INTEGER) AS year, CAST(month(o.order_date) AS INTEGER) AS month,
       i.quantity, i.price_per_unit, {R2('i.quantity * i.price_per_unit')} AS line_revenue
FROM c_items i
LEFT JOIN c_products p ON i.product_id = p.product_id
LEFT JOIN c_orders o ON i.order_id = o.order_id
LEFT JOIN c_customers c ON o.customer_id = c.customer_id
LEFT JOIN c_txns t ON i.order_id = t.order_id
WHERE o.order_status = 'completed' AND t.transaction_status = 'success'
)"""

_MONTHLY_SALES = f"""
monthly_sales AS (
SELECT year, month, region, category,
       count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       {R2(MSUM('line_revenue'))} AS gross_revenue, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
       {R2(R2(MSUM('line_revenue')) + ' / count(DISTINCT order_id)')} AS avg_order_value,
       {RUN_DATE_SQL} AS ingestion_date
FROM sales_lines GROUP BY year, month, region, category
)"""

_MONTHLY_KPIS = f"""
perf_base AS (
SELECT o.*, t.transaction_status,
       CAST(year(o.order_date) AS INTEGER) AS year, CAST(month(o.order_date) AS INTEGER) AS month
FROM c_orders o LEFT JOIN c_txns t ON o.order_id = t.order_id
),
perf_agg AS (
SELECT year, month, count(order_id) AS total_orders,
       count(*) FILTER (WHERE order_status = 'completed') AS completed_orders,
       count(*) FILTER (WHERE order_status = 'shipped') AS shipped_orders,
       count(*) FILTER (WHERE order_status = 'returned') AS returned_orders,
       count(*) FILTER (WHERE order_status = 'cancelled') AS cancelled_orders,
       count(DISTINCT customer_id) AS unique_customers,
       {R2(MSUM('total_amount'))} AS total_revenue, {R2(MSUM('discount_amount'))} AS total_discounts,
       count(*) FILTER (WHERE transaction_status = 'success') AS successful_transactions
FROM perf_base GROUP BY year, month
),
monthly_kpis AS (
SELECT year, month, total_orders, completed_orders, shipped_orders, returned_orders, cancelled_orders,
       unique_customers, total_revenue, {R2('total_revenue / total_orders')} AS avg_order_value,
       total_discounts,
       {R2('completed_orders / total_orders * 100')} AS completion_rate_pct,
       {R2('returned_orders / total_orders * 100')} AS return_rate_pct,
       {R2('cancelled_orders / total_orders * 100')} AS cancellation_rate_pct,
       successful_transactions,
       {R2('successful_transactions / total_orders * 100')} AS transaction_success_rate_pct
FROM perf_agg
)"""

_MONTHLY_PERFORMANCE = f"""
perf_lag AS (
SELECT *, lag(total_revenue) OVER w AS prev_revenue, lag(total_orders) OVER w AS prev_orders
FROM monthly_kpis WINDOW w AS (ORDER BY year ASC NULLS FIRST, month ASC NULLS FIRST)
),
monthly_performance AS (
SELECT year, month, total_orders, completed_orders, shipped_orders, returned_orders, cancelled_orders,
       unique_customers, total_revenue, avg_order_value, total_discounts, completion_rate_pct,
       return_rate_pct, cancellation_rate_pct, successful_transactions, transaction_success_rate_pct,
       CASE WHEN prev_revenue IS NOT NULL AND prev_revenue > 0
            THEN {R2('(total_revenue - prev_revenue) / prev_revenue * 100')} END AS revenue_mom_growth_pct,
       CASE WHEN prev_orders IS NOT NULL AND prev_orders > 0
            THEN {R2('(total_orders - prev_orders) / prev_orders * 100')} END AS orders_mom_growth_pct,
       {RUN_DATE_SQL} AS ingestion_date
FROM perf_lag
)"""

_CUSTOMER_ORDER_METRICS = f"""
customer_order_metrics AS (
SELECT o.customer_id, c.customer_name, c.email, c.region, c.customer_segment, c.signup_date,
       count(o.order_id) AS total_orders,
       count(DISTINCT CASE WHEN o.order_status = 'completed' THEN o.order_id END) AS completed_orders,
       {R2(MSUM('o.total_amount'))} AS total_spent, {R2_MEAN('o.total_amount')} AS avg_order_value,
       {R2(MSUM('o.discount_amount'))} AS total_discounts_received,
       min(o.order_date) AS first_purchase_date, max(o.order_date) AS last_purchase_date,
       CAST({RUN_DATE_SQL} - max(o.order_date) AS INTEGER) AS days_since_last_purchase,
       CAST(max(o.order_date) - c.signup_date AS INTEGER) AS customer_tenure_days
FROM c_orders o LEFT JOIN c_customers c ON o.customer_id = c.customer_id
GROUP BY o.customer_id, c.customer_name, c.email, c.region, c.customer_segment, c.signup_date
)"""

_FAVORITE_CATEGORY = """
cust_cat AS (
SELECT o.customer_id, p.category, count(i.order_item_id) AS item_count
FROM c_items i
LEFT JOIN c_products p ON i.product_id = p.product_id
JOIN c_orders o ON i.order_id = o.order_id
GROUP BY o.customer_id, p.category
),
favorite_category AS (
SELECT customer_id, category AS favorite_category FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY item_count DESC, category ASC NULLS LAST) AS rn
  FROM cust_cat) r WHERE rn = 1
)"""

_LAST_ORDER = """
last_order AS (
SELECT customer_id, order_status AS last_order_status, payment_method AS last_payment_method FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS LAST, order_id ASC) AS rn
  FROM c_orders) r WHERE rn = 1
)"""

_CUSTOMER_PROFILE = f"""
customer_profile_summary AS (
SELECT m.customer_id, m.customer_name, m.email, m.region, m.customer_segment, m.signup_date,
       m.total_orders, m.completed_orders, m.total_spent, m.avg_order_value, m.total_discounts_received,
       m.first_purchase_date, m.last_purchase_date, m.days_since_last_purchase, m.customer_tenure_days,
       f.favorite_category, l.last_order_status, l.last_payment_method, {RUN_DATE_SQL} AS ingestion_date
FROM customer_order_metrics m
LEFT JOIN favorite_category f ON m.customer_id = f.customer_id
LEFT JOIN last_order l ON m.customer_id = l.customer_id
)"""

_TXN_ENRICHED = """
txn_enriched AS (
SELECT t.*, o.customer_id, o.payment_method, c.customer_name, c.email, c.region, c.customer_segment
FROM c_txns t
LEFT JOIN c_orders o ON t.order_id = o.order_id
LEFT JOIN c_customers c ON o.customer_id = c.customer_id
)"""

_CUSTOMER_TXN_METRICS = f"""
customer_txn_metrics AS (
SELECT customer_id, customer_name, email, region, customer_segment,
       count(transaction_id) AS total_transactions,
       count(*) FILTER (WHERE transaction_status = 'success') AS successful_transactions,
       count(*) FILTER (WHERE transaction_status = 'failed') AS failed_transactions,
       {R2("count(*) FILTER (WHERE transaction_status = 'success') / count(transaction_id) * 100")}
           AS transaction_success_rate_pct,
       {R2(MSUM('transaction_amount'))} AS total_transaction_value,
       {R2_MEAN('transaction_amount')} AS avg_transaction_value,
       {R2('max(transaction_amount)')} AS max_transaction_value,
       {R2('min(transaction_amount)')} AS min_transaction_value,
       min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
FROM txn_enriched GROUP BY customer_id, customer_name, email, region, customer_segment
)"""

_PREFERRED_PAYMENT = """
pay_counts AS (
SELECT customer_id, payment_method, count(transaction_id) AS pay_count
FROM txn_enriched GROUP BY customer_id, payment_method
),
preferred_payment AS (
SELECT customer_id, payment_method AS preferred_payment_method FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY pay_count DESC, payment_method ASC NULLS LAST) AS rn
  FROM pay_counts) r WHERE rn = 1 AND customer_id IS NOT NULL
)"""

_CUSTOMER_TRANSACTIONS = f"""
customer_transactions AS (
SELECT m.customer_id, m.customer_name, m.email, m.region, m.customer_segment, m.total_transactions,
       m.successful_transactions, m.failed_transactions, m.transaction_success_rate_pct,
       m.total_transaction_value, m.avg_transaction_value, m.max_transaction_value, m.min_transaction_value,
       m.first_transaction_date, m.last_transaction_date, p.preferred_payment_method,
       {RUN_DATE_SQL} AS ingestion_date
FROM customer_txn_metrics m LEFT JOIN preferred_payment p ON m.customer_id = p.customer_id
)"""

_COHORTS = """
cohort_sizes AS (
SELECT CAST(year(signup_date) AS INTEGER) AS cohort_year, CAST(month(signup_date) AS INTEGER) AS cohort_month,
       count(customer_id) AS cohort_size
FROM c_customers GROUP BY 1, 2
),
cohort_join AS (
SELECT o.customer_id,
       CAST(year(c.signup_date) AS INTEGER) AS cohort_year, CAST(month(c.signup_date) AS INTEGER) AS cohort_month,
       CAST(year(o.order_date) AS INTEGER) AS activity_year, CAST(month(o.order_date) AS INTEGER) AS activity_month
FROM c_orders o JOIN c_customers c ON o.customer_id = c.customer_id
),
cohort_activity AS (
SELECT cohort_year, cohort_month, activity_year, activity_month,
       CAST((activity_year - cohort_year) * 12 + (activity_month - cohort_month) AS INTEGER) AS periods_since_cohort,
       count(DISTINCT customer_id) AS active_customers
FROM cohort_join
WHERE (activity_year - cohort_year) * 12 + (activity_month - cohort_month) >= 0
GROUP BY 1, 2, 3, 4, 5
)"""

_RETENTION = f"""
customer_retention AS (
SELECT a.cohort_year, a.cohort_month, a.activity_year, a.activity_month, a.periods_since_cohort,
       s.cohort_size, a.active_customers,
       {R2('a.active_customers / s.cohort_size * 100')} AS retention_rate_pct,
       {RUN_DATE_SQL} AS ingestion_date
FROM cohort_activity a LEFT JOIN cohort_sizes s
  ON a.cohort_year = s.cohort_year AND a.cohort_month = s.cohort_month
)"""


def _q(blocks: list[str], final: str) -> str:
    ctes = ",".join([RAW_CTES, CLEAN_CTES, *blocks])
    return f"WITH {ctes}\n{final}"


_SALES = [_SALES_LINES, _MONTHLY_SALES]
_PERF = [_MONTHLY_KPIS, _MONTHLY_PERFORMANCE]
_PROFILE = [_CUSTOMER_ORDER_METRICS, _FAVORITE_CATEGORY, _LAST_ORDER, _CUSTOMER_PROFILE]
_TXN = [_TXN_ENRICHED, _CUSTOMER_TXN_METRICS, _PREFERRED_PAYMENT, _CUSTOMER_TRANSACTIONS]
_SUMMARY = [_ITEM_TOTALS, _TOP_CATEGORY, _ORDER_SUMMARY]



def _position(report: str, order: str) -> str:
    by = ", ".join(f"{c} ASC NULLS FIRST" for c in order.split())
    return f"SELECT *, row_number() OVER (ORDER BY {by}) AS position FROM {report}"


# Rows read by each cleaner, with the rule that drops them (in the cleaners' order) and the key.
_LOSSES = """
judged AS (
SELECT 'customers' AS table_name, customer_id AS key,
       CASE WHEN customer_id IS NULL OR email IS NULL THEN 'null_key' END AS reason FROM raw_customers
UNION ALL SELECT 'products', product_id, CASE WHEN product_id IS NULL THEN 'null_key' END FROM raw_products
UNION ALL SELECT 'orders', order_id, CASE WHEN order_id IS NULL OR customer_id IS NULL THEN 'null_key'
       WHEN coalesce(lower(trim(order_status)), '') NOT IN ('completed', 'shipped', 'returned', 'cancelled') THEN 'bad_status' END
FROM raw_orders
UNION ALL SELECT 'order_items', order_item_id,
       CASE WHEN order_item_id IS NULL OR order_id IS NULL OR product_id IS NULL THEN 'null_key'
            WHEN (quantity IS NOT NULL AND TRY_CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS INTEGER) IS NULL)
              OR (price_per_unit IS NOT NULL AND TRY_CAST(price_per_unit AS DOUBLE) IS NULL) THEN 'unparseable'
            WHEN coalesce(quantity, 0) <= 0 OR coalesce(price_per_unit, 0) <= 0 THEN 'out_of_range' END
FROM raw_order_items
UNION ALL SELECT 'transactions', order_id, CASE WHEN transaction_id IS NULL OR order_id IS NULL THEN 'null_key' END
FROM raw_transactions
),
losses AS (
SELECT table_name, reason, count(*) AS n_rows FROM judged WHERE reason IS NOT NULL GROUP BY 1, 2
UNION ALL SELECT table_name, 'kept', count(DISTINCT key) FROM judged WHERE reason IS NULL GROUP BY 1
UNION ALL SELECT table_name, 'duplicate', count(*) - count(DISTINCT key) FROM judged WHERE reason IS NULL GROUP BY 1
HAVING count(*) > count(DISTINCT key)
)"""

_REJECTS = """
numbered AS (SELECT *, CAST(substr(product_id, 2) AS BIGINT) AS k FROM raw_products),
lines AS (
SELECT product_id, k % 13 = 5 AS is_short, k % 17 = 3 AS is_long,
       concat(coalesce(product_id, ''), ',', coalesce(product_name, ''), ',', coalesce(category, '')) AS head,
       concat(',', coalesce(sub_category, ''), ',', coalesce(brand, ''), ',', coalesce(unit_price, '')) AS tail FROM numbered
),
rejects AS (
SELECT 'rejected' AS kind, CASE WHEN is_short THEN head ELSE concat(head, tail, ',extra') END AS record
FROM lines WHERE is_short OR is_long
UNION ALL SELECT DISTINCT 'kept', product_id FROM lines
WHERE product_id IS NOT NULL AND NOT coalesce(is_short, false) AND NOT coalesce(is_long, false)
)"""

_RUN = """
SELECT 'order_summary' AS report, 'succeeded' AS status, count(*) AS n_rows FROM order_summary
UNION ALL SELECT 'monthly_performance', 'succeeded', count(*) FROM monthly_performance
UNION ALL SELECT 'customer_transactions', 'succeeded', count(*) FROM customer_transactions
UNION ALL SELECT 'customer_retention', 'failed', 0"""


ORACLE_SQL: dict[str, str] = {
    "clean_customers": _q([], "SELECT * FROM c_customers"),
    "clean_products": _q([], "SELECT * FROM c_products"),
    "clean_orders": _q([], "SELECT * FROM c_orders"),
    "clean_order_items": _q([], "SELECT * FROM c_items"),
    "clean_transactions": _q([], "SELECT * FROM c_txns"),
    "order_item_totals": _q([_ITEM_TOTALS], "SELECT * FROM item_totals"),
    "top_category_per_order": _q([_TOP_CATEGORY], "SELECT * FROM top_cat"),
    "order_summary": _q(_SUMMARY, "SELECT * FROM order_summary"),
    "sales_lines": _q([_SALES_LINES], "SELECT * FROM sales_lines"),
    "monthly_sales": _q(_SALES, "SELECT * FROM monthly_sales"),
    "monthly_kpis": _q([_MONTHLY_KPIS], "SELECT * FROM monthly_kpis"),
    "monthly_performance": _q(_PERF, "SELECT * FROM monthly_performance"),
    "customer_order_metrics": _q([_CUSTOMER_ORDER_METRICS], "SELECT * FROM customer_order_metrics"),
    "favorite_category": _q([_FAVORITE_CATEGORY], "SELECT * FROM favorite_category"),
    "last_order": _q([_LAST_ORDER], "SELECT * FROM last_order"),
    "customer_profile_summary": _q(_PROFILE, "SELECT * FROM customer_profile_summary"),
    "customer_txn_metrics": _q([_TXN_ENRICHED, _CUSTOMER_TXN_METRICS], "SELECT * FROM customer_txn_metrics"),
    "preferred_payment": _q([_TXN_ENRICHED, _PREFERRED_PAYMENT], "SELECT * FROM preferred_payment"),
    "customer_transactions": _q(_TXN, "SELECT * FROM customer_transactions"),
    "cohort_sizes": _q([_COHORTS], "SELECT * FROM cohort_sizes"),
    "cohort_activity": _q([_COHORTS], "SELECT * FROM cohort_activity"),
    "customer_retention": _q([_COHORTS, _RETENTION], "SELECT * FROM customer_retention"),
    # I/O paths: same results as the in-memory reports they wrap.
    "csv_roundtrip": _q(_SUMMARY, "SELECT * FROM order_summary"),
    "csv_roundtrip_inferred": _q(_SUMMARY, "SELECT * FROM order_summary"),
    "order_summary_shared": _q(_SUMMARY, "SELECT * FROM order_summary"),
    "monthly_sales_shared": _q(_SALES, "SELECT * FROM monthly_sales"),
    "customer_profile_shared": _q(_PROFILE, "SELECT * FROM customer_profile_summary"),
    "sink_append": _q(_PERF, "SELECT * FROM monthly_performance UNION ALL SELECT * FROM monthly_performance"),
    "sink_partition_overwrite": _q(_PERF, "SELECT * FROM monthly_performance"),
    "monthly_sales_ordered": _q(_SALES, _position("monthly_sales", "year month region category")),
    "monthly_performance_ordered": _q(_PERF, _position("monthly_performance", "year month")),
    "customer_retention_ordered": _q([_COHORTS, _RETENTION], _position("customer_retention", "cohort_year cohort_month periods_since_cohort")),
    "cleaning_losses": _q([_LOSSES], "SELECT * FROM losses"),
    "csv_rejects": _q([_REJECTS], "SELECT * FROM rejects"),
    "sink_report_as_of": _q(_PERF, "SELECT * REPLACE (DATE '2002-01-01' AS ingestion_date) FROM monthly_performance"),
    "sink_report_latest": _q(_PERF, "SELECT * REPLACE (DATE '2002-03-01' AS ingestion_date) FROM monthly_performance"),
    "sink_run_results": _q([*_SUMMARY, *_PERF, *_TXN], _RUN),
}
