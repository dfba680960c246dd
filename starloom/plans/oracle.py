"""DuckDB oracle text for every named query.

Each query is the same computation written as plain SQL over the driver's
tables (pre-registered views). Shared steps are named CTEs; ``sql()`` pulls
in the transitive dependencies of a final SELECT in dependency order.

Output conventions (so Spark and DuckDB results compare exactly): counts
are BIGINT, money is summed exactly in DECIMAL and exposed as DOUBLE,
calendar parts are INTEGER, timestamps are TIMESTAMP (NTZ in Spark).
"""

from __future__ import annotations

import re


CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


def _deps(text: str) -> list[str]:
    found = []
    for name in CTES:
        if re.search(rf"\b{re.escape(name)}\b", text):
            found.append(name)
    return found


def sql(final: str) -> str:
    order: list[str] = []

    def visit(name: str, stack: tuple[str, ...]) -> None:
        if name in order:
            return
        if name in stack:
            raise ValueError(f"cycle through {name}")
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, stack + (name,))
        order.append(name)

    for d in _deps(final):
        visit(d, ())
    if not order:
        return final.strip()
    withs = ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order)
    return f"WITH {withs}\n{final.strip()}"


# ------------------------------------------------------------------ adapters
cte("a_customers", """
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name, c_name || '@Example.COM' AS email,
       c_mktsegment AS city, n_name AS state, r_name AS country,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 400 AS INTEGER) AS DATE) AS signup_date,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 400 AS INTEGER) AS TIMESTAMP) AS updated_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
cte("a_products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
       CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.6 AS DECIMAL(2,1)) AS DECIMAL(10,2)) AS cost_price,
       'Supplier ' || CAST(p_partkey % 10 AS VARCHAR) AS supplier,
       TIMESTAMP '1995-01-01 00:00:00' AS updated_at
FROM part
""")
cte("a_orders", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
       CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PENDING' ELSE 'SHIPPED' END AS order_status,
       o_orderdate AS updated_at
FROM orders
""")
cte("a_order_items", """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
       l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(l_discount AS DECIMAL(4,2)) * 1000 AS DECIMAL(10,2)) AS discount,
       l_shipdate AS updated_at
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
cte("a_payments", """
SELECT o_orderkey AS payment_id, o_orderkey AS order_id, o_orderpriority AS payment_method,
       CASE WHEN o_orderkey % 6 < 3 THEN 'COMPLETED' WHEN o_orderkey % 6 = 3 THEN 'PENDING'
            WHEN o_orderkey % 6 = 4 THEN 'FAILED' ELSE 'REFUNDED' END AS payment_status,
       CAST(o_totalprice AS DECIMAL(10,2)) AS amount, o_orderdate AS payment_date
FROM orders
""")

# ------------------------------------------------------------------- staging
cte("s_customers", """
SELECT customer_id, first_name, last_name, email, city, state, country, signup_date, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
         first_name DESC, last_name DESC, email DESC, city DESC, state DESC, country DESC, signup_date DESC) AS rn
  FROM (SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
               lower(trim(email)) AS email, trim(city) AS city, trim(state) AS state,
               trim(country) AS country, signup_date, updated_at FROM a_customers) x) y
WHERE rn = 1
""")
cte("s_products", """
SELECT product_id, product_name, category, subcategory, unit_price, cost_price, supplier, updated_at,
       unit_price - cost_price AS profit_per_unit FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC NULLS LAST,
         product_name DESC, category DESC, subcategory DESC, unit_price DESC, cost_price DESC, supplier DESC) AS rn
  FROM (SELECT product_id, trim(product_name) AS product_name,
               upper(substr(trim(category), 1, 1)) || lower(substr(trim(category), 2)) AS category,
               upper(substr(trim(subcategory), 1, 1)) || lower(substr(trim(subcategory), 2)) AS subcategory,
               unit_price, cost_price, trim(supplier) AS supplier, updated_at FROM a_products) x) y
WHERE rn = 1
""")
cte("s_orders", """
SELECT order_id, customer_id, order_date, order_status, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS LAST,
         customer_id DESC, order_date DESC, order_status DESC) AS rn
  FROM (SELECT order_id, customer_id, order_date, lower(trim(order_status)) AS order_status, updated_at
        FROM a_orders) x) y
WHERE rn = 1
""")
cte("s_order_items", """
SELECT order_id, line_number, product_id, supplier_id, quantity, unit_price, discount, updated_at,
       quantity * unit_price - discount AS line_total FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, line_number, product_id, supplier_id
         ORDER BY updated_at DESC NULLS LAST, quantity DESC, unit_price DESC, discount DESC) AS rn
  FROM a_order_items) y
WHERE rn = 1
""")
cte("s_payments", """
SELECT payment_id, order_id, payment_method, payment_status, amount, payment_date FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY payment_date DESC NULLS LAST,
         order_id DESC, payment_method DESC, payment_status DESC, amount DESC) AS rn
  FROM (SELECT payment_id, order_id, lower(trim(payment_method)) AS payment_method,
               lower(trim(payment_status)) AS payment_status, amount, payment_date FROM a_payments) x) y
WHERE rn = 1
""")

# ---------------------------------------------------------------- dimensions
cte("d_customer", """
SELECT row_number() OVER (ORDER BY customer_id) - 1 AS customer_key, customer_id, first_name, last_name,
       email, city, state, country, signup_date, CAST(signup_date AS TIMESTAMP) AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM s_customers
""")
cte("d_product", """
SELECT row_number() OVER (ORDER BY product_id) - 1 AS product_key, product_id, product_name, category,
       subcategory, unit_price, cost_price, profit_per_unit, supplier
FROM s_products
""")
cte("d_payment", """
SELECT row_number() OVER (ORDER BY payment_id) - 1 AS payment_key, payment_id, order_id, payment_method,
       payment_status
FROM s_payments
""")
cte("d_date", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
       CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, strftime(d, '%A') AS day_name
FROM (SELECT CAST(unnest(generate_series(
          (SELECT make_date(CAST(year(MIN(order_date)) AS INTEGER), 1, 1) FROM a_orders),
          (SELECT make_date(CAST(year(MAX(order_date)) AS INTEGER), 12, 31) FROM a_orders),
          INTERVAL 1 DAY)) AS DATE) AS d) g
""")

# ---------------------------------------------------------------------- fact
FACT_BODY = """
SELECT o.order_id, c.customer_key, p.product_key, d.date_key, y.payment_key, i.quantity, i.unit_price,
       i.discount, i.line_total AS revenue
FROM s_orders o
JOIN s_order_items i ON i.order_id = o.order_id
JOIN {dim} c ON o.customer_id = c.customer_id AND o.order_date >= c.effective_from
             AND (c.effective_to IS NULL OR o.order_date < c.effective_to)
JOIN d_product p ON i.product_id = p.product_id
JOIN d_date d ON CAST(o.order_date AS DATE) = d.full_date
JOIN d_payment y ON o.order_id = y.order_id
"""
cte("f_orders", FACT_BODY.format(dim="d_customer"))

# -------------------------------------------------------------- final queries
ORACLE: dict[str, str] = {}


def oracle(name: str, final: str) -> None:
    ORACLE[name] = sql(final)


oracle("stage_customers", "SELECT * FROM s_customers")
oracle("stage_products", """
SELECT product_id, product_name, category, subcategory, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(cost_price AS DOUBLE) AS cost_price, supplier, updated_at,
       CAST(profit_per_unit AS DOUBLE) AS profit_per_unit FROM s_products""")
oracle("stage_orders", "SELECT * FROM s_orders")
oracle("stage_order_items", """
SELECT order_id, line_number, product_id, supplier_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, updated_at, CAST(line_total AS DOUBLE) AS line_total
FROM s_order_items""")
oracle("stage_payments", """
SELECT payment_id, order_id, payment_method, payment_status, CAST(amount AS DOUBLE) AS amount, payment_date
FROM s_payments""")
oracle("dedupe_lineitem", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
             l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC) AS rn
      FROM lineitem) x
WHERE rn = 1""")
oracle("dim_customer_initial", "SELECT * FROM d_customer")
oracle("dim_product", """
SELECT product_key, product_id, product_name, category, subcategory, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(cost_price AS DOUBLE) AS cost_price, CAST(profit_per_unit AS DOUBLE) AS profit_per_unit, supplier
FROM d_product""")
oracle("dim_payment", "SELECT * FROM d_payment")
oracle("dim_date", "SELECT * FROM d_date")
oracle("fact_orders", """
SELECT order_id, customer_key, product_key, date_key, payment_key, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(revenue AS DOUBLE) AS revenue FROM f_orders""")

# The fact at order grain, once per subject: an order has one date and one
# customer version, and may hold several products.
cte("basket_of_day", """
SELECT date_key, order_id, sum(quantity) AS pieces, sum(revenue) AS amount FROM f_orders GROUP BY ALL
""")
cte("basket_of_product", """
SELECT product_key, order_id, sum(quantity) AS pieces, sum(quantity * unit_price) AS gross, sum(discount) AS rebate,
       sum(revenue) AS amount
FROM f_orders GROUP BY ALL
""")
for _suffix in ("", "_moved"):
    cte(f"basket_of_customer{_suffix}", f"""
SELECT customer_key, order_id, min(date_key) AS date_key, sum(quantity) AS pieces, sum(revenue) AS amount
FROM f_orders{_suffix} GROUP BY ALL
""")

DAILY = """
SELECT cal.full_date, cal.year, cal.month, cal.month_name, cal.quarter, trade.baskets AS total_orders,
       CAST(trade.pieces AS BIGINT) AS {units}, CAST(trade.amount AS DOUBLE) AS total_revenue{extra}
FROM (SELECT date_key, count(*) AS baskets, sum(pieces) AS pieces, sum(amount) AS amount
      FROM basket_of_day GROUP BY date_key) AS trade
JOIN d_date AS cal USING (date_key)"""
AVERAGE = ", CAST(trade.amount AS DOUBLE) / trade.baskets AS average_order_value"
oracle("daily_sales", DAILY.format(units="units_sold", extra=""))
oracle("mart_daily_sales", DAILY.format(units="total_items_sold", extra=AVERAGE))
PRODUCT = """
SELECT item.product_key, item.product_id, item.product_name, item.category, item.subcategory, units_sold, total_revenue
FROM (SELECT product_key, CAST(sum(pieces) AS BIGINT) AS units_sold, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
      FROM basket_of_product GROUP BY product_key) AS sold
JOIN d_product AS item USING (product_key)"""
oracle("product_performance", PRODUCT)
MART_PRODUCT = """
SELECT item.product_key, item.product_id, item.product_name, item.category, item.subcategory, total_orders,
       total_units_sold, gross_sales, total_discount, total_revenue
FROM (SELECT product_key, count(*) AS total_orders, CAST(sum(pieces) AS BIGINT) AS total_units_sold,
             CAST(sum(gross) AS DOUBLE) AS gross_sales, CAST(sum(rebate) AS DOUBLE) AS total_discount,
             CAST(sum(amount) AS DOUBLE) AS total_revenue
      FROM basket_of_product GROUP BY product_key) AS sold
JOIN d_product AS item USING (product_key)"""
oracle("mart_product_performance", MART_PRODUCT)
CUSTOMER_SALES = """
SELECT buyer.customer_key, buyer.customer_id, buyer.first_name, buyer.last_name, buyer.city, buyer.state, buyer.country,
       total_orders, units_purchased, total_revenue
FROM (SELECT customer_key, count(*) AS total_orders, CAST(sum(pieces) AS BIGINT) AS units_purchased,
             CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
      FROM {baskets} GROUP BY customer_key) AS bought
JOIN {dim} AS buyer USING (customer_key)"""
oracle("customer_sales", CUSTOMER_SALES.format(dim="d_customer", baskets="basket_of_customer"))
MART_CUSTOMER = """
SELECT buyer.customer_key, buyer.customer_id, buyer.first_name, buyer.last_name, buyer.city, buyer.state, buyer.country,
       buyer.is_current, count(order_id) AS total_orders, CAST(coalesce(sum(pieces), 0) AS BIGINT) AS total_items_purchased,
       CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total_revenue,
       min(cal.full_date) AS first_purchase_date, max(cal.full_date) AS most_recent_purchase_date
FROM d_customer AS buyer
LEFT JOIN basket_of_customer USING (customer_key)
LEFT JOIN d_date AS cal USING (date_key)
GROUP BY ALL"""
oracle("mart_customer_performance", MART_CUSTOMER)
CATEGORY = """
SELECT category, CAST(sum(pieces) AS BIGINT) AS units_sold, CAST(round(sum(amount), 2) AS DOUBLE) AS total_revenue
FROM basket_of_product JOIN d_product USING (product_key) GROUP BY category"""
oracle("mart_category_performance", CATEGORY)
oracle("mart_payment_analysis", """
SELECT payment_method, payment_status, COUNT(payment_id) AS payment_count,
       CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_payment_amount
FROM s_payments GROUP BY payment_method, payment_status""")
oracle("customers_without_sales", """
SELECT c.customer_key, c.customer_id, c.first_name, c.last_name FROM d_customer c
WHERE NOT EXISTS (SELECT 1 FROM f_orders f WHERE f.customer_key = c.customer_key)""")
oracle("orders_without_items", """
SELECT o.order_id, o.customer_id, o.order_date FROM s_orders o
WHERE NOT EXISTS (SELECT 1 FROM s_order_items i WHERE i.order_id = o.order_id)""")
oracle("kpi_totals", """
SELECT CAST(SUM(revenue) AS DOUBLE) AS total_revenue, COUNT(DISTINCT order_id) AS total_orders,
       CAST(SUM(quantity) AS BIGINT) AS units_sold,
       CAST(SUM(revenue) AS DOUBLE) / NULLIF(COUNT(DISTINCT order_id), 0) AS average_order_value
FROM f_orders""")
oracle("revenue_by_category", """
SELECT category, CAST(amount AS DOUBLE) AS total_revenue,
       CAST(amount AS DOUBLE) / (SELECT CAST(sum(revenue) AS DOUBLE) FROM f_orders) AS revenue_share
FROM (SELECT category, sum(amount) AS amount FROM basket_of_product JOIN d_product USING (product_key) GROUP BY category) x""")
oracle("payment_amount_by_method", """
SELECT payment_method, COUNT(payment_id) AS payment_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM s_payments GROUP BY payment_method""")
oracle("payment_status_counts", """
SELECT payment_status, COUNT(payment_id) AS payment_count, CAST(SUM(amount) AS DOUBLE) AS total_amount
FROM s_payments GROUP BY payment_status""")
oracle("top10_products", """
SELECT p.product_key, p.product_id, p.product_name, p.category, CAST(SUM(f.quantity) AS BIGINT) AS units_sold,
       CAST(SUM(f.revenue) AS DOUBLE) AS total_revenue
FROM f_orders f JOIN d_product p ON f.product_key = p.product_key
GROUP BY p.product_key, p.product_id, p.product_name, p.category
ORDER BY SUM(f.revenue) DESC, p.product_id LIMIT 10""")
oracle("top10_customers", """
SELECT t.customer_id, c.first_name, c.last_name, CAST(t.rev AS DOUBLE) AS total_revenue
FROM (SELECT c.customer_id, SUM(f.revenue) AS rev FROM f_orders f JOIN d_customer c ON f.customer_key = c.customer_key
      GROUP BY c.customer_id ORDER BY rev DESC, c.customer_id LIMIT 10) t
LEFT JOIN d_customer c ON c.customer_id = t.customer_id AND c.is_current""")

# ====================================================== SCD / temporal text
# Scenario values: see the "Fixed scenario values" block in queries.py.
cte("ev_lagged", """
SELECT user_id, ts, event_id, event_type,
       lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
       row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
FROM events
""")
cte("ev_versions", """
SELECT user_id, event_type, ts AS effective_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM ev_lagged WHERE rn = 1 OR prev_type IS DISTINCT FROM event_type
""")
cte("ev_seen", """
SELECT user_id, run, any_value(event_type) AS event_type, min(ts) AS effective_from, max(ts) AS last_seen FROM (
  SELECT *, sum(CASE WHEN rn = 1 OR prev_type IS DISTINCT FROM event_type THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM ev_lagged) x
GROUP BY user_id, run
""")
cte("ev_stored", """
SELECT user_id, event_type, effective_from, lead(effective_from) OVER w AS effective_to,
       lead(effective_from) OVER w IS NULL AS is_current, last_seen
FROM ev_seen WINDOW w AS (PARTITION BY user_id ORDER BY run)
""")
cte("ev_base", """
SELECT row_number() OVER (ORDER BY user_id) - 1 AS version_key, user_id, event_type, ts AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events) x
WHERE rn = 1
""")
cte("ev_marked", """
SELECT row_number() OVER (ORDER BY user_id) - 1 AS version_key, user_id, event_type, ts AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE ts < TIMESTAMP '2024-01-01 12:00:00') x
WHERE rn = 1
""")
cte("ev_snap", """
SELECT user_id, event_type, ts
FROM (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) x
WHERE rn = 1
""")
cte("ev_snap_chg", """
SELECT s.user_id, s.event_type, s.ts, b.user_id IS NULL AS is_new
FROM ev_snap s LEFT JOIN ev_base b ON s.user_id = b.user_id
WHERE b.user_id IS NULL OR s.event_type IS DISTINCT FROM b.event_type
""")
cte("ev_snap_closed", """
SELECT b.version_key, b.user_id, b.event_type, b.effective_from, c.ts AS effective_to, FALSE AS is_current
FROM ev_base b JOIN ev_snap_chg c ON b.user_id = c.user_id AND NOT c.is_new
""")
cte("ev_snap_new", """
SELECT (SELECT COALESCE(MAX(version_key), -1) FROM ev_base) + row_number() OVER (ORDER BY user_id) AS version_key,
       user_id, event_type, ts AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM ev_snap_chg
""")
cte("ev_feed", """
SELECT user_id, event_type, ts
FROM (SELECT e.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
      FROM events e JOIN ev_base b ON e.user_id = b.user_id AND e.ts > b.effective_from) x
WHERE rn = 1
""")
cte("cust_snap", """
SELECT customer_id, first_name, last_name, email,
       CASE WHEN country = 'EUROPE' THEN 'BERLIN' ELSE city END AS city, state, country, signup_date,
       CASE WHEN country = 'EUROPE' THEN TIMESTAMP '1998-01-01 00:00:00' ELSE updated_at END AS updated_at
FROM s_customers
""")
CUSTOMER_MERGE = """
SELECT d.customer_key, d.customer_id, d.first_name, d.last_name, d.email, d.city, d.state, d.country, d.signup_date,
       d.effective_from, CASE WHEN c.customer_id IS NULL THEN d.effective_to ELSE c.updated_at END AS effective_to,
       CASE WHEN c.customer_id IS NULL THEN d.is_current ELSE FALSE END AS is_current
FROM d_customer d LEFT JOIN {chg} c ON d.customer_id = c.customer_id AND d.is_current
UNION ALL
SELECT (SELECT MAX(customer_key) FROM d_customer) + row_number() OVER (ORDER BY customer_id) AS customer_key,
       customer_id, first_name, last_name, email, city, state, country, signup_date,
       updated_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM {chg}
"""
CUSTOMER_CHANGED = """
SELECT s.* FROM {snap} s JOIN d_customer d ON s.customer_id = d.customer_id AND d.is_current
WHERE s.first_name IS DISTINCT FROM d.first_name OR s.last_name IS DISTINCT FROM d.last_name
   OR s.email IS DISTINCT FROM d.email OR s.city IS DISTINCT FROM d.city
   OR s.state IS DISTINCT FROM d.state OR s.country IS DISTINCT FROM d.country
"""
cte("cust_chg", CUSTOMER_CHANGED.format(snap="cust_snap"))
cte("d_customer_moved", CUSTOMER_MERGE.format(chg="cust_chg"))
cte("whatif_snap", """
SELECT customer_id, first_name, last_name, email,
       CASE WHEN customer_id = 7 THEN 'LISBON' ELSE city END AS city, state, country, signup_date,
       CASE WHEN customer_id = 7 THEN TIMESTAMP '1999-06-01 08:30:00' ELSE updated_at END AS updated_at
FROM s_customers WHERE customer_id = 7
""")
cte("whatif_chg", CUSTOMER_CHANGED.format(snap="whatif_snap"))
cte("f_orders_moved", FACT_BODY.format(dim="d_customer_moved"))

oracle("scd2_from_log", "SELECT * FROM ev_versions")
oracle("scd2_log_rejected", """
SELECT e.user_id, e.ts, e.event_id, e.event_type FROM events e JOIN ev_base b ON e.user_id = b.user_id
WHERE e.ts IS NULL OR e.ts <= b.effective_from
""")
oracle("scd2_merge_snapshot", """
SELECT * FROM ev_base b WHERE NOT EXISTS (SELECT 1 FROM ev_snap_chg c WHERE c.user_id = b.user_id AND NOT c.is_new)
UNION ALL SELECT * FROM ev_snap_closed
UNION ALL SELECT * FROM ev_snap_new""")
oracle("scd2_close_current", "SELECT * FROM ev_snap_closed")
oracle("scd2_new_versions", "SELECT * FROM ev_snap_new")
oracle("scd2_merge_strict", """
SELECT b.version_key, b.user_id, b.event_type, b.effective_from,
       CASE WHEN f.user_id IS NULL THEN b.effective_to ELSE f.ts END AS effective_to,
       f.user_id IS NULL AS is_current
FROM ev_base b LEFT JOIN ev_feed f ON b.user_id = f.user_id
UNION ALL
SELECT (SELECT MAX(version_key) FROM ev_base) + row_number() OVER (ORDER BY user_id), user_id, event_type, ts,
       CAST(NULL AS TIMESTAMP), TRUE
FROM ev_feed""")
oracle("scd2_customer_moves", "SELECT * FROM d_customer_moved")
oracle("scd2_what_if", CUSTOMER_MERGE.format(chg="whatif_chg"))
oracle("scd1_upsert", """
SELECT d.customer_key, d.customer_id, COALESCE(c.first_name, d.first_name) AS first_name,
       COALESCE(c.last_name, d.last_name) AS last_name, COALESCE(c.email, d.email) AS email,
       COALESCE(c.city, d.city) AS city, COALESCE(c.state, d.state) AS state,
       COALESCE(c.country, d.country) AS country, d.signup_date, d.effective_from, d.effective_to, d.is_current
FROM d_customer d
LEFT JOIN (SELECT customer_id, first_name, last_name, CAST(NULL AS VARCHAR) AS email, city || ' NORTH' AS city,
                  state, country FROM s_customers WHERE state = 'NATION_3') c
  ON d.customer_id = c.customer_id""")
cte("d_late", """
SELECT customer_key, customer_id, first_name, last_name, email, city, state, country, signup_date,
       CASE WHEN effective_from = CAST(signup_date AS TIMESTAMP)
            THEN effective_from + INTERVAL 45 DAY ELSE effective_from END AS effective_from,
       effective_to, is_current
FROM d_customer_moved
""")
cte("d_repaired", """
SELECT customer_key, customer_id, first_name, last_name, email, city, state, country, signup_date,
       CASE WHEN rn = 1 THEN CAST(signup_date AS TIMESTAMP) ELSE effective_from END AS effective_from,
       effective_to, is_current
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY effective_from, customer_key) AS rn
      FROM d_late) x
""")
oracle("scd2_repair_start", "SELECT * FROM d_repaired")
oracle("point_in_time_join", """
SELECT e.event_id, e.user_id, e.ts, e.event_type, v.event_type AS version_type, v.effective_from
FROM events e JOIN ev_versions v ON e.user_id = v.user_id AND e.ts >= v.effective_from
 AND (v.effective_to IS NULL OR e.ts < v.effective_to)""")
oracle("version_match_count", """
SELECT o.order_id, COUNT(d.customer_key) AS match_count
FROM s_orders o LEFT JOIN d_customer_moved d ON o.customer_id = d.customer_id AND o.order_date >= d.effective_from
 AND (d.effective_to IS NULL OR o.order_date < d.effective_to)
GROUP BY o.order_id""")
cte("cust_snap_late", CTES["cust_snap"].replace("1998-01-01 00:00:00", "2001-11-15 00:00:00"))
cte("cust_chg_late", CUSTOMER_CHANGED.format(snap="cust_snap_late"))
cte("d_customer_late", CUSTOMER_MERGE.format(chg="cust_chg_late"))
cte("f_orders_late", FACT_BODY.format(dim="d_customer_late"))
oracle("versions_without_sales", """
SELECT customer_key, customer_id, first_name, last_name FROM d_customer_late
ANTI JOIN f_orders_late USING (customer_key)""")
oracle("fact_orders_versioned", """
SELECT order_id, customer_key, product_key, date_key, payment_key, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount AS DOUBLE) AS discount, CAST(revenue AS DOUBLE) AS revenue FROM f_orders_moved""")
oracle("customer_sales_versioned", CUSTOMER_SALES.format(dim="d_customer_moved", baskets="basket_of_customer_moved"))

# ================================================================ keys text
oracle("surrogate_key_dense", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS item_key,
       l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem""")
oracle("surrogate_key_continue", """
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS party_key, c_custkey AS party_id, 'customer' AS party_type
FROM customer
UNION ALL
SELECT (SELECT MAX(c_custkey) FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS c_custkey FROM customer) k)
       + row_number() OVER (ORDER BY s_suppkey), s_suppkey, 'supplier' FROM supplier""")

# ========================================================== extraction text
oracle("snapshot_extract", "SELECT * FROM a_orders")
oracle("incremental_extract", "SELECT * FROM a_orders WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'")
oracle("watermark_next", """
SELECT 'warehouse' AS pipeline_name, 'orders' AS table_name,
       COALESCE(MAX(updated_at), TIMESTAMP '2000-01-01 00:00:00') AS last_processed_at, COUNT(*) AS rows_in_batch
FROM a_orders WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'""")
oracle("order_totals", """
SELECT order_id, COUNT(*) AS item_count, CAST(SUM(line_total) AS DOUBLE) AS order_total
FROM s_order_items GROUP BY order_id""")

# ============================================================ quality text
cte("m_daily", DAILY.format(units="total_items_sold", extra=AVERAGE))
cte("m_product", PRODUCT)
cte("m_customer", CUSTOMER_SALES.format(dim="d_customer", baskets="basket_of_customer"))
cte("m_mart_product", MART_PRODUCT)
cte("m_mart_customer", MART_CUSTOMER)
cte("m_category", CATEGORY)
cte("m_payment", """
SELECT payment_method, payment_status, COUNT(payment_id) AS payment_count,
       CAST(ROUND(SUM(amount), 2) AS DOUBLE) AS total_payment_amount
FROM s_payments GROUP BY payment_method, payment_status""")


def _report(parts: list[str]) -> str:
    body = "\nUNION ALL\n".join(parts)
    return (f'SELECT "check", table_name, column_name, violations,\n'
            f"       CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status\nFROM (\n{body}\n) r")


def _row(check: str, table: str, column: str, count_sql: str) -> str:
    return (f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
            f"CAST(({count_sql}) AS BIGINT) AS violations")


def _count_if(src: str, pred: str) -> str:
    return f"SELECT COUNT(*) FROM {src} WHERE {pred}"


def _not_null(src: str, table: str, cols: list[str]) -> list[str]:
    return [_row("not_null", table, c, _count_if(src, f"{c} IS NULL")) for c in cols]


def _unique(src: str, table: str, col: str) -> str:
    return _row("unique", table, col,
                f"SELECT COUNT(*) FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1) u")


def _rel(child: str, table: str, fk: str, parent: str, pk: str) -> str:
    return _row("relationships", table, fk,
                f"SELECT COUNT(*) FROM {child} c WHERE c.{fk} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")


def _in_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
_PAYMENT_STATUSES = ["pending", "completed", "failed", "refunded"]
_PAYMENT_METHODS = ["credit_card", "debit_card", "upi", "net_banking"]

_FACT_REQUIRED = ["order_id", "customer_key", "product_key", "date_key", "payment_key", "quantity", "unit_price",
                  "discount", "revenue"]
oracle("dq_not_null", _report(
    _not_null("f_orders", "fact_orders", _FACT_REQUIRED)
    + _not_null("d_customer", "dim_customer", ["customer_key", "customer_id", "effective_from"])
    + _not_null("m_daily", "mart_daily_sales", ["full_date", "total_orders", "total_items_sold", "total_revenue",
                                                "average_order_value"])
    + _not_null("m_mart_product", "mart_product_performance", ["product_key", "total_orders", "total_units_sold",
                                                               "gross_sales", "total_discount", "total_revenue"])
    + _not_null("m_mart_customer", "mart_customer_performance", ["customer_key", "customer_id", "total_orders",
                                                                 "total_items_purchased", "total_revenue"])
    + _not_null("m_category", "mart_category_performance", ["category", "units_sold", "total_revenue"])
    + _not_null("m_payment", "mart_payment_analysis", ["payment_method", "payment_status", "payment_count",
                                                       "total_payment_amount"])))
oracle("dq_row_rules", _report(
    _not_null("f_orders", "fact_orders", _FACT_REQUIRED)
    + [_row("range", "fact_orders", name, _count_if("f_orders", pred)) for name, pred in (
        ("quantity_not_positive", "quantity <= 0"), ("unit_price_negative", "unit_price < 0"),
        ("discount_negative", "discount < 0"), ("revenue_negative", "revenue < 0"))]
    + [_row("revenue_identity", "fact_orders", name, _count_if("f_orders", pred)) for name, pred in (
        ("revenue_exact", "revenue <> quantity * unit_price - discount"),
        ("revenue_off_by_more_than_1_cents", "abs(revenue - (quantity * unit_price - discount)) > 0.01"))]
    + [_row("null_dimension_keys", "fact_orders", "customer_key,product_key,date_key,payment_key", _count_if(
        "f_orders", "customer_key IS NULL OR product_key IS NULL OR date_key IS NULL OR payment_key IS NULL"))]
    + _not_null("s_orders", "stg_orders", ["order_id", "customer_id", "order_date", "order_status"])
    + [_row("accepted_values", "stg_orders", "order_status", _count_if("s_orders", f"order_status NOT IN ({_in_list(_ORDER_STATUSES)})"))]
    + _not_null("s_payments", "stg_payments", ["payment_id", "order_id", "payment_method", "payment_status", "amount",
                                               "payment_date"])
    + [_row("accepted_values", "stg_payments", c, _count_if("s_payments", f"{c} NOT IN ({_in_list(v)})"))
       for c, v in (("payment_status", _PAYMENT_STATUSES), ("payment_method", _PAYMENT_METHODS))]
    + [_row("range", "stg_payments", "amount_negative", _count_if("s_payments", "amount < 0"))]
    + _not_null("s_products", "stg_products", ["product_id", "product_name", "category"])
    + [_row("range", "stg_products", name, _count_if("s_products", pred)) for name, pred in (
        ("unit_price_negative", "unit_price < 0"), ("cost_price_negative", "cost_price < 0"),
        ("margin_negative", "profit_per_unit < 0"))]))
oracle("dq_unique", _report([
    _unique("m_daily", "mart_daily_sales", "full_date"),
    _unique("m_mart_product", "mart_product_performance", "product_key"),
    _unique("m_mart_customer", "mart_customer_performance", "customer_key"),
    _unique("d_date", "dim_date", "full_date"),
    _unique("d_product", "dim_product", "product_key"),
    _unique("d_customer", "dim_customer", "customer_key"),
    _unique("m_category", "mart_category_performance", "category"),
    _unique("s_customers", "stg_customers", "email"),
    _unique("s_customers", "stg_customers", "customer_id"),
    _unique("s_products", "stg_products", "product_id"),
    _unique("s_orders", "stg_orders", "order_id"),
    _unique("s_payments", "stg_payments", "payment_id"),
]))
oracle("dq_relationships", _report([
    _rel("m_mart_product", "mart_product_performance", "product_key", "d_product", "product_key"),
    _rel("m_mart_customer", "mart_customer_performance", "customer_key", "d_customer", "customer_key"),
    _rel("s_payments", "stg_payments", "order_id", "s_orders", "order_id"),
    _rel("s_order_items", "stg_order_items", "product_id", "s_products", "product_id"),
    _rel("f_orders", "fact_orders", "customer_key", "d_customer", "customer_key"),
    _rel("f_orders", "fact_orders", "product_key", "d_product", "product_key"),
    _rel("f_orders", "fact_orders", "date_key", "d_date", "date_key"),
    _rel("f_orders", "fact_orders", "payment_key", "d_payment", "payment_key"),
    _rel("m_product", "product_performance", "product_key", "d_product", "product_key"),
    _rel("m_customer", "customer_sales", "customer_key", "d_customer", "customer_key"),
    _rel("s_orders", "stg_orders", "customer_id", "s_customers", "customer_id"),
    _rel("s_order_items", "stg_order_items", "order_id", "s_orders", "order_id"),
]))
oracle("dq_accepted_values", _report([
    _row("accepted_values", "stg_orders", "order_status",
         _count_if("s_orders", f"order_status IS NOT NULL AND order_status NOT IN ({_in_list(_ORDER_STATUSES)})")),
    _row("accepted_values", "stg_payments", "payment_status",
         _count_if("s_payments", f"payment_status IS NOT NULL AND payment_status NOT IN ({_in_list(_PAYMENT_STATUSES)})")),
    _row("accepted_values", "stg_payments", "payment_method",
         _count_if("s_payments", f"payment_method IS NOT NULL AND payment_method NOT IN ({_in_list(_PAYMENT_METHODS)})")),
]))
oracle("dq_ranges", _report([
    _row("range", "fact_orders", "quantity_not_positive", _count_if("f_orders", "quantity <= 0")),
    _row("range", "fact_orders", "unit_price_negative", _count_if("f_orders", "unit_price < 0")),
    _row("range", "fact_orders", "discount_negative", _count_if("f_orders", "discount < 0")),
    _row("range", "fact_orders", "revenue_negative", _count_if("f_orders", "revenue < 0")),
    _row("range", "stg_products", "unit_price_negative", _count_if("s_products", "unit_price < 0")),
    _row("range", "stg_products", "cost_price_negative", _count_if("s_products", "cost_price < 0")),
    _row("range", "stg_products", "margin_negative", _count_if("s_products", "profit_per_unit < 0")),
    _row("range", "stg_payments", "amount_negative", _count_if("s_payments", "amount < 0")),
]))
oracle("dq_revenue_identity", _report([
    _row("revenue_identity", "fact_orders", "revenue_exact",
         _count_if("f_orders", "revenue <> quantity * unit_price - discount")),
    _row("revenue_identity", "fact_orders", "revenue_off_by_more_than_1_cents",
         _count_if("f_orders", "ABS(revenue - (quantity * unit_price - discount)) > 0.01")),
]))
oracle("dq_orders_before_signup", _report([
    _row("orders_before_signup", "orders", "order_date",
         "SELECT COUNT(*) FROM s_orders o JOIN s_customers c ON o.customer_id = c.customer_id "
         "WHERE o.order_date < CAST(c.signup_date AS TIMESTAMP)")]))
oracle("dq_null_keys", _report([
    _row("null_dimension_keys", "fact_orders", "customer_key,product_key,date_key,payment_key",
         _count_if("f_orders", "customer_key IS NULL OR product_key IS NULL OR date_key IS NULL "
                               "OR payment_key IS NULL"))]))
oracle("dq_duplicate_fact_groups", _report([
    _row("duplicate_fact_groups", "fact_orders", "order_id,product_key,quantity,unit_price,discount",
         "SELECT COUNT(*) FROM (SELECT 1 FROM f_orders GROUP BY order_id, product_key, quantity, unit_price, "
         "discount HAVING COUNT(*) > 1) g")]))
oracle("dq_null_measures", _report([
    _row("null_measure", "mart_daily_sales", "total_revenue", _count_if("m_daily", "total_revenue IS NULL")),
    _row("null_measure", "product_performance", "total_revenue", _count_if("m_product", "total_revenue IS NULL")),
    _row("null_measure", "customer_sales", "total_revenue", _count_if("m_customer", "total_revenue IS NULL")),
    _row("null_measure", "mart_category_performance", "total_revenue",
         _count_if("m_category", "total_revenue IS NULL")),
    _row("null_measure", "mart_payment_analysis", "total_payment_amount",
         _count_if("m_payment", "total_payment_amount IS NULL")),
]))


def _checks(rows: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{name}' AS \"check\", CAST(({q}) AS BIGINT) AS violations"
                                for name, q in rows)


oracle("dq_scd2_integrity", _checks([
    ("overlapping_versions",
     "SELECT COUNT(*) FROM (SELECT effective_from, lag(customer_key) OVER w AS before, lag(effective_to) OVER w AS before_to "
     "FROM d_customer_moved WINDOW w AS (PARTITION BY customer_id ORDER BY effective_from, customer_key)) x "
     "WHERE before IS NOT NULL AND (before_to IS NULL OR before_to > effective_from)"),
    ("duplicate_version_keys",
     "SELECT COUNT(*) FROM (SELECT customer_key FROM d_customer_moved GROUP BY customer_key HAVING COUNT(*) > 1) x"),
    ("multiple_current_versions",
     "SELECT COUNT(*) FROM (SELECT customer_id FROM d_customer_moved WHERE is_current GROUP BY customer_id "
     "HAVING COUNT(*) > 1) x"),
    ("invalid_ranges",
     "SELECT COUNT(*) FROM d_customer_moved WHERE effective_to IS NOT NULL AND effective_to <= effective_from"),
    ("broken_chain",
     "SELECT COUNT(*) FROM d_customer_moved d WHERE d.effective_to IS NOT NULL AND NOT EXISTS "
     "(SELECT 1 FROM d_customer_moved n WHERE n.customer_id = d.customer_id AND n.effective_from = d.effective_to)"),
]))
cte("ev_feed_raw", """
SELECT e.user_id, e.event_type, e.ts FROM events e JOIN ev_base b ON e.user_id = b.user_id AND e.ts > b.effective_from
""")
oracle("dq_change_feed", _checks([
    ("duplicate_change_ids",
     "SELECT COUNT(*) FROM (SELECT user_id FROM ev_feed_raw GROUP BY user_id HAVING COUNT(*) > 1) x"),
    ("multiple_current_versions",
     "SELECT COUNT(*) FROM (SELECT user_id FROM ev_base WHERE is_current GROUP BY user_id HAVING COUNT(*) > 1) x"),
    ("change_time_not_after_current_start",
     "SELECT COUNT(*) FROM ev_feed_raw f JOIN ev_base b ON f.user_id = b.user_id AND b.is_current "
     "WHERE f.ts IS NULL OR b.effective_from IS NULL OR f.ts <= b.effective_from"),
    ("id_without_current_version",
     "SELECT COUNT(*) FROM ev_feed_raw f WHERE NOT EXISTS (SELECT 1 FROM ev_base b WHERE b.user_id = f.user_id "
     "AND b.is_current)"),
]))


def _recon(rows: list[tuple[str, str, str]], info: tuple[str, ...] = ()) -> str:
    parts = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS \"check\", CAST(({e}) AS DECIMAL(38,2)) AS e, CAST(({a}) AS DECIMAL(38,2)) AS a"
        for name, e, a in rows)
    info_sql = " OR ".join(f"\"check\" = '{c}'" for c in info) or "FALSE"
    return (f'SELECT "check", CAST(e AS DOUBLE) AS expected, CAST(a AS DOUBLE) AS actual, '
            f"CAST(a - e AS DOUBLE) AS difference,\n"
            f"       CASE WHEN e IS NOT DISTINCT FROM a THEN 'PASS' WHEN {info_sql} THEN 'INFO' ELSE 'FAIL' END AS status\n"
            f"FROM (\n{parts}\n) r")


_FACT_REV = "SELECT SUM(revenue) FROM f_orders"
oracle("reconcile_revenue", _recon([
    ("daily_sales_revenue", _FACT_REV, "SELECT SUM(CAST(total_revenue AS DECIMAL(38,2))) FROM m_daily"),
    ("product_revenue", _FACT_REV, "SELECT SUM(CAST(total_revenue AS DECIMAL(38,2))) FROM m_product"),
    ("customer_revenue", _FACT_REV, "SELECT SUM(CAST(total_revenue AS DECIMAL(38,2))) FROM m_customer"),
    ("category_revenue", _FACT_REV, "SELECT SUM(CAST(total_revenue AS DECIMAL(38,2))) FROM m_category"),
]))
oracle("reconcile_orders", _recon([
    ("daily_order_count", "SELECT COUNT(DISTINCT order_id) FROM f_orders", "SELECT SUM(total_orders) FROM m_daily"),
]))
oracle("reconcile_coverage", _recon([
    ("product_coverage", "SELECT COUNT(*) FROM d_product", "SELECT COUNT(*) FROM m_product"),
    ("customer_coverage", "SELECT COUNT(DISTINCT customer_key) FROM f_orders", "SELECT COUNT(*) FROM m_customer"),
    ("category_coverage", "SELECT COUNT(DISTINCT category) FROM d_product", "SELECT COUNT(*) FROM m_category"),
], info=("product_coverage",)))
oracle("reconcile_payments", _recon([
    ("payment_count", "SELECT COUNT(*) FROM s_payments", "SELECT SUM(payment_count) FROM m_payment"),
    ("payment_amount", "SELECT SUM(amount) FROM s_payments",
     "SELECT SUM(CAST(total_payment_amount AS DECIMAL(38,2))) FROM m_payment"),
    ("orders_paid_in_full", "SELECT 0",
     "SELECT COUNT(*) FROM (SELECT order_id, SUM(amount) AS paid FROM s_payments GROUP BY order_id) p "
     "FULL OUTER JOIN (SELECT order_id, SUM(line_total) AS order_total FROM s_order_items GROUP BY order_id) t "
     "ON p.order_id = t.order_id WHERE COALESCE(p.paid, 0) IS DISTINCT FROM COALESCE(t.order_total, 0)"),
]))

cte("s_paid", """
SELECT payment_id, order_id, payment_method, payment_status, payment_date, order_total AS amount
FROM s_payments JOIN (SELECT order_id, sum(line_total) AS order_total FROM s_order_items GROUP BY order_id) t USING (order_id)
""")
oracle("reconcile_payments_paid", _recon([
    ("payment_count", "SELECT count(*) FROM s_paid", "SELECT sum(n) FROM (SELECT count(*) AS n FROM s_paid GROUP BY payment_method, payment_status) m"),
    ("payment_amount", "SELECT sum(amount) FROM s_paid",
     "SELECT sum(a) FROM (SELECT round(sum(amount), 2) AS a FROM s_paid GROUP BY payment_method, payment_status) m"),
    ("orders_paid_in_full", "SELECT 0",
     "SELECT count(*) FROM (SELECT order_id, sum(amount) AS paid FROM s_paid GROUP BY order_id) p "
     "FULL JOIN (SELECT order_id, sum(line_total) AS due FROM s_order_items GROUP BY order_id) t "
     "USING (order_id) WHERE coalesce(paid, 0) IS DISTINCT FROM coalesce(due, 0)"),
]))

# ============================================== publish / incremental text
oracle("publish_roundtrip", "SELECT * FROM d_customer")
cte("inc_log", """
SELECT user_id, effective_from AS ts, CAST(NULL AS BIGINT) AS event_id, event_type, version_key FROM ev_marked
UNION ALL
SELECT user_id, ts, event_id, event_type, CAST(NULL AS BIGINT) FROM events WHERE ts > TIMESTAMP '2024-01-01 12:00:00'
""")
cte("inc_versions", """
SELECT user_id, event_type, ts AS effective_from,
       lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST) AS effective_to, version_key
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST) AS pt,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id NULLS FIRST) AS rn FROM inc_log) x
WHERE rn = 1 OR pt IS DISTINCT FROM event_type
""")
oracle("incremental_load", """
SELECT version_key, user_id, event_type, effective_from, effective_to, effective_to IS NULL AS is_current
FROM inc_versions WHERE version_key IS NOT NULL
UNION ALL
SELECT (SELECT MAX(version_key) FROM ev_marked) + row_number() OVER (ORDER BY user_id, effective_from),
       user_id, event_type, effective_from, effective_to, effective_to IS NULL
FROM inc_versions WHERE version_key IS NULL""")
oracle("scd2_log_two_batches", "SELECT * FROM ev_stored")
oracle("incremental_stream_files", "SELECT * FROM ev_stored")
oracle("incremental_two_runs", """
SELECT s.*, (SELECT max(ts) FROM events) AS stored_mark,
       (SELECT CAST(count(DISTINCT ts >= TIMESTAMP '2024-01-01 12:00:00') AS BIGINT) FROM events) AS commits
FROM ev_stored s""")
oracle("incremental_stream", """
SELECT row_number() OVER (ORDER BY user_id, effective_from) - 1 AS version_key, user_id, event_type,
       effective_from, effective_to, is_current FROM ev_versions""")

cte("f_lines", FACT_BODY.format(dim="d_customer").replace(
    "SELECT o.order_id,", "SELECT i.line_number, i.product_id, i.supplier_id, o.order_id,"))
oracle("dq_fact_grain", _report([
    _row("fact_grain_fan_out", "fact_orders", "order_id,line_number,product_id,supplier_id",
         "SELECT COUNT(*) FROM (SELECT 1 FROM f_lines GROUP BY order_id, line_number, product_id, supplier_id "
         "HAVING COUNT(*) > 1) g"),
    _row("fact_grain_dropped_lines", "stg_order_items", "order_id,line_number,product_id,supplier_id",
         "SELECT COUNT(*) FROM s_order_items i WHERE NOT EXISTS (SELECT 1 FROM f_lines f WHERE "
         "f.order_id = i.order_id AND f.line_number = i.line_number AND f.product_id = i.product_id "
         "AND f.supplier_id = i.supplier_id)"),
]))
oracle("dq_version_matches", _report([
    _row("exactly_one_version", "orders", "customer_id",
         "SELECT COUNT(*) FROM (SELECT o.order_id FROM s_orders o LEFT JOIN d_customer d "
         "ON o.customer_id = d.customer_id AND o.order_date >= d.effective_from "
         "AND (d.effective_to IS NULL OR o.order_date < d.effective_to) "
         "GROUP BY o.order_id HAVING COUNT(d.customer_key) <> 1) m"),
]))

oracle("dedupe_latest", """
SELECT event_id, ts, user_id, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC,
             event_type DESC, value DESC, props DESC) AS rn FROM events) x
WHERE rn = 1""")

oracle("mart_daily_sales_sql", "SELECT * FROM m_daily")

ORACLE["fact_orders_asof"] = ORACLE["fact_orders"]

oracle("dq_repair_checks", _checks([
    ("null_effective_from", "SELECT COUNT(*) FROM d_repaired WHERE effective_from IS NULL"),
    ("row_count_changed", "SELECT ABS((SELECT COUNT(*) FROM d_repaired) - (SELECT COUNT(*) FROM d_late))"),
    ("orders_not_matching_one_version",
     "SELECT COUNT(*) FROM (SELECT o.order_id FROM s_orders o LEFT JOIN d_repaired d "
     "ON o.customer_id = d.customer_id AND o.order_date >= d.effective_from "
     "AND (d.effective_to IS NULL OR o.order_date < d.effective_to) "
     "GROUP BY o.order_id HAVING COUNT(d.customer_key) <> 1) m"),
]))

# ================================================ rejects, order, catalog text
oracle("stage_rejected", """
WITH raw AS (
  SELECT CASE WHEN order_id % 97 = 0 THEN 'A' || order_id WHEN order_id % 101 = 0 THEN NULL
              ELSE CAST(order_id AS VARCHAR) END AS order_id, order_id % 97 = 0 AS bad_id, order_id % 79 = 0 AS no_customer,
         order_id % 89 = 0 AS bad_date, order_id % 83 = 0 AS bad_status, lower(order_status) AS order_status
  FROM a_orders
), judged AS (
  SELECT *, concat_ws(',', CASE WHEN bad_id THEN 'cast:order_id' END, CASE WHEN bad_date THEN 'cast:order_date' END,
                      CASE WHEN order_id IS NULL THEN 'null:order_id' END, CASE WHEN no_customer THEN 'null:customer_id' END,
                      CASE WHEN bad_status THEN 'check:order_status' END) AS why
  FROM raw
)
SELECT 'accepted' AS outcome, order_status AS detail, count(DISTINCT order_id) AS n_rows FROM judged WHERE why = '' GROUP BY ALL
UNION ALL SELECT 'rejected', why, count(*) FROM judged WHERE why <> '' GROUP BY ALL""".replace(
    "FROM a_orders", "FROM (SELECT o_orderkey AS order_id, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' "
    "ELSE 'shipped' END AS order_status FROM orders) x"))
oracle("daily_sales_ordered", f"""
SELECT row_number() OVER (ORDER BY full_date) AS position, * FROM ({DAILY.format(units="units_sold", extra="")}) x""")
oracle("incremental_extract_ordered", """
SELECT row_number() OVER (ORDER BY updated_at, order_id) AS position, * FROM a_orders
WHERE updated_at > TIMESTAMP '2000-01-01 00:00:00'""")
oracle("catalog_bucketed_join", """
SELECT order_id, order_status, count(*) AS item_count, CAST(sum(line_total) AS DOUBLE) AS order_total
FROM s_orders JOIN s_order_items USING (order_id) GROUP BY ALL""")

# ============================================= landing, swaps, whole refresh
oracle("csv_landing_roundtrip", "SELECT * FROM s_orders")
oracle("parquet_glob_snapshot", "SELECT * FROM a_orders")
oracle("publish_swap_report", """
SELECT step, (SELECT count(*) FROM s_orders) AS n_rows, CAST(n_backups AS BIGINT) AS n_backups
FROM (VALUES ('dry_run', 0), ('first', 0), ('swap', 0), ('stored', 0)) v(step, n_backups)""")
oracle("dq_expected_count", _report([
    _row("expected_count", "stg_orders", "*", "SELECT abs((SELECT count(*) FROM s_orders) - (SELECT count(*) FROM orders))"),
    _row("expected_count", "stg_payments", "*", "SELECT count(*) FROM s_payments")]))
_REFRESHED = {
    **{f"staging/{n}": f"s_{n}" for n in ("customers", "products", "orders", "order_items", "payments")},
    "warehouse/dim_customer": "d_customer", "warehouse/dim_product": "d_product", "warehouse/dim_payment": "d_payment",
    "warehouse/dim_date": "d_date", "warehouse/fact_orders": "f_orders",
    "analytics/mart_daily_sales": "m_daily", "analytics/mart_product_performance": "m_mart_product",
    "analytics/mart_customer_performance": "m_mart_customer", "analytics/mart_category_performance": "m_category",
    "analytics/mart_payment_analysis": "m_payment"}
oracle("full_refresh_second_run", "\nUNION ALL\n".join(
    [f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}" for name, source in _REFRESHED.items()]
    + [f"SELECT 'rejected/{n}', CAST(0 AS BIGINT)" for n in ("customers", "products", "orders", "order_items", "payments")]))
