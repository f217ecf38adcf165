"""SQL pieces shared by the oracle statements: the derived raw tables, restated in plain SQL."""


def d2(c: str) -> str:
    return f"CAST({c} AS DECIMAL(15,2))"


def dbl(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


GEO = """
geo AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal AS account_balance,
         c_mktsegment AS market_segment, n_nationkey AS nation_id, n_name AS nation_name,
         r_regionkey AS region_id, r_name AS region_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""

ENRICHED = """
enriched AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_shipdate AS event_date,
         l_quantity AS quantity, l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax,
         l_returnflag AS return_flag, o_custkey AS customer_id, o_orderdate AS order_date,
         o_orderstatus AS order_status, o_orderpriority AS order_priority,
         c_mktsegment AS market_segment, c_nationkey AS nation_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
"""

BIKE_CUSTOMERS = """
bike_customers AS (
  SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         lower(c_name) || '@example.com' AS email,
         CASE c_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'X' END AS gender,
         n_name AS city, TIMESTAMP '2001-09-01 00:00:00' AS loaded_at
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
bike_stg_customers AS (
  SELECT id AS customer_id, first_name AS customer_first_name, last_name AS customer_last_name,
         email AS customer_email_address,
         CASE gender WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' WHEN 'X' THEN 'Non-binary' END AS customer_gender,
         city AS customer_city, loaded_at
  FROM bike_customers)
"""

BIKE_PRODUCTS = """
bike_products AS (
  SELECT p_partkey AS id, p_name AS model, p_brand AS category, 'Size ' || p_size AS subcategory, p_type AS frame,
         CAST(p_retailprice AS DECIMAL(15,2)) AS price,
         CAST(p_retailprice AS DECIMAL(15,2)) * CAST(0.4688 AS DECIMAL(4,4)) AS product_cost,
         TIMESTAMP '2001-09-01 00:00:00' AS loaded_at
  FROM part),
bike_stg_products AS (
  SELECT id AS product_id, model AS product_name, frame AS product_material, category AS product_category,
         subcategory AS product_subcategory, price AS product_price, round(product_cost, 2) AS product_cost, loaded_at
  FROM bike_products)
"""

BIKE_ORDERS = """
bike_orders AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'SHIPPED' END AS order_status,
         CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date, o_orderdate AS loaded_at
  FROM orders),
bike_stg_orders AS (
  SELECT id AS order_id, customer_id,
         concat(upper(left(order_status, 1)), lower(substr(order_status, 2))) AS order_status, order_date, loaded_at
  FROM bike_orders)
"""

BIKE_ORDER_PRODUCTS = """
bike_order_products AS (
  SELECT l_orderkey || '-' || l_linenumber AS id,
         CASE WHEN min(l_partkey) % 97 <> 0 THEN min(l_partkey) ELSE -1 END AS product_id,
         l_orderkey AS order_id, CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS BIGINT) AS quantity,
         max(l_shipdate) AS loaded_at
  FROM lineitem GROUP BY l_orderkey, l_linenumber),
bike_stg_order_products AS (
  SELECT id AS order_product_id, product_id, order_id, quantity AS order_product_quantity, loaded_at
  FROM bike_order_products)
"""

BIKE_FACT = """
bike_fact AS (
  SELECT op.order_product_id, op.product_id, op.order_id, o.customer_id, o.order_date, op.order_product_quantity,
         p.product_price, p.product_cost, op.loaded_at
  FROM bike_stg_order_products op
  LEFT JOIN bike_stg_products p ON op.product_id = p.product_id
  LEFT JOIN bike_stg_orders o ON op.order_id = o.order_id)
"""

BIKE = ",\n".join(p.strip() for p in (BIKE_PRODUCTS, BIKE_ORDERS, BIKE_ORDER_PRODUCTS, BIKE_FACT))

RAW_ORDERS = """
raw_orders AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer,
         o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS ordered_at,
         CAST(o_custkey % 27 AS VARCHAR) AS store_id,
         total - (total * 8) // 108 AS subtotal, (total * 8) // 108 AS tax_paid, total AS order_total
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS total FROM orders)),
j_orders AS (
  SELECT id AS order_id, store_id AS location_id, customer AS customer_id, subtotal AS subtotal_cents,
         tax_paid AS tax_paid_cents, order_total AS order_total_cents, subtotal / 100.0::DOUBLE AS subtotal,
         tax_paid / 100.0::DOUBLE AS tax_paid, order_total / 100.0::DOUBLE AS order_total,
         CAST(CAST(ordered_at AS DATE) AS TIMESTAMP) AS ordered_at
  FROM raw_orders)
"""

RAW_ITEMS = """
j_items AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS order_item_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id
  FROM lineitem)
"""

RAW_STORES = """
raw_stores AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name,
         TIMESTAMP '2016-09-01 23:59:59' + to_days(n_nationkey) AS opened_at,
         CAST((n_nationkey % 10) * 0.01 AS DECIMAL(6,4)) AS tax_rate
  FROM nation)
"""

RAW_PRODUCTS = """
j_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
         CASE p_size % 3 WHEN 0 THEN 'jaffle' WHEN 1 THEN 'beverage' END AS product_type, p_type AS product_description,
         CAST(round(p_retailprice * 100) AS BIGINT) AS price_cents,
         p_size % 3 = 0 AS is_food_item, p_size % 3 = 1 AS is_drink_item
  FROM part)
"""

RAW_SUPPLIES = """
raw_supplies AS (
  SELECT 'SUP-' || l_suppkey AS id, 'supply ' || l_suppkey AS name,
         CAST(round(p_retailprice * 100) AS BIGINT) // 10 AS cost, l_suppkey % 2 = 0 AS perishable,
         CAST(l_partkey AS VARCHAR) AS sku
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey)
"""

# Order items with customer, day, product and supply cost (all money in cents).
ITEMS = ",\n".join(p.strip() for p in (RAW_ORDERS, RAW_ITEMS, RAW_PRODUCTS, RAW_SUPPLIES)) + """,
supply_summary AS (SELECT sku AS product_id, CAST(sum(cost) AS BIGINT) AS cost_cents FROM raw_supplies GROUP BY 1),
items AS (
  SELECT i.order_item_id, i.order_id, i.product_id, o.customer_id, o.ordered_at, p.product_name, p.price_cents,
         p.is_food_item, p.is_drink_item, s.cost_cents
  FROM j_items i LEFT JOIN j_orders o ON i.order_id = o.order_id
  LEFT JOIN j_products p ON i.product_id = p.product_id
  LEFT JOIN supply_summary s ON i.product_id = s.product_id)
"""

DIM_ORDER = RAW_STORES.strip() + """,
dim_order AS (
  SELECT o.order_id, s.name AS location_name, CAST(s.tax_rate * 100 AS DOUBLE) AS tax_rate_percent,
         o.subtotal, o.order_total, o.ordered_at
  FROM j_orders o JOIN raw_stores s ON o.location_id = s.id)
"""

MARKET = """
market_data AS (
  SELECT CAST(date_trunc('month', o_orderdate + INTERVAL 2 MONTH) AS TIMESTAMP) AS report_month,
         CAST(3 * sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN cents ELSE 0 END) AS BIGINT) AS food_sales,
         CAST(3 * sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE cents END) AS BIGINT) AS beverage_sales,
         CAST(3 * sum(cents) AS BIGINT) AS total_sales
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
  GROUP BY 1)
"""

SPINE = """
spine AS (
  SELECT CAST(d AS TIMESTAMP) AS period
  FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d
        FROM orders))
"""

RFM = """
rfm AS (
  SELECT customer_id, CAST(date_diff('day', max(ordered_at), (SELECT max(ordered_at) FROM items)) AS INTEGER) AS recency_days,
         count(DISTINCT order_id) AS order_frequency, CAST(coalesce(sum(price_cents), 0) AS BIGINT) AS value_cents
  FROM items WHERE customer_id IS NOT NULL GROUP BY customer_id),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY recency_days, customer_id) AS rr,
         row_number() OVER (ORDER BY order_frequency, customer_id) AS rf,
         row_number() OVER (ORDER BY value_cents, customer_id) AS rm, count(*) OVER () AS n
  FROM rfm),
scored AS (
  SELECT *, 6 - greatest(1, ceil((rr - 1) * 5.0 / (n - 1))) AS r, greatest(1, ceil((rf - 1) * 5.0 / (n - 1))) AS f,
         greatest(1, ceil((rm - 1) * 5.0 / (n - 1))) AS m
  FROM ranked),
segments AS (
  SELECT customer_id, recency_days, order_frequency, value_cents / 100.0::DOUBLE AS lifetime_value, value_cents,
         CAST(CAST(r AS INTEGER) AS VARCHAR) || CAST(CAST(f AS INTEGER) AS VARCHAR) || CAST(CAST(m AS INTEGER) AS VARCHAR) AS rfm_score,
         CASE WHEN r >= 4 AND f >= 4 THEN 'Champions' WHEN r >= 3 AND f >= 3 THEN 'Loyal Customers'
              WHEN r >= 3 THEN 'Potential Loyalists' WHEN r >= 2 THEN 'At-Risk' ELSE 'Hibernating' END AS customer_segment
  FROM scored)
"""
