"""The jaffle-shop models."""

from pyspark.sql import functions as F

from martmill.plans import jaffle
from verification import query
from verification.sqltext import (
    DIM_ORDER, ITEMS, RAW_ITEMS, RAW_ORDERS, RAW_PRODUCTS, RAW_STORES, RAW_SUPPLIES, RFM, with_,
)


@query("SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CASE WHEN c_custkey % 50 <> 49 THEN c_name END AS customer_name FROM customer")
def stg_customers(g):
    return jaffle.stg_customers(g.raw_customers())


@query(with_(RAW_ITEMS) + "SELECT * FROM j_items")
def stg_order_items(g):
    return jaffle.stg_order_items(g.raw_items())


@query(with_(RAW_STORES) + "SELECT id AS location_id, name AS location_name, CAST(tax_rate AS DOUBLE) AS tax_rate, "
       "CAST(CAST(opened_at AS DATE) AS TIMESTAMP) AS opened_date FROM raw_stores")
def stg_locations(g):
    return jaffle.stg_locations(g.raw_stores())


@query(with_(RAW_ORDERS) + "SELECT * FROM j_orders")
def stg_orders(g):
    return jaffle.stg_orders(g.raw_orders())


@query(with_(RAW_PRODUCTS) + "SELECT * EXCLUDE (price_cents), price_cents / 100.0::DOUBLE AS product_price FROM j_products")
def stg_products(g):
    return jaffle.stg_products(g.raw_products())


@query(with_(RAW_SUPPLIES) + "SELECT md5(id || '-' || sku) AS supply_uuid, id AS supply_id, sku AS product_id, "
       "name AS supply_name, cost / 100.0::DOUBLE AS supply_cost, perishable AS is_perishable_supply FROM raw_supplies")
def stg_supplies(g):
    return jaffle.stg_supplies(g.raw_supplies())


@query("SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name FROM customer WHERE c_custkey % 50 <> 49")
def dim_customer(g):
    return jaffle.dim_customer(stg_customers(g))


@query(with_(RAW_ORDERS, DIM_ORDER) + "SELECT * FROM dim_order")
def dim_order(g):
    return jaffle.dim_order(stg_orders(g), stg_locations(g))


def fact_inputs(g):
    return stg_order_items(g), stg_orders(g), stg_products(g), stg_supplies(g)


_ITEM_COLUMNS = """SELECT order_item_id, order_id, product_id, customer_id, ordered_at, product_name,
  price_cents / 100.0::DOUBLE AS product_price, is_food_item, is_drink_item, cost_cents / 100.0::DOUBLE AS supply_cost FROM items"""


@query(with_(ITEMS) + _ITEM_COLUMNS)
def fct_order_items(g):
    return jaffle.fct_order_items(*fact_inputs(g))


@query(with_(ITEMS) + """SELECT order_item_id, order_id, product_id, customer_id, ordered_at,
  price_cents / 100.0::DOUBLE AS product_price, is_food_item, is_drink_item,
  (cost_cents * 95) / 10000.0::DOUBLE AS base_supply_cost FROM items""")
def fct_order_items_v2(g):
    return jaffle.fct_order_items_v2(*fact_inputs(g))


@query(with_(ITEMS) + """SELECT ordered_at AS order_date, strftime(ordered_at, '%m-%d') IN ('01-26', '04-25', '12-25') AS is_holiday,
  CAST(sum(CASE WHEN is_drink_item THEN price_cents ELSE 0 END) AS BIGINT) / 100.0::DOUBLE AS drink_order_amount,
  CAST(sum(CASE WHEN is_food_item THEN price_cents ELSE 0 END) AS BIGINT) / 100.0::DOUBLE AS food_order_amount
FROM items GROUP BY 1, 2""")
def daily_orders_summary(g):
    return jaffle.daily_orders_summary(fct_order_items_v2(g), g.holidays())


@query(with_(ITEMS, RFM) + "SELECT * EXCLUDE (value_cents) FROM segments")
def int_customer_rfm_segments(g):
    return jaffle.customer_rfm_segments(fct_order_items_v2(g))


# Half-up rounding in whole numbers: floor((2 * sum + n) / (2 * n)), in units of the last place kept.
SEGMENT_ROWS = """SELECT customer_segment, count(DISTINCT customer_id) AS customer_count,
  CAST((2 * sum(value_cents) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0::DOUBLE AS avg_lifetime_value,
  CAST((20 * sum(order_frequency) + count(*)) // (2 * count(*)) AS BIGINT) / 10.0::DOUBLE AS avg_order_frequency,
  CAST(CAST((2 * sum(recency_days) + count(*)) // (2 * count(*)) AS BIGINT) AS DOUBLE) AS avg_days_since_last_order
FROM segments GROUP BY 1"""
SEGMENT_ORDERS = with_(ITEMS, RFM) + SEGMENT_ROWS


@query(SEGMENT_ORDERS)
def fct_customer_segment_orders(g):
    return jaffle.customer_segment_orders(int_customer_rfm_segments(g), dim_customer(g))


@query("""
WITH days AS (SELECT CAST(unnest(generate_series(DATE '2010-01-01', DATE '2029-12-31', INTERVAL 1 DAY)) AS TIMESTAMP) AS date_day),
  today AS (SELECT CAST(max(ts) AS DATE) AS d FROM events)
SELECT date_day, count(event_id) AS events FROM days LEFT JOIN events ON date_trunc('day', ts) = date_day
WHERE date_day > (SELECT d - INTERVAL 20 YEAR FROM today) AND date_day < (SELECT d + INTERVAL 30 DAY FROM today)
GROUP BY 1""")
def time_spine_daily(g):
    """The day calendar as of the last event, with the events of each day."""
    daily = g.raw("events").groupBy(F.to_date("ts").alias("date_day")).agg(F.count(F.lit(1)).alias("events"))
    joined = jaffle.time_spine_daily(g.spark, g.last_event_day()).join(daily, "date_day", "left")
    return joined.select("date_day", F.coalesce("events", F.lit(0)).alias("events"))
