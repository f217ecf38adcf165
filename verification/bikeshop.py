"""The bike-shop models, with the facts of all three sites."""

from martmill.plans import bikeshop as bike
from verification import query
from verification.sqltext import BIKE, BIKE_CUSTOMERS, BIKE_ORDER_PRODUCTS, BIKE_ORDERS, BIKE_PRODUCTS, with_


@query(with_(BIKE_CUSTOMERS) + "SELECT * FROM bike_stg_customers")
def stg_bike_shop__customers(g):
    return bike.stg_customers(g.bike_customers())


@query(with_(BIKE_ORDER_PRODUCTS) + "SELECT * FROM bike_stg_order_products")
def stg_bike_shop__order_products(g):
    return bike.stg_order_products(g.bike_order_products())


@query(with_(BIKE_ORDERS) + "SELECT * FROM bike_stg_orders")
def stg_bike_shop__orders(g):
    return bike.stg_orders(g.bike_orders())


@query(with_(BIKE_PRODUCTS) + "SELECT * REPLACE (CAST(product_price AS DOUBLE) AS product_price, "
       "CAST(product_cost AS DOUBLE) AS product_cost) FROM bike_stg_products")
def stg_bike_shop__products(g):
    return bike.stg_products(g.bike_products())


@query(with_(BIKE_CUSTOMERS) + "SELECT * EXCLUDE (loaded_at) FROM bike_stg_customers")
def bike_dim_customer(g):
    return bike.dim_customer(stg_bike_shop__customers(g))


@query(with_(BIKE_ORDERS) + "SELECT order_id, order_status, order_date FROM bike_stg_orders")
def bike_dim_order(g):
    return bike.dim_order(stg_bike_shop__orders(g))


@query(with_(BIKE_PRODUCTS) + "SELECT * EXCLUDE (product_cost, product_price, loaded_at) FROM bike_stg_products")
def bike_dim_product(g):
    return bike.dim_product(stg_bike_shop__products(g))


@query("""
WITH days AS (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2029-12-30', INTERVAL 1 DAY)) AS TIMESTAMP) AS date_day)
SELECT date_day, count(event_id) AS events FROM days LEFT JOIN events ON date_trunc('day', ts) = date_day GROUP BY 1""")
def dim_date(g):
    """The day dimension, with the events of each day."""
    from pyspark.sql import functions as F

    daily = g.raw("events").groupBy(F.to_date("ts").alias("date_day")).agg(F.count(F.lit(1)).alias("events"))
    joined = bike.dim_date(g.spark).join(daily, "date_day", "left")
    return joined.select("date_day", F.coalesce("events", F.lit(0)).alias("events"))


def _fact(g, site):
    return bike.fct_order_products(
        stg_bike_shop__order_products(g), stg_bike_shop__products(g), stg_bike_shop__orders(g), site
    )


_MONEY = "CAST(product_price AS DOUBLE) AS product_price, CAST({cost} AS DOUBLE) AS product_cost"


@query(with_(BIKE) + f"SELECT * REPLACE ({_MONEY.format(cost='product_cost')}) FROM bike_fact")
def fct_order_products_merging(g):
    return _fact(g, bike.MERGING)


@query(with_(BIKE) + "SELECT * EXCLUDE (loaded_at) REPLACE ("
       + _MONEY.format(cost="product_cost * CAST(0.95 AS DECIMAL(2,2))") + ") FROM bike_fact")
def fct_order_products_discounting(g):
    return _fact(g, bike.DISCOUNTING)


@query(with_(BIKE) + f"SELECT * EXCLUDE (loaded_at) REPLACE ({_MONEY.format(cost='product_cost')}) FROM bike_fact")
def fct_order_products_plain(g):
    return _fact(g, bike.PLAIN)
