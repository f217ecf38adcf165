"""Measures, metrics and the saved query."""

import datetime as dt

from martmill.operators import metrics as M
from martmill.plans import jaffle
from verification import query
from verification.jaffle import dim_order, fct_order_items
from verification.sqltext import DIM_ORDER, ITEMS, MARKET, SPINE, with_


def _items(g, with_orders=False):
    return jaffle.order_item_model(fct_order_items(g), dim_order(g) if with_orders else None)


def _metric(g, name, **kw):
    return jaffle.metric(name, _items(g, with_orders=True), g.order_days(), jaffle.market_model(g.market_data()), **kw)


@query(with_(ITEMS) + "SELECT ordered_at AS period, customer_id AS customer, sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue FROM items GROUP BY 1, 2")
def measure_order_item_revenue(g):
    return M.measures(_items(g), {"revenue": "order_item_revenue"}, "day", ["customer"])


@query(with_(ITEMS) + "SELECT ordered_at AS period, product_id AS product, sum(cost_cents)::BIGINT / 100.0::DOUBLE AS cost FROM items GROUP BY 1, 2")
def measure_order_item_cost(g):
    return M.measures(_items(g), {"cost": "order_item_cost"}, "day", ["product"])


@query(with_(ITEMS) + "SELECT CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS period, count(DISTINCT order_id) AS orders FROM items GROUP BY 1")
def measure_order_count(g):
    return M.measures(_items(g), {"orders": "order_count"}, "month")


@query(with_(ITEMS) + "SELECT ordered_at AS period, sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue FROM items GROUP BY 1")
def dim_order_date(g):
    return M.measures(_items(g), {"revenue": "order_item_revenue"}, "day")


def _by_order_dimension(column):
    return with_(ITEMS, DIM_ORDER) + f"""SELECT d.{column}, sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue,
  count(DISTINCT i.order_id) AS orders FROM items i LEFT JOIN (SELECT *, tax_rate_percent > 5 AS high_tax_area,
  subtotal > 30 AS large_order FROM dim_order) d ON i.order_id = d.order_id GROUP BY 1"""


_BOTH = {"revenue": "order_item_revenue", "orders": "order_count"}


@query(_by_order_dimension("location_name"))
def dim_location_name(g):
    return M.measures(_items(g, True), _BOTH, group_by=["location_name"])


@query(_by_order_dimension("high_tax_area"))
def dim_high_tax_area(g):
    return M.measures(_items(g, True), _BOTH, group_by=["high_tax_area"])


@query(_by_order_dimension("large_order"))
def dim_large_order(g):
    return M.measures(_items(g, True), _BOTH, group_by=["large_order"])


def _by_entity(column, name):
    return with_(ITEMS) + (
        f"SELECT {column} AS {name}, sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue, "
        "count(DISTINCT order_id) AS orders FROM items GROUP BY 1"
    )


@query(_by_entity("customer_id", "customer"))
def entity_customer(g):
    return M.measures(_items(g), _BOTH, group_by=["customer"])


@query(_by_entity("product_id", "product"))
def entity_product(g):
    return M.measures(_items(g), _BOTH, group_by=["product"])


@query(_by_entity("order_item_id", "order_item"))
def entity_order_item(g):
    return M.measures(_items(g), _BOTH, group_by=["order_item"])


DAILY = "daily AS (SELECT ordered_at AS period, sum(price_cents)::BIGINT AS c, count(DISTINCT order_id) AS n FROM items GROUP BY 1)"
MONTHLY = ("monthly AS (SELECT CAST(date_trunc('month', ordered_at) AS TIMESTAMP) AS period, sum(price_cents)::BIGINT AS c, "
           "count(DISTINCT order_id) AS n FROM items GROUP BY 1)")
MONTHS = "months AS (SELECT DISTINCT CAST(date_trunc('month', period) AS TIMESTAMP) AS period FROM spine)"


@query(with_(ITEMS, SPINE, DAILY) + "SELECT period, c / 100.0::DOUBLE AS revenue FROM spine LEFT JOIN daily USING (period)")
def metric_revenue(g):
    return _metric(g, "revenue")


@query(with_(ITEMS, SPINE, MONTHLY, MONTHS) + """
SELECT m.period, p.c / 100.0::DOUBLE AS monthly_revenue_l1m
FROM months m LEFT JOIN monthly p ON p.period + INTERVAL 1 MONTH = m.period""")
def metric_monthly_revenue_l1m(g):
    return _metric(g, "monthly_revenue_l1m", grain="month")


@query(with_(ITEMS, SPINE, DAILY) + """
SELECT period, CAST(sum(coalesce(c, 0)) OVER (PARTITION BY date_trunc('month', period) ORDER BY period) AS BIGINT) / 100.0::DOUBLE AS mtd_revenue
FROM spine LEFT JOIN daily USING (period)""")
def metric_mtd_revenue(g):
    return _metric(g, "mtd_revenue")


@query(with_(ITEMS, SPINE, MONTHLY, MONTHS) + """
SELECT m.period, coalesce(c, 0)::BIGINT / 100.0::DOUBLE AS mtd_revenue FROM months m LEFT JOIN monthly USING (period)""")
def metric_mtd_revenue_by_month(g):
    """The last month-to-date value of every month."""
    return _metric(g, "mtd_revenue", grain="month")


@query(with_(ITEMS, SPINE, MONTHLY, MONTHS) + """
SELECT m.period, a.c / 100.0::DOUBLE AS current_month, p.c / 100.0::DOUBLE AS previous_month,
  (a.c / 100.0::DOUBLE) / nullif(p.c / 100.0::DOUBLE, 0) - 1 AS mom_revenue_performance
FROM months m LEFT JOIN monthly a ON a.period = m.period LEFT JOIN monthly p ON p.period + INTERVAL 1 MONTH = m.period""")
def metric_mom_revenue_performance(g):
    return _metric(g, "mom_revenue_performance", grain="month")


@query(with_(ITEMS, DIM_ORDER) + """SELECT i.ordered_at AS period, d.location_name, count(DISTINCT i.order_id) AS order_count
FROM items i LEFT JOIN dim_order d ON i.order_id = d.order_id GROUP BY 1, 2""")
def metric_order_count(g):
    return _metric(g, "order_count", group_by=("location_name",))


@query(with_(ITEMS, SPINE, DAILY) + """SELECT period, c / 100.0::DOUBLE AS revenue, n AS order_count,
  (c / 100.0::DOUBLE) / nullif(CAST(n AS DOUBLE), 0) AS average_order_amount FROM spine LEFT JOIN daily USING (period)""")
def metric_average_order_amount(g):
    return _metric(g, "average_order_amount")


@query(with_(ITEMS, MARKET, MONTHLY) + """
SELECT coalesce(m.period, k.report_month) AS period, c / 100.0::DOUBLE AS revenue, total_sales AS market_total_sales,
  (c / 100.0::DOUBLE) / nullif(CAST(total_sales AS DOUBLE), 0) AS jaffle_market_share
FROM monthly m FULL JOIN market_data k ON m.period = k.report_month""")
def metric_jaffle_market_share(g):
    return _metric(g, "jaffle_market_share", grain="month")


@query(with_(MARKET) + "SELECT report_month AS period, food_sales AS market_food_sales FROM market_data")
def metric_market_food_sales(g):
    return _metric(g, "market_food_sales", grain="month")


@query(with_(MARKET) + "SELECT report_month AS period, beverage_sales AS market_beverage_sales FROM market_data")
def metric_market_beverage_sales(g):
    return _metric(g, "market_beverage_sales", grain="month")


@query(with_(MARKET) + "SELECT CAST(date_trunc('year', report_month) AS TIMESTAMP) AS period, CAST(sum(total_sales) AS BIGINT) AS market_total_sales "
       "FROM market_data GROUP BY 1")
def metric_market_total_sales(g):
    return _metric(g, "market_total_sales", grain="year")


@query(with_(ITEMS, SPINE, DIM_ORDER, """m AS (SELECT CAST(date_trunc('month', i.ordered_at) AS TIMESTAMP) AS period, d.location_name,
  sum(price_cents)::BIGINT AS c FROM items i LEFT JOIN dim_order d ON i.order_id = d.order_id GROUP BY 1, 2)""", MONTHS) + """
SELECT period, location_name, current_month, previous_month, current_month / nullif(previous_month, 0) - 1 AS mom_revenue_performance
FROM (SELECT coalesce(a.period, b.period) AS period, coalesce(a.location_name, b.location_name) AS location_name,
        a.c / 100.0::DOUBLE AS current_month, b.c / 100.0::DOUBLE AS previous_month
      FROM m a FULL JOIN (SELECT CAST(period + INTERVAL 1 MONTH AS TIMESTAMP) AS period, location_name, c FROM m) b
      ON a.period = b.period AND a.location_name IS NOT DISTINCT FROM b.location_name)
WHERE period IN (SELECT period FROM months)""")
def metric_mom_revenue_performance_by_location(g):
    return _metric(g, "mom_revenue_performance", grain="month", group_by=("location_name",))


@query(with_(ITEMS, SPINE, """d AS (SELECT ordered_at, is_food_item, sum(price_cents)::BIGINT AS c FROM items GROUP BY 1, 2)""") + """
SELECT period, CAST(coalesce(sum(c), 0) AS BIGINT) / 100.0::DOUBLE AS mtd_revenue FROM spine LEFT JOIN d
  ON ordered_at <= period AND date_trunc('month', ordered_at) = date_trunc('month', period)
WHERE period BETWEEN TIMESTAMP '1997-02-10' AND TIMESTAMP '1998-03-05' GROUP BY 1""")
def metric_mtd_revenue_between(g):
    """Month to date over a window that begins within a month."""
    return _metric(g, "mtd_revenue", start=dt.date(1997, 2, 10), end=dt.date(1998, 3, 5))


@query(with_(ITEMS) + "SELECT customer_id AS customer, sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue FROM items GROUP BY 1")
def saved_query_customer_leaderboard(g):
    from martmill.sources.sinks import publish_view

    return publish_view(jaffle.customer_leaderboard(_items(g)), "customer_leaderboard")
