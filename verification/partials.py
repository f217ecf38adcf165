"""Marts kept current by deltas, and metrics of many groupings from one scan."""

from pyspark.sql import functions as F

from martmill.operators import metrics as M
from martmill.operators import partials as P
from martmill.operators import ranking as R
from martmill.plans import jaffle, tpch
from martmill.session import materialise, scratch_path
from verification import query
from verification.jaffle import dim_order, fct_order_items, fct_order_items_v2
from verification.sqltext import DIM_ORDER, ITEMS, RFM, with_
from verification.tpch import CUSTOMER_REVENUE, DAILY_SALES


def _from_deltas(g, rollup, rows, number):
    """Three deltas that touch the same groups, the second one loaded twice, as after a failed try."""
    path, rows = scratch_path(g.spark, "parts"), materialise(rows, "delta-rows")
    for batch in (1, 2, 2, 3):
        P.apply_delta(g.spark, path, rollup, rows.filter(number % 3 == batch - 1), batch, slots=8)
    return rollup.finished(P.stored_parts(g.spark, path))


@query(DAILY_SALES)
def agg_daily_sales_deltas(g):
    """A day's orders arrive in all three deltas; distinct orders are counted over all of them."""
    return _from_deltas(g, tpch.DAILY_SALES, g.lineitem_enriched(), F.col("line_number"))


@query(CUSTOMER_REVENUE)
def agg_customer_revenue_deltas(g):
    totals = _from_deltas(g, tpch.CUSTOMER_TOTALS, g.stage("orders"), F.col("order_id"))
    return tpch.customer_revenue_of(totals, g.customer_geo())


@query(with_(ITEMS, RFM) + "SELECT customer_id, recency_days, order_frequency, value_cents / 100.0::DOUBLE AS lifetime_value FROM rfm")
def rfm_metrics_deltas(g):
    """Order numbers are texts here, so the sets hold them one by one."""
    items = fct_order_items_v2(g)
    return R.rfm_of(_from_deltas(g, jaffle.CUSTOMER_ITEMS, items, F.abs(F.xxhash64("order_item_id"))))


_SETS = {"day": ("day", ()), "month": ("month", ()), "location": (None, ("location_name",)), "month and location": ("month", ("location_name",)), "all": (None, ())}
_FIGURES = """sum(price_cents)::BIGINT / 100.0::DOUBLE AS revenue, count(DISTINCT order_id) AS order_count,
  (sum(price_cents)::BIGINT / 100.0::DOUBLE) / count(DISTINCT order_id) AS average_order_amount FROM cube_rows"""
_MONTH = "CAST(date_trunc('month', ordered_at) AS TIMESTAMP)"
_NONE, _ANYWHERE = "CAST(NULL AS TIMESTAMP)", "CAST(NULL AS VARCHAR)"


@query(with_(ITEMS, DIM_ORDER, "cube_rows AS (SELECT i.*, d.location_name FROM items i LEFT JOIN dim_order d ON i.order_id = d.order_id)") + f"""
SELECT 'day' AS "grouping", ordered_at AS period, {_ANYWHERE} AS location_name, {_FIGURES} GROUP BY ordered_at
UNION ALL SELECT 'month', {_MONTH}, {_ANYWHERE}, {_FIGURES} GROUP BY 2
UNION ALL SELECT 'location', {_NONE}, location_name, {_FIGURES} GROUP BY 3
UNION ALL SELECT 'month and location', {_MONTH}, location_name, {_FIGURES} GROUP BY 2, 3
UNION ALL SELECT 'all', {_NONE}, {_ANYWHERE}, {_FIGURES}""")
def metric_cube(g):
    """Revenue, orders and the average order by day, month and location, from one scan of the order items."""
    items = jaffle.order_item_model(fct_order_items(g), dim_order(g))
    figures = M.cube(items, {"revenue": "order_item_revenue", "order_count": "order_count"}, _SETS)
    return M.ratio(figures, "revenue", "order_count", "average_order_amount")
