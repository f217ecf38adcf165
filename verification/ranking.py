"""Ranks, scores, calendars and set operations."""


from pyspark.sql import functions as F

from martmill.functions import calendar as K
from martmill.operators import metrics as M
from martmill.operators import ranking as R
from martmill.operators import setops as S
from verification import query
from verification.jaffle import fct_order_items_v2
from verification.sqltext import ITEMS, RFM, SPINE, d2, with_


@query("SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_nationkey, c_custkey) AS BIGINT) AS rank FROM customer")
def rank_first(g):
    """Customers by nation: a few values, each shared by very many rows."""
    return R.rank_first(g.raw("customer").select("c_custkey", "c_nationkey"), "c_nationkey", "c_custkey").select(
        "c_custkey", "rank"
    )


@query("""SELECT c_custkey, CAST(6 - greatest(1, ceil((r - 1) * 5.0 / (n - 1))) AS INTEGER) AS bucket FROM (
  SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS r, count(*) OVER () AS n FROM customer)""")
def quantile_bucket(g):
    customers = g.raw("customer").select("c_custkey", "c_acctbal")
    return R.quantile_bucket(customers, "c_acctbal", "c_custkey", "bucket", ascending=False).select("c_custkey", "bucket")


@query(with_(ITEMS, RFM) + "SELECT customer_id, recency_days, order_frequency, value_cents / 100.0::DOUBLE AS lifetime_value FROM rfm")
def rfm_metrics(g):
    return R.rfm_metrics(fct_order_items_v2(g))


@query(with_(ITEMS, RFM) + "SELECT customer_id, rfm_score, customer_segment FROM segments")
def rfm_segments(g):
    return R.rfm_segments(R.rfm_metrics(fct_order_items_v2(g))).select("customer_id", "rfm_score", "customer_segment")


@query(with_(SPINE) + "SELECT period AS date_day FROM spine")
def date_spine(g):
    """All days from the first to the last order."""
    return g.order_days()


@query(with_(SPINE) + """SELECT period AS date_day FROM spine
WHERE period > (SELECT max(period) - INTERVAL 3 YEAR FROM spine) AND period < (SELECT max(period) - INTERVAL 10 DAY FROM spine)""")
def time_spine_window(g):
    days = g.order_days()
    return K.time_spine_window(days, days.agg(F.max("date_day")).scalar(), years_back=3, days_ahead=-10)


@query("SELECT o_orderkey, strftime(o_orderdate, '%m-%d') IN ('01-26', '04-25', '12-25') AS is_holiday FROM orders")
def holiday_flag(g):
    orders = g.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return K.holiday_flag(orders, "day", g.holidays()).select("o_orderkey", "is_holiday")


@query(with_(SPINE, f"d AS (SELECT o_orderpriority, o_orderdate, sum({d2('o_totalprice')}) AS v FROM orders GROUP BY 1, 2)",
             "p AS (SELECT DISTINCT o_orderpriority FROM orders)") + """
SELECT period, p.o_orderpriority, CAST(sum(v) AS DOUBLE) AS mtd_total
FROM spine, p, d WHERE d.o_orderpriority = p.o_orderpriority AND o_orderdate <= period
  AND date_trunc('month', o_orderdate) = date_trunc('month', period) GROUP BY 1, 2""")
def to_date_cumulative(g):
    """Month-to-date order value per priority."""
    day = F.to_date("o_orderdate").alias(M.PERIOD)
    daily = g.raw("orders").groupBy("o_orderpriority", day).agg(F.sum("o_totalprice").alias("v"))
    return M.to_date_cumulative(daily, "v", g.order_days(), "mtd_total", "month", ["o_orderpriority"])


@query("""SELECT o_custkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS period, count(*) AS orders_before
FROM orders GROUP BY 1, 2""")
def period_offset(g):
    """Orders per customer, shown in the month after."""
    month = F.trunc("o_orderdate", "month").alias(M.PERIOD)
    monthly = g.raw("orders").groupBy("o_custkey", month).agg(F.count(F.lit(1)).alias("orders"))
    return M.period_offset(monthly, 1, "month", {"orders": "orders_before"})


@query("SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def set_minus(g):
    lines = g.raw("lineitem")
    return S.set_minus(lines.filter("l_returnflag = 'N'"), lines.filter("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


@query("""WITH w AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'),
  h AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
SELECT 'add' AS action, * FROM (SELECT * FROM w EXCEPT SELECT * FROM h)
UNION ALL SELECT 'remove', * FROM (SELECT * FROM h EXCEPT SELECT * FROM w)""")
def set_reconcile(g):
    lines = g.raw("lineitem")
    return S.set_reconcile(
        lines.filter("l_returnflag = 'N'"), lines.filter("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"], "add", "remove"
    )


@query("""SELECT DISTINCT schema_name, unnest(roles) AS role FROM (
  SELECT 'nation_' || c_nationkey AS schema_name, [lower(c_mktsegment), 'team_' || (c_custkey % 11)] AS roles
  FROM customer WHERE c_custkey % 9 <> 0)""")
def merge_lists_unique(g):
    return S.merge_lists_unique(g.desired_grants(), "schema_name", "roles", "role")


