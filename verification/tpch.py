"""The order-line warehouse models."""

from martmill.plans import tpch
from verification import query
from verification.sqltext import ENRICHED, GEO, d2, dbl, with_


@query("SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, "
       "c_acctbal AS account_balance, c_mktsegment AS market_segment FROM customer")
def stg_tpch__customers(g):
    return g.stage("customer")


@query("SELECT l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id, l_linenumber AS line_number, "
       "l_quantity AS quantity, l_extendedprice AS extended_price, l_discount AS discount, l_tax AS tax, "
       "l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS event_date FROM lineitem")
def stg_tpch__lineitem(g):
    return g.stage("lineitem")


@query("SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey AS region_id FROM nation")
def stg_tpch__nations(g):
    return g.stage("nation")


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status, "
       "o_totalprice AS order_total, o_orderdate AS order_date, o_orderpriority AS order_priority FROM orders")
def stg_tpch__orders(g):
    return g.stage("orders")


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, p_type AS part_type, p_size AS part_size, "
       "p_retailprice AS retail_price FROM part")
def stg_tpch__parts(g):
    return g.stage("part")


@query(f"SELECT l_partkey AS part_id, l_suppkey AS supplier_id, CAST(sum({d2('l_quantity')}) AS BIGINT) AS available_quantity, "
       "max(l_extendedprice) AS supply_cost FROM lineitem GROUP BY 1, 2")
def stg_tpch__partsupp(g):
    return tpch.stage(g.partsupp(), "partsupp")


@query("SELECT r_regionkey AS region_id, r_name AS region_name FROM region")
def stg_tpch__regions(g):
    return g.stage("region")


@query("SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation_id, "
       "s_acctbal AS account_balance FROM supplier")
def stg_tpch__suppliers(g):
    return g.stage("supplier")


@query(with_(GEO) + "SELECT * FROM geo")
def int_customer_geo(g):
    return g.customer_geo()


@query(with_(ENRICHED) + "SELECT * FROM enriched")
def int_lineitem_enriched(g):
    return g.lineitem_enriched()


PRIORITIES = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
  o_totalprice AS order_total, o_orderdate AS order_date, o_orderpriority AS order_priority, region_name, market_segment
FROM orders LEFT JOIN geo ON o_custkey = customer_id"""


@query(with_(GEO) + PRIORITIES)
def int_order_priorities(g):
    return tpch.order_priorities(g.stage("orders"), g.customer_geo())


SUMMARY = with_(GEO, f"p AS ({PRIORITIES})") + f"""
SELECT region_name, market_segment, order_priority, count(*) AS order_count,
  {dbl('sum(' + d2('order_total') + ')')} AS revenue_total FROM p GROUP BY 1, 2, 3"""


@query(SUMMARY)
def int_order_priorities_summary(g):
    return tpch.order_priorities_summary(g.stage("orders"), g.customer_geo())


@query(SUMMARY)
def agg_order_priority_breakdown(g):
    return int_order_priorities_summary(g)


CUSTOMER_REVENUE = with_(GEO, f"o AS (SELECT o_custkey, sum({d2('o_totalprice')}) AS t, count(*) AS n FROM orders GROUP BY 1)") + """
SELECT customer_id, customer_name, region_name, market_segment, CAST(coalesce(t, 0) AS DOUBLE) AS revenue_total,
  coalesce(n, 0) AS order_count FROM geo LEFT JOIN o ON customer_id = o_custkey"""


@query(CUSTOMER_REVENUE)
def agg_customer_revenue(g):
    return tpch.customer_revenue(g.stage("orders"), g.customer_geo())


DAILY_SALES = with_(ENRICHED) + f"""
SELECT event_date, market_segment,
  CAST(sum({d2('extended_price')} * (1 - CAST(discount AS DECIMAL(4,2)))) AS DOUBLE) AS net_revenue,
  CAST(sum({d2('quantity')}) AS DOUBLE) AS units_sold, count(DISTINCT order_id) AS order_count
FROM enriched GROUP BY 1, 2"""


@query(DAILY_SALES)
def agg_daily_sales(g):
    return tpch.daily_sales(g.lineitem_enriched())


@query(with_(GEO) + "SELECT * FROM geo")
def dim_customers(g):
    return g.customer_geo()


@query("SELECT n_nationkey AS nation_id, n_name AS nation_name, n_regionkey AS region_id FROM nation")
def dim_nations(g):
    return g.stage("nation")


@query("SELECT p_partkey AS part_id, p_name AS part_name, p_brand AS brand, p_type AS part_type, p_size AS part_size, "
       "p_retailprice AS retail_price FROM part")
def dim_parts(g):
    return g.stage("part")


@query("SELECT r_regionkey AS region_id, r_name AS region_name FROM region")
def dim_regions(g):
    return g.stage("region")


@query("SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS account_balance, n_name AS nation_name "
       "FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def dim_suppliers(g):
    return tpch.supplier_dim(g.stage("supplier"), g.stage("nation"))


@query(with_(ENRICHED) + "SELECT * FROM enriched")
def fct_lineitem(g):
    return g.lineitem_enriched()


@query(with_(GEO) + PRIORITIES)
def fct_orders(g):
    return tpch.orders_fact(g.stage("orders"), g.customer_geo())
