"""Join and aggregation shapes."""

from pyspark.sql import functions as F

from martmill.functions.columns import trunc_month
from martmill.operators import aggregates as A
from martmill.operators import joins as J
from martmill.plans import jaffle, tpch
from verification import query
from verification.jaffle import SEGMENT_ORDERS, dim_customer, fact_inputs, int_customer_rfm_segments, stg_orders
from verification.sqltext import (
    BIKE, DIM_ORDER, ENRICHED, GEO, ITEMS, MARKET, RAW_ORDERS, RAW_SUPPLIES, SPINE, d2, dbl, with_,
)


@query(with_(GEO) + "SELECT customer_id, nation_name, region_name FROM geo")
def join_star_inner(g):
    return g.customer_geo().select("customer_id", "nation_name", "region_name")


@query("SELECT s_suppkey AS supplier_id, n_name AS nation_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def join_dim_inner(g):
    return J.join_inner(g.stage("supplier"), (g.stage("nation"), "nation_id")).select("supplier_id", "nation_name")


@query(with_(ENRICHED) + "SELECT order_id, line_number, customer_id, order_date, market_segment FROM enriched")
def join_fact_chain_inner(g):
    return g.lineitem_enriched().select("order_id", "line_number", "customer_id", "order_date", "market_segment")


@query(with_(RAW_ORDERS, DIM_ORDER) + "SELECT order_id, location_name FROM dim_order")
def join_location_inner(g):
    """A third of the store numbers beyond the last store: these orders drop out."""
    return jaffle.dim_order(stg_orders(g), jaffle.stg_locations(g.raw_stores())).select("order_id", "location_name")


@query(with_(GEO) + "SELECT o_orderkey AS order_id, region_name FROM orders LEFT JOIN geo ON o_custkey = customer_id")
def join_enrich_left(g):
    return tpch.order_priorities(g.stage("orders"), g.customer_geo()).select("order_id", "region_name")


@query(with_(BIKE) + "SELECT order_product_id, customer_id, CAST(product_price AS DOUBLE) AS product_price FROM bike_fact")
def join_multi_left(g):
    from verification.bikeshop import fct_order_products_plain

    return fct_order_products_plain(g).select("order_product_id", "customer_id", "product_price")


@query(with_(ITEMS) + "SELECT order_item_id, cost_cents / 100.0::DOUBLE AS supply_cost FROM items")
def join_left_preagg(g):
    items, _, _, supplies = fact_inputs(g)
    return J.join_left_preagg(items, supplies, "product_id", [F.sum("supply_cost").alias("supply_cost")]).select(
        "order_item_id", "supply_cost"
    )


@query("""WITH o AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT c_custkey AS customer_id, coalesce(n, 0) AS urgent_orders FROM customer LEFT JOIN o ON c_custkey = o_custkey""")
def join_left_preagg_default(g):
    """Urgent orders per customer, zero where there is none."""
    urgent = g.stage("orders").filter("order_priority = '1-URGENT'")
    counted = [F.count(F.lit(1)).alias("urgent_orders")]
    customers = g.stage("customer").select("customer_id")
    return J.join_left_preagg(customers, urgent, "customer_id", counted, defaults={"urgent_orders": 0})


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders")
def join_unused_side(g):
    return J.join_unused_side(g.stage("orders").select("order_id", "customer_id"), g.stage("customer"), "customer_id")


@query("""SELECT l_orderkey, l_linenumber, n.n FROM lineitem l LEFT JOIN (
  SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2) n
  ON l.l_partkey = n.l_partkey AND l.l_suppkey = n.l_suppkey""")
def join_multi_key_left(g):
    """Order lines with the returns of the same part and supplier."""
    lines = g.raw("lineitem")
    returns = lines.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    return J.join_left(lines, (returns, ["l_partkey", "l_suppkey"])).select("l_orderkey", "l_linenumber", "n")


@query("SELECT c_custkey AS customer_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def anti_null_aware(g):
    """NOT IN without a broadcast of the target."""
    target = g.stage("orders").filter("order_total > 400000")
    return J.anti_key(g.stage("customer").select("customer_id"), target, "customer_id", null_blocks=True)


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)")
def anti_orphans(g):
    large = g.raw("part").filter("p_size > 10")
    return J.anti_orphans(g.raw("lineitem"), "l_partkey", large, "p_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10)")
def semi_members(g):
    large = g.raw("part").filter("p_size > 10")
    return J.semi_members(g.raw("lineitem"), "l_partkey", large, "p_partkey").select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate > (SELECT max(o_orderdate) FROM orders)")
def filter_scalar_subquery(g):
    lines = g.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return J.filter_above_max(lines, "l_shipdate", g.raw("orders"), "o_orderdate")


@query(with_(SPINE) + """SELECT period AS date_day, count(o_orderkey) AS orders FROM spine
LEFT JOIN orders ON o_orderdate = period AND o_totalprice > 450000 GROUP BY 1""")
def join_spine_left(g):
    """Days with their number of large orders; most of them NULL before the fill."""
    large = g.raw("orders").filter("o_totalprice > 450000")
    daily = large.groupBy(F.to_date("o_orderdate").alias("date_day")).agg(F.count(F.lit(1)).alias("orders"))
    return J.join_on_spine(g.order_days(), daily, "date_day").withColumn("orders", F.coalesce("orders", F.lit(0)))


@query(with_(MARKET, "o AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS report_month, count(*) AS orders FROM orders GROUP BY 1)")
       + "SELECT report_month, orders, total_sales FROM o FULL JOIN market_data USING (report_month)")
def join_metrics_full(g):
    """Monthly orders beside market totals, which start and end two months later."""
    ours = g.raw("orders").groupBy(trunc_month("o_orderdate").alias("report_month")).agg(F.count(F.lit(1)).alias("orders"))
    return J.join_full(ours, g.market_data().select("report_month", "total_sales"), "report_month")


@query(f"SELECT o_orderpriority AS order_priority, o_orderstatus AS order_status, count(*) AS order_count, "
       f"{dbl('sum(' + d2('o_totalprice') + ')')} AS revenue_total FROM orders GROUP BY 1, 2")
def agg_count_sum(g):
    return A.count_and_sum(
        g.stage("orders"), ["order_priority", "order_status"], "order_total", "revenue_total", "order_count"
    )


@query(f"SELECT o_custkey AS customer_id, count(*) AS order_count, {dbl('sum(' + d2('o_totalprice') + ')')} AS revenue_total "
       "FROM orders GROUP BY 1")
def agg_sum_per_key(g):
    return A.count_and_sum(g.stage("orders"), ["customer_id"], "order_total", "revenue_total", "order_count")


@query(f"SELECT l_shipdate AS event_date, CAST(sum({d2('l_extendedprice')} * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS net_revenue, "
       f"CAST(sum({d2('l_quantity')}) AS DOUBLE) AS units_sold FROM lineitem GROUP BY 1")
def agg_sum_expr(g):
    net = F.col("extended_price") * (F.lit(1) - F.col("discount"))
    return A.sum_expr(g.stage("lineitem"), ["event_date"], net_revenue=net, units_sold="quantity")


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS order_count FROM lineitem GROUP BY 1")
def agg_count_distinct(g):
    return A.count_distinct(g.raw("lineitem"), ["l_partkey"], "l_orderkey", "order_count")


@query("""SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE 0 END) AS DOUBLE) AS returned,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(15,2)) ELSE 0 END) AS DOUBLE) AS open
FROM lineitem GROUP BY 1""")
def agg_conditional_sum(g):
    price = F.col("l_extendedprice")
    return g.raw("lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(
        A.conditional_sum(F.col("l_returnflag") == "R", price).alias("returned"),
        A.conditional_sum(F.col("l_linestatus") == "O", price).alias("open"),
    )


# Half-up in whole cents: floor((2 * sum + n) / (2 * n)).
@query("""SELECT o_orderpriority, CAST((2 * sum(c) + count(*)) // (2 * count(*)) AS BIGINT) / 100.0::DOUBLE AS avg_total
FROM (SELECT o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders) GROUP BY 1""")
def agg_avg_rounded(g):
    return g.raw("orders").groupBy("o_orderpriority").agg(A.avg_rounded("o_totalprice", 2).alias("avg_total"))


@query(with_(RAW_SUPPLIES) + "SELECT sku AS product_id, CAST(sum(cost) * 95 AS BIGINT) / 10000.0::DOUBLE AS supply_cost FROM raw_supplies GROUP BY 1")
def agg_preagg_cost(g):
    return jaffle.supply_summary(fact_inputs(g)[3], "0.95")


@query("SELECT max(o_orderdate) AS last_order FROM orders")
def agg_global_max(g):
    return A.global_max(g.raw("orders"), "o_orderdate", "last_order")


@query("SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1")
def agg_max_per_key(g):
    return A.max_per_key(g.raw("orders"), "o_custkey", "o_orderdate", "last_order")


@query("""WITH one AS (SELECT l_partkey, l_returnflag AS k, max(l_linestatus) AS v FROM lineitem GROUP BY 1, 2)
SELECT l_partkey, '{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}' AS tags FROM one GROUP BY 1""")
def agg_to_map(g):
    return A.pairs_to_map(g.raw("lineitem"), ["l_partkey"], "l_returnflag", "l_linestatus", "tags")


@query(SEGMENT_ORDERS)
def segment_summary(g):
    return jaffle.customer_segment_orders(int_customer_rfm_segments(g), dim_customer(g))
