"""Checks, contracts and versions."""

from pyspark.sql import functions as F

from martmill.operators import quality as Q
from martmill.plans import bikeshop, jaffle, tpch
from verification import bikeshop as vb
from verification import jaffle as vj
from verification import query
from verification.jaffle import SEGMENT_ROWS
from verification.sqltext import BIKE, BIKE_CUSTOMERS, DIM_ORDER, ENRICHED, GEO, ITEMS, RAW_ORDERS, RFM, d2, with_


@query(with_(BIKE_CUSTOMERS) + "SELECT customer_id FROM bike_stg_customers WHERE customer_gender IS NULL")
def check_not_null(g):
    return Q.check_not_null(vb.stg_bike_shop__customers(g), "customer_gender").select("customer_id")


@query("""SELECT line_key, count(*) AS n_records FROM (SELECT l_orderkey || '-' || l_linenumber AS line_key FROM lineitem)
GROUP BY 1 HAVING count(*) > 1""")
def check_unique(g):
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return Q.check_unique(g.raw("lineitem").select(key.alias("line_key")), "line_key")


@query(with_(BIKE) + "SELECT order_product_id, product_id FROM bike_stg_order_products WHERE product_id NOT IN (SELECT id FROM bike_products)")
def check_relationships(g):
    lines = vb.stg_bike_shop__order_products(g)
    return Q.check_relationships(lines, "product_id", g.bike_products(), "id").select("order_product_id", "product_id")


@query(with_(BIKE_CUSTOMERS) + "SELECT customer_id, customer_gender FROM bike_stg_customers WHERE customer_gender NOT IN ('Male', 'Female')")
def check_accepted_values(g):
    """With one value taken off the list: its rows fail, rows without a value pass."""
    customers = vb.stg_bike_shop__customers(g)
    return Q.check_accepted_values(customers, "customer_gender", ["Male", "Female"]).select("customer_id", "customer_gender")


@query(with_(RAW_ORDERS) + "SELECT id AS order_id FROM raw_orders WHERE NOT (order_total - tax_paid - subtotal = 0 AND tax_paid > 500000)")
def check_expression(g):
    """The tax identity, and a tax of more than 5000, which most orders fail."""
    identity = "order_total - tax_paid = subtotal AND tax_paid > 5000"
    return Q.check_expression(vj.stg_orders(g), identity).select("order_id")


def _counts(checks):
    """SQL rows for declared checks, from a failure count per check."""
    rows = [
        f"SELECT '{kind}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", ({count}) AS failures"
        for kind, table, column, count in checks
    ]
    return "\nUNION ALL ".join(rows)


def _not_null(table, column, source, expr):
    return ("not_null", table, column, f"SELECT count(*) FROM {source} WHERE {expr} IS NULL")


def _unique(table, column, source, expr):
    return ("unique", table, column,
            f"SELECT count(*) FROM (SELECT {expr} FROM {source} WHERE {expr} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")


def _related(table, column, source, expr, parent, key):
    return ("relationships", table, column,
            f"SELECT count(*) FROM {source} c WHERE c.{expr} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{expr})")


def _both(table, column, source, expr):
    return [_not_null(table, column, source, expr), _unique(table, column, source, expr)]


_TPCH_STAGING = _counts([
    *_both("stg_regions", "region_id", "region", "r_regionkey"),
    _not_null("stg_regions", "region_name", "region", "r_name"),
    *_both("stg_nations", "nation_id", "nation", "n_nationkey"),
    _not_null("stg_nations", "nation_name", "nation", "n_name"),
    _not_null("stg_nations", "region_id", "nation", "n_regionkey"),
    _related("stg_nations", "region_id", "nation", "n_regionkey", "region", "r_regionkey"),
    *_both("stg_suppliers", "supplier_id", "supplier", "s_suppkey"),
    _not_null("stg_suppliers", "nation_id", "supplier", "s_nationkey"),
    _related("stg_suppliers", "nation_id", "supplier", "s_nationkey", "nation", "n_nationkey"),
    *_both("stg_customers", "customer_id", "customer", "c_custkey"),
    _not_null("stg_customers", "nation_id", "customer", "c_nationkey"),
    _related("stg_customers", "nation_id", "customer", "c_nationkey", "nation", "n_nationkey"),
    *_both("stg_parts", "part_id", "part", "p_partkey"),
    *_both("stg_orders", "order_id", "orders", "o_orderkey"),
    _not_null("stg_orders", "customer_id", "orders", "o_custkey"),
    _related("stg_orders", "customer_id", "orders", "o_custkey", "customer", "c_custkey"),
    _not_null("stg_lineitem", "order_id", "lineitem", "l_orderkey"),
    _related("stg_lineitem", "order_id", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    _not_null("stg_lineitem", "line_number", "lineitem", "l_linenumber"),
    _not_null("stg_lineitem", "event_date", "lineitem", "l_shipdate"),
    _not_null("stg_partsupp", "part_id", "lineitem", "l_partkey"),
    _related("stg_partsupp", "part_id", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)", "l_partkey", "part", "p_partkey"),
    _not_null("stg_partsupp", "supplier_id", "lineitem", "l_suppkey"),
    _related("stg_partsupp", "supplier_id", "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)", "l_suppkey", "supplier", "s_suppkey"),
])


@query(_TPCH_STAGING)
def quality_tpch_staging(g):
    tables = {
        "stg_regions": g.stage("region"),
        "stg_nations": g.stage("nation"),
        "stg_suppliers": g.stage("supplier"),
        "stg_customers": g.stage("customer"),
        "stg_parts": g.stage("part"),
        "stg_orders": g.stage("orders"),
        "stg_lineitem": g.stage("lineitem"),
        "stg_partsupp": tpch.stage(g.partsupp(), "partsupp"),
    }
    return Q.run_checks(tables, tpch.STAGING_CHECKS + tpch.PARTSUPP_CHECKS)


@query(with_(GEO, ENRICHED) + _counts([
    *_both("int_customer_geo", "customer_id", "geo", "customer_id"),
    _not_null("int_lineitem_enriched", "order_id", "enriched", "order_id"),
    _not_null("int_lineitem_enriched", "line_number", "enriched", "line_number"),
    _not_null("int_order_priorities", "order_id", "orders", "o_orderkey"),
    *_both("dim_regions", "region_id", "region", "r_regionkey"),
    *_both("dim_nations", "nation_id", "nation", "n_nationkey"),
    *_both("dim_suppliers", "supplier_id", "supplier", "s_suppkey"),
    *_both("dim_parts", "part_id", "part", "p_partkey"),
    *_both("dim_customers", "customer_id", "geo", "customer_id"),
    _not_null("fct_lineitem", "order_id", "enriched", "order_id"),
    _not_null("fct_lineitem", "line_number", "enriched", "line_number"),
    _not_null("fct_lineitem", "event_date", "enriched", "event_date"),
    *_both("fct_orders", "order_id", "orders", "o_orderkey"),
    _not_null("fct_orders", "customer_id", "orders", "o_custkey"),
]))
def quality_tpch_marts(g):
    geo, enriched = g.customer_geo(), g.lineitem_enriched()
    tables = {
        "int_customer_geo": geo,
        "int_lineitem_enriched": enriched,
        "int_order_priorities": tpch.order_priorities(g.stage("orders"), geo),
        "dim_regions": g.stage("region"),
        "dim_nations": g.stage("nation"),
        "dim_suppliers": tpch.supplier_dim(g.stage("supplier"), g.stage("nation")),
        "dim_parts": g.stage("part"),
        "dim_customers": geo,
        "fct_lineitem": enriched,
        "fct_orders": tpch.orders_fact(g.stage("orders"), geo),
    }
    return Q.run_checks(tables, tpch.MART_CHECKS)


@query(with_(BIKE_CUSTOMERS, BIKE) + _counts([
    *_both("customers", "id", "bike_customers", "id"),
    *_both("orders", "id", "bike_orders", "id"),
    _related("orders", "customer_id", "bike_orders", "customer_id", "bike_customers", "id"),
    *_both("order_products", "id", "bike_order_products", "id"),
    _related("order_products", "product_id", "bike_order_products", "product_id", "bike_products", "id"),
    _related("order_products", "order_id", "bike_order_products", "order_id", "bike_orders", "id"),
    *_both("products", "id", "bike_products", "id"),
    ("accepted_values", "stg_customers", "customer_gender",
     "SELECT count(*) FROM bike_stg_customers WHERE customer_gender NOT IN ('Male', 'Female', 'Non-binary')"),
    *_both("fct_order_products", "order_product_id", "bike_fact", "order_product_id"),
    _not_null("fct_order_products", "order_id", "bike_fact", "order_id"),
    _not_null("fct_order_products", "customer_id", "bike_fact", "customer_id"),
]))
def quality_bike_shop(g):
    tables = {
        "customers": g.bike_customers(),
        "orders": g.bike_orders(),
        "order_products": g.bike_order_products(),
        "products": g.bike_products(),
        "stg_customers": vb.stg_bike_shop__customers(g),
        "fct_order_products": vb.fct_order_products_plain(g),
    }
    return Q.run_checks(tables, bikeshop.SOURCE_CHECKS + bikeshop.MODEL_CHECKS)


@query(with_(ITEMS) + _counts([
    *_both("stg_customers", "customer_id", "customer", "c_custkey"),
    *_both("stg_locations", "location_id", "nation", "n_nationkey"),
    *_both("stg_order_items", "order_item_id", "j_items", "order_item_id"),
    _not_null("stg_order_items", "order_id", "j_items", "order_id"),
    _related("stg_order_items", "order_id", "j_items", "order_id", "j_orders", "order_id"),
    *_both("stg_orders", "order_id", "j_orders", "order_id"),
    ("expression", "stg_orders", "", "SELECT count(*) FROM raw_orders WHERE NOT order_total - tax_paid = subtotal"),
    *_both("stg_products", "product_id", "j_products", "product_id"),
    *_both("stg_supplies", "supply_uuid", "(SELECT md5(id || '-' || sku) AS u FROM raw_supplies)", "u"),
]))
def quality_jaffle_staging(g):
    tables = {
        "stg_customers": vj.stg_customers(g),
        "stg_locations": vj.stg_locations(g),
        "stg_order_items": vj.stg_order_items(g),
        "stg_orders": vj.stg_orders(g),
        "stg_products": vj.stg_products(g),
        "stg_supplies": vj.stg_supplies(g),
    }
    return Q.run_checks(tables, jaffle.STAGING_CHECKS)


_SEGMENT_COLUMNS = ("recency_days", "order_frequency", "lifetime_value", "rfm_score", "customer_segment")


def _jaffle_marts(orders, dim_order, products, customers, segments, per_segment):
    """The declared checks of the marts, counted over the named relations."""
    fact, names = "int_customer_rfm_segments", "'Champions', 'Loyal Customers', 'Potential Loyalists', 'At-Risk', 'Hibernating'"
    return _counts([
        *_both("dim_order", "order_id", dim_order, "order_id"),
        _related("fct_order_items", "order_id", "items", "order_id", orders, "order_id"),
        _related("fct_order_items", "product_id", "items", "product_id", products, "product_id"),
        _related("fct_order_items", "customer_id", "items", "customer_id", customers, "customer_id"),
        *_both(fact, "customer_id", segments, "customer_id"),
        *[_not_null(fact, c, segments, c) for c in _SEGMENT_COLUMNS],
        ("accepted_values", fact, "customer_segment", f"SELECT count(*) FROM {segments} WHERE customer_segment NOT IN ({names})"),
        *_both("fct_customer_segment_orders", "customer_segment", per_segment, "customer_segment"),
        *[_not_null("fct_customer_segment_orders", c, per_segment, c) for c in ("customer_count", "avg_lifetime_value", "avg_order_frequency", "avg_days_since_last_order")],
    ])


_CUSTOMERS = "j_customers AS (SELECT CAST(c_custkey AS VARCHAR) AS customer_id FROM customer)"
_PER_SEGMENT = f"per_segment AS ({SEGMENT_ROWS})"


def _jaffle_mart_tables(g):
    segments = vj.int_customer_rfm_segments(g)
    return {
        "dim_order": vj.dim_order(g),
        "fct_order_items": vj.fct_order_items(g),
        "stg_orders": vj.stg_orders(g),
        "stg_products": vj.stg_products(g),
        "stg_customers": vj.stg_customers(g),
        "int_customer_rfm_segments": segments,
        "fct_customer_segment_orders": jaffle.customer_segment_orders(segments, vj.dim_customer(g)),
    }


@query(with_(ITEMS, DIM_ORDER, RFM, _CUSTOMERS, _PER_SEGMENT) + _jaffle_marts("j_orders", "dim_order", "j_products", "j_customers", "segments", "per_segment"))
def quality_jaffle_marts(g):
    return Q.run_checks(_jaffle_mart_tables(g), jaffle.MART_CHECKS)


_FAULTY = """
c_orders AS (SELECT * FROM j_orders WHERE CAST(order_id AS BIGINT) % 10 <> 0),
c_products AS (SELECT * FROM j_products WHERE CAST(product_id AS BIGINT) % 7 <> 0),
c_customers AS (SELECT * FROM j_customers WHERE CAST(customer_id AS BIGINT) % 9 <> 0),
c_dim_order AS (SELECT CASE WHEN CAST(order_id AS BIGINT) % 77 <> 0 THEN order_id END AS order_id FROM dim_order
  UNION ALL SELECT order_id FROM dim_order WHERE CAST(order_id AS BIGINT) % 100 = 0),
c_once AS (SELECT CAST(customer_id AS BIGINT) AS c, CASE WHEN c % 11 <> 0 THEN customer_id END AS customer_id, CASE WHEN c % 13 <> 0 THEN recency_days END AS recency_days,
  CASE WHEN c % 14 <> 0 THEN order_frequency END AS order_frequency, CASE WHEN c % 15 <> 0 THEN lifetime_value END AS lifetime_value,
  CASE WHEN c % 16 <> 0 THEN rfm_score END AS rfm_score, CASE WHEN c % 17 = 0 THEN 'Unknown' WHEN c % 19 <> 0 THEN customer_segment END AS customer_segment FROM segments),
c_segments AS (SELECT * FROM c_once UNION ALL SELECT * FROM c_once WHERE c % 23 = 0),
c_some AS (SELECT customer_segment, CASE WHEN customer_segment <> 'Hibernating' THEN customer_count END AS customer_count, CASE WHEN customer_segment NOT IN ('At-Risk', 'Hibernating') THEN avg_lifetime_value END AS avg_lifetime_value,
  avg_order_frequency, CASE WHEN customer_segment = 'Champions' THEN avg_days_since_last_order END AS avg_days_since_last_order FROM per_segment),
c_per_segment AS (SELECT * FROM c_some UNION ALL SELECT * FROM c_some WHERE customer_segment <> 'Champions' UNION ALL SELECT NULL, 1, 1, NULL, 1)"""


@query(with_(ITEMS, DIM_ORDER, RFM, _CUSTOMERS, _PER_SEGMENT, _FAULTY) + _jaffle_marts("c_orders", "c_dim_order", "c_products", "c_customers", "c_segments", "c_per_segment"))
def quality_jaffle_marts_faulty(g):
    """The same checks over marts with repeated, missing and unknown values: nearly every check counts failures."""
    t = _jaffle_mart_tables(g)
    number = lambda c: F.col(c).cast("bigint")
    for name, column, n in (("stg_orders", "order_id", 10), ("stg_products", "product_id", 7), ("stg_customers", "customer_id", 9)):
        t[name] = t[name].filter(number(column) % n != 0)
    orders = t["dim_order"].select("order_id")
    t["dim_order"] = orders.select(F.when(number("order_id") % 77 != 0, F.col("order_id")).alias("order_id")).unionByName(orders.filter(number("order_id") % 100 == 0))
    segments = t["int_customer_rfm_segments"].withColumn("c", number("customer_id"))
    gaps = {"customer_id": 11, "recency_days": 13, "order_frequency": 14, "lifetime_value": 15, "rfm_score": 16}
    name = F.when(F.col("c") % 17 == 0, "Unknown").when(F.col("c") % 19 != 0, F.col("customer_segment"))
    once = segments.select("c", *[F.when(F.col("c") % n != 0, F.col(k)).alias(k) for k, n in gaps.items()], name.alias("customer_segment"))
    t["int_customer_rfm_segments"] = once.unionByName(once.filter("c % 23 = 0"))
    segment, rows = F.col("customer_segment"), t["fct_customer_segment_orders"]
    some = rows.select(
        "customer_segment",
        F.when(segment != "Hibernating", F.col("customer_count")).alias("customer_count"),
        F.when(~segment.isin("At-Risk", "Hibernating"), F.col("avg_lifetime_value")).alias("avg_lifetime_value"),
        "avg_order_frequency",
        F.when(segment == "Champions", F.col("avg_days_since_last_order")).alias("avg_days_since_last_order"),
    )
    unnamed = some.filter(segment == "Champions").select(
        F.lit(None).cast("string").alias("customer_segment"), "customer_count", "avg_lifetime_value", F.lit(None).cast(some.schema["avg_order_frequency"].dataType).alias("avg_order_frequency"),
        "avg_days_since_last_order")
    t["fct_customer_segment_orders"] = some.unionByName(some.filter(segment != "Champions")).unionByName(unnamed)
    return Q.run_checks(t, jaffle.MART_CHECKS)


_V1 = with_(ITEMS) + """SELECT order_item_id, order_id, product_id, customer_id, ordered_at, product_name,
  price_cents / 100.0::DOUBLE AS product_price, is_food_item, is_drink_item, cost_cents / 100.0::DOUBLE AS supply_cost FROM items"""


@query(_V1)
def enforce_contract(g):
    """Version 1 under its contract; a NULL anywhere would fail the query."""
    return jaffle.contracted_order_items(vj.fct_order_items(g))


# Half-up to whole cents: floor((2 * x + 100) / 200) with x in hundredths of a cent.
@query(with_(ITEMS) + """SELECT order_item_id, order_id, product_id, customer_id, ordered_at,
  price_cents / 100.0::DOUBLE AS product_price, is_food_item, is_drink_item,
  ((2 * cost_cents * 95 + 100) // 200) / 100.0::DOUBLE AS base_supply_cost FROM items""")
def project_version(g):
    """Version 2 under its contract, from the shared fact."""
    return jaffle.contracted_order_items(vj.fct_order_items_v2(g), version=2)


@query(f"""WITH a AS (SELECT o_orderkey, {d2('o_totalprice')} AS o_totalprice FROM orders WHERE o_orderkey % 7 <> 0),
b AS (SELECT o_orderkey, {d2('o_totalprice')} + CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders)
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, 'actual' AS side, 1::BIGINT AS times FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT o_orderkey, CAST(o_totalprice AS DOUBLE), 'expected', 1::BIGINT FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def compare_expected(g):
    """Orders against a version with rows left out and values changed: differences on both sides."""
    orders = g.raw("orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"))
    more = F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)
    changed = orders.select("o_orderkey", (F.col("o_totalprice") + more).cast("decimal(15,2)").alias("o_totalprice"))
    return Q.compare_expected(orders.filter("o_orderkey % 7 <> 0"), changed)
