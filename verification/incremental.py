"""Incremental loads: a first load, a later batch, and the table afterwards.

The orders up to the end of 1999 are the first load. The later batch holds all orders from
December 1999 on, with one more on the price, so that a month of it changes old rows.
"""

import datetime as dt

from pyspark.sql import functions as F

from martmill.operators import incremental as I
from martmill.plans import bikeshop, tpch
from martmill.session import scratch_path
from verification import bikeshop as vb
from verification import query
from verification.sqltext import BIKE, GEO, with_

OLD = """old AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(15,2)) AS order_total,
  o_orderdate AS order_date FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"""
NEW = """new AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_totalprice AS DECIMAL(15,2)) + 1 AS order_total,
  o_orderdate AS order_date FROM orders WHERE o_orderdate >= TIMESTAMP '1999-12-01')"""
_OUT = "SELECT order_id, customer_id, CAST(order_total AS DOUBLE) AS order_total, order_date"


def _place(g, label):
    """A new table's name, and a folder of its own."""
    path = scratch_path(g.spark, label)
    return f"loaded_{path.rsplit('-', 1)[1]}", path


def _stored(g, label):
    name, path = _place(g, label)
    return I.StoredTable(g.spark, name, path)


def _by_period(g, label, period, keys):
    name, path = _place(g, label)
    return I.PeriodTable(g.spark, name, period, keys, path)


def _day(text):
    return F.lit(text).cast("timestamp_ntz")


def _orders(g):
    return g.stage("orders").select("order_id", "customer_id", "order_total", "order_date")


def _old(g):
    return _orders(g).filter(F.col("order_date") < _day("2000-01-01"))


def _new(g):
    return _orders(g).filter(F.col("order_date") >= _day("1999-12-01")).withColumn(
        "order_total", (F.col("order_total") + 1).cast("decimal(15,2)")
    )


@query(with_(OLD) + _OUT + " FROM old")
def inc_full_first_run(g):
    table = _stored(g, "orders")
    I.load_incremental(table, lambda target: I.inc_anti_key(_old(g), target, "order_id"))
    return table.read()


@query(with_(OLD, NEW) + _OUT + " FROM old UNION ALL " + _OUT + " FROM new WHERE order_id NOT IN (SELECT order_id FROM old)")
def inc_anti_key(g):
    """Two stored runs; changed prices of known orders are not seen."""
    table = _stored(g, "orders")
    for batch in (_old(g), _new(g)):
        I.load_incremental(table, lambda target: I.inc_anti_key(batch, target, "order_id"))
    return table.read()


_AFTER = (" FROM old WHERE order_id NOT IN (SELECT order_id FROM taken) UNION ALL " + _OUT + " FROM taken")


@query(with_(OLD, NEW, "taken AS (SELECT * FROM new WHERE order_date > (SELECT max(order_date) FROM old))") + _OUT + _AFTER)
def inc_watermark_strict(g):
    target = _old(g)
    return I.upsert_merge(target, I.inc_watermark_strict(_new(g), target, "order_date"), "order_id")


@query(with_(OLD, NEW, "taken AS (SELECT * FROM new WHERE order_date >= (SELECT max(order_date) FROM old))") + _OUT + _AFTER)
def inc_watermark_inclusive(g):
    """Two stored runs: the last day of the first one is loaded again, with its new prices."""
    table = _by_period(g, "orders", "month", ["order_id"])
    for batch in (_old(g), _new(g)):
        rows = I.inc_watermark_inclusive(batch, table.last_period(), "order_date")
        table.upsert(rows.withColumn("month", F.trunc("order_date", "month")))
    return table.read().drop("month")


@query(with_(GEO) + """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
  o_totalprice AS order_total, o_orderdate AS order_date, o_orderpriority AS order_priority, region_name, market_segment
FROM orders LEFT JOIN geo ON o_custkey = customer_id""")
def fct_orders_incremental(g):
    """The order fact built in two runs equals the fact built in one."""
    table = _by_period(g, "fct-orders", "order_month", ["order_id"])
    orders, geo = g.stage("orders"), g.customer_geo()
    early = orders.filter(F.col("order_date") < _day("1998-06-01"))
    for known in (early, orders):
        tpch.run_orders_fact(table, known, geo)
    return table.read().drop("order_month")


def _two_runs(g, site, table):
    lines = vb.stg_bike_shop__order_products(g)
    early = lines.filter(F.col("loaded_at") < _day("1999-06-01"))
    products, orders = vb.stg_bike_shop__products(g), vb.stg_bike_shop__orders(g)
    for known in (early, lines):
        out = bikeshop.run_fct_order_products(table, known, products, orders, site)
    return out


_BIKE_MONEY = "CAST(product_price AS DOUBLE) AS product_price, CAST(product_cost AS DOUBLE) AS product_cost"


@query(with_(BIKE) + f"SELECT * EXCLUDE (loaded_at) REPLACE ({_BIKE_MONEY}) FROM bike_fact")
def fct_order_products_incremental_anti_key(g):
    return _two_runs(g, bikeshop.PLAIN, _stored(g, "fct-order-products"))


@query(with_(BIKE) + f"SELECT * REPLACE ({_BIKE_MONEY}) FROM bike_fact")
def fct_order_products_incremental_watermark(g):
    return _two_runs(g, bikeshop.MERGING, _by_period(g, "fct-order-products", "loaded_month", ["order_product_id"]))


@query(with_(OLD, NEW) + _OUT + " FROM old WHERE order_id NOT IN (SELECT order_id FROM new) UNION ALL " + _OUT + " FROM new")
def upsert_merge(g):
    """Every new row arrives twice, the second time with the price that counts."""
    twice = _new(g).withColumn("_version", F.lit(2)).unionByName(
        _new(g).withColumn("order_total", F.lit(0).cast("decimal(15,2)")).withColumn("_version", F.lit(1))
    )
    target = _old(g).withColumn("_version", F.lit(0))
    return I.upsert_merge(target, twice, "order_id", order=["_version"]).drop("_version")


@query(with_(OLD, NEW) + _OUT + " FROM old WHERE order_id NOT IN (SELECT order_id FROM new) UNION ALL " + _OUT + " FROM new")
def upsert_by_day(g):
    """The same on a table partitioned by month, of which only the touched months are rewritten."""
    table = _by_period(g, "by-month", "month", ["order_id"])
    month = F.trunc("order_date", "month")
    table.create(_old(g).withColumn("month", month))
    table.upsert(_new(g).withColumn("month", month))
    return table.read().drop("month")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem l WHERE l_shipdate < TIMESTAMP '1999-01-01'
  AND NOT EXISTS (SELECT 1 FROM lineitem n WHERE n.l_shipdate >= TIMESTAMP '1999-01-01' AND n.l_orderkey = l.l_orderkey AND n.l_linenumber = l.l_linenumber)
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'""")
def upsert_delete_insert(g):
    lines = g.raw("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    border = _day("1999-01-01")
    return I.upsert_delete_insert(
        lines.filter(F.col("l_shipdate") < border), lines.filter(F.col("l_shipdate") >= border), ["l_orderkey", "l_linenumber"]
    )


@query(with_(OLD, NEW) + "SELECT order_id, CAST(order_total AS DOUBLE) AS order_total, 1 AS batch FROM old "
       "UNION ALL SELECT order_id, CAST(order_total AS DOUBLE) AS order_total, 2 AS batch FROM new")
def append_only(g):
    """The second batch is appended twice, as after a failed try, and counts once."""
    cols = ["order_id", "order_total"]
    table = _old(g).select(*cols).withColumn("batch", F.lit(1))
    for _ in range(2):
        table = I.append_only(table, _new(g).select(*cols), "batch", 2)
    return table


_HALF_YEAR = "l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-07-01'"


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN {_HALF_YEAR} THEN l_quantity + 1 ELSE l_quantity END AS quantity,
  l_shipdate AS event_date FROM lineitem WHERE NOT (l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01')""")
def microbatch_replace(g):
    """Half a year of stored ship months replaced; March is empty in the new batch."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = g.raw("lineitem").select(
        *keys,
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("event_date"),
        F.trunc("l_shipdate", "month").alias("month"),
    )
    table = _by_period(g, "microbatch", "month", keys)
    table.create(lines)
    batch = lines.filter("month <> DATE '1997-03-01'").withColumn("quantity", (F.col("quantity") + 1).cast("decimal(15,2)"))
    table.replace(batch, dt.date(1997, 1, 1), dt.date(1997, 7, 1))
    return table.read().drop("month")


@query(f"""SELECT l_orderkey, l_linenumber, CASE WHEN {_HALF_YEAR} THEN l_quantity + 1 ELSE l_quantity END AS quantity,
  l_shipdate AS event_date FROM lineitem WHERE NOT (l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-03-08')""")
def microbatch_replace_days(g):
    """The same as a plan over two tables, by days; the first week of March is empty in the new batch."""
    lines = g.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"), F.col("l_shipdate").alias("event_date")
    )
    week = F.to_date("event_date").between(dt.date(1997, 3, 1), dt.date(1997, 3, 7))
    batch = lines.filter(~week).withColumn("quantity", (F.col("quantity") + 1).cast("decimal(15,2)"))
    return I.microbatch_replace(lines, batch, "event_date", dt.date(1997, 1, 1), dt.date(1997, 7, 1))


@query(with_(OLD, NEW) + "SELECT order_id, customer_id, CAST(NULL AS DOUBLE) AS order_total FROM old "
       "UNION ALL SELECT order_id, NULL, CAST(order_total AS DOUBLE) FROM new")
def append_new_columns(g):
    """The target lacks the total, the delta the customer."""
    return I.append_new_columns(_old(g).select("order_id", "customer_id"), _new(g).select("order_id", "order_total"))


@query("""SELECT o_orderkey AS order_id, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderstatus END AS order_status,
  CAST(o_totalprice AS DOUBLE) + CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS order_total FROM orders""")
def append_new_columns_by_period(g):
    """Three loads, of which the middle one has a column more; the last rewrites months of the first."""
    orders = g.stage("orders").select("order_id", "order_status", "order_total", "order_date").withColumn("month", F.trunc("order_date", "month"))
    table = _by_period(g, "evolving", "month", ["order_id"])
    first, second = F.col("order_date") < _day("1996-01-01"), F.col("order_date") < _day("1998-01-01")
    table.upsert(orders.filter(first).drop("order_status"))
    table.upsert(orders.filter(~first & second))
    changed = orders.filter(first & (F.col("order_id") % 2 == 0)).withColumn("order_total", (F.col("order_total") + 1).cast("decimal(15,2)"))
    table.upsert(orders.filter(~second).unionByName(changed).drop("order_status"))
    return table.read().select("order_id", "order_status", "order_total")


@query(with_(OLD, NEW) + """SELECT CASE WHEN order_id % 3 > 0 THEN order_id END AS order_id, CAST(order_total AS DOUBLE) AS order_total FROM old
  WHERE order_id % 3 = 0 OR order_id NOT IN (SELECT order_id FROM new WHERE order_id % 3 > 0)
UNION ALL SELECT CASE WHEN order_id % 3 > 0 THEN order_id END, CAST(order_total AS DOUBLE) FROM new""")
def upsert_merge_null_keys(g):
    """A third of the rows has no key: none is merged or lost."""
    key = F.when(F.col("order_id") % 3 > 0, F.col("order_id"))
    old, new = (df.select(key.alias("order_id"), "order_total", F.trunc("order_date", "month").alias("month")) for df in (_old(g), _new(g)))
    periods = _by_period(g, "null-keys", "month", ["order_id"])
    for batch in (old, new):
        periods.upsert(batch)
    return periods.read().select("order_id", "order_total")


@query(with_(OLD, NEW) + "SELECT order_id, CAST(order_total AS DOUBLE) AS order_total, 'stored' AS kind FROM new WHERE false "
       "UNION ALL SELECT order_id, CAST(order_total AS DOUBLE), 'never loaded' FROM new")
def inc_watermark_strict_empty(g):
    """A strict mark on an emptied table, of either kind, lets nothing pass; a table never loaded takes everything."""
    batch = _new(g).withColumn("month", F.trunc("order_date", "month"))
    stored = _stored(g, "emptied")
    stored.append(batch.limit(0))
    periods = _by_period(g, "emptied", "month", ["order_id"])
    before = periods.last_period()
    fresh = I.inc_watermark_strict(batch, before, "order_date").withColumn("kind", F.lit("never loaded"))
    periods.create(batch)
    periods.replace(batch.limit(0), dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    for target in (stored.read(), periods.last_period()):
        fresh = fresh.unionByName(I.inc_watermark_strict(batch, target, "order_date").withColumn("kind", F.lit("stored")))
    return fresh.select("order_id", "order_total", "kind")
