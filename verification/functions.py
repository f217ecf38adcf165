"""Projections, filters and scalar functions over whole tables."""

from pyspark.sql import functions as F

from martmill.functions import columns as C
from martmill.functions.sql import register_functions
from martmill.sources.tables import scan_source
from verification import query
from verification.sqltext import BIKE_CUSTOMERS, BIKE_ORDERS, BIKE_PRODUCTS, RAW_ORDERS, with_


@query("SELECT l_orderkey AS order_id, l_shipdate AS event_date, l_quantity AS quantity FROM lineitem")
def rename_project(g):
    return C.rename_project(
        g.raw("lineitem"), {"l_orderkey": "order_id", "l_shipdate": "event_date", "l_quantity": "quantity"}
    )


@query("SELECT * EXCLUDE (o_totalprice, o_orderstatus) FROM orders")
def select_except(g):
    return C.select_except(g.raw("orders"), "o_totalprice", "o_orderstatus")


@query("SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def select_subset(g):
    return C.select_subset(g.raw("orders"), "o_orderkey", "o_orderstatus", "o_orderdate")


@query(with_(BIKE_CUSTOMERS) + "SELECT id, CASE gender WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' "
       "WHEN 'X' THEN 'Non-binary' END AS label FROM bike_customers")
def map_codes(g):
    labels = {"F": "Female", "M": "Male", "X": "Non-binary"}
    return g.bike_customers().select("id", C.map_codes("gender", labels).alias("label"))


@query("SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class FROM part")
def case_when(g):
    size = F.col("p_size")
    label = C.case_when((size < 10, "small"), (size < 30, "medium"), otherwise="large")
    return g.raw("part").select("p_partkey", label.alias("size_class"))


@query(with_(BIKE_ORDERS) + "SELECT id, concat(upper(left(order_status, 1)), lower(substr(order_status, 2))) AS order_status FROM bike_orders")
def initcap(g):
    return g.bike_orders().select("id", C.initcap("order_status").alias("order_status"))


@query(with_(BIKE_PRODUCTS) + "SELECT id, CAST(round(product_cost, 2) AS DOUBLE) AS product_cost FROM bike_products")
def round_to(g):
    return g.bike_products().select("id", C.round_to("product_cost", 2).alias("product_cost"))


@query(with_(RAW_ORDERS) + "SELECT id, order_total / 100.0::DOUBLE AS order_total FROM raw_orders")
def cents_to_dollars(g):
    return g.raw_orders().select("id", C.cents_to_dollars("order_total").alias("order_total"))


# An eighth of n cents is 25n/2 hundredths of a cent, rounded half up.
@query(with_(RAW_ORDERS) + "SELECT id, ((25 * order_total + 1) // 2) / 10000.0::DOUBLE AS share FROM raw_orders")
def cents_to_dollars_pre_cast(g):
    """An eighth of the order in cents, fractions of a cent kept to two places before the division."""
    eighth = F.col("order_total").cast("decimal(18,0)") / 8
    return g.raw_orders().select("id", C.cents_to_dollars(eighth.cast("decimal(20,3)"), "pre_cast").alias("share"))


@query("SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(0.95 AS DECIMAL(2,2)) AS DOUBLE) AS scaled FROM lineitem")
def scale_by(g):
    return g.raw("lineitem").select("l_orderkey", "l_linenumber", C.scale_by("l_extendedprice", "0.95").alias("scaled"))


@query("SELECT sku, coalesce(type = 'jaffle', false) AS is_food_item, coalesce(type = 'beverage', false) AS is_drink_item "
       "FROM (SELECT CAST(p_partkey AS VARCHAR) AS sku, CASE p_size % 3 WHEN 0 THEN 'jaffle' WHEN 1 THEN 'beverage' END AS type FROM part)")
def flag_equals(g):
    return g.raw_products().select(
        "sku",
        C.flag_equals("type", "jaffle").alias("is_food_item"),
        C.flag_equals("type", "beverage").alias("is_drink_item"),
    )


@query("SELECT o_orderkey, o_totalprice > 250000 AS large_order FROM orders")
def derived_flag(g):
    return g.raw("orders").select("o_orderkey", C.derived_flag("o_totalprice", 250000).alias("large_order"))


@query("SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events")
def trunc_day(g):
    return g.raw("events").select("event_id", C.trunc_day("ts").alias("day"))


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events")
def to_date(g):
    return g.raw("events").select("event_id", C.to_date("ts").alias("day"))


@query("""SELECT o_orderkey, CAST(d + INTERVAL 30 DAY AS TIMESTAMP) AS due, CAST(d - INTERVAL 20 YEAR AS TIMESTAMP) AS long_ago,
  CAST(d - INTERVAL 1 MONTH AS TIMESTAMP) AS month_before FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_shift(g):
    day = C.to_date("o_orderdate")
    return g.raw("orders").select(
        "o_orderkey",
        C.date_shift(day, "day", 30).alias("due"),
        C.date_shift(day, "year", -20).alias("long_ago"),
        C.date_shift(day, "month", -1).alias("month_before"),
    )


@query(f"SELECT event_id, md5(CAST(event_id AS VARCHAR) || '-' || CASE WHEN event_type = 'view' THEN '{C.NULL_KEY_TEXT}' "
       "ELSE event_type END) AS event_key FROM events")
def surrogate_key(g):
    """Event number and type; the type of views is left open."""
    kind = F.when(F.col("event_type") != "view", F.col("event_type"))
    return g.raw("events").select("event_id", C.surrogate_key(["event_id", kind]).alias("event_key"))


@query("SELECT c_custkey, concat_ws('.', c_mktsegment, CASE WHEN c_nationkey > 5 THEN c_name END) AS qualified FROM customer")
def concat_qualified(g):
    """Segment and name; the name of some nations is left open and drops out."""
    name = F.when(F.col("c_nationkey") > 5, F.col("c_name"))
    return g.raw("customer").select("c_custkey", C.concat_qualified("c_mktsegment", name).alias("qualified"))


@query("SELECT doc_id, source FROM documents WHERE lang ILIKE 'E%' AND NOT source ILIKE '%web%'")
def ilike_filter(g):
    docs = scan_source(g.spark, g.root, "documents").filter(F.col("lang").ilike("E%"))
    return C.ilike_filter(docs.select("doc_id", "source"), "source", "%", "%web%")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_custkey % 50 <> 49")
def not_null_filter(g):
    return C.not_null_filter(g.raw_customers(), "name")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_list(g):
    return g.raw("orders").filter(C.in_list("o_orderpriority", ["1-URGENT", "2-HIGH"])).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def not_in_list(g):
    return g.raw("orders").filter(C.not_in_list("o_orderpriority", ["1-URGENT", "2-HIGH"])).select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate > TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01'")
def range_filter(g):
    """Two-sided strict bounds; both reach the Parquet scan."""
    df = g.raw("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    low, high = (F.lit(day).cast("timestamp_ntz") for day in ("1997-01-01", "1998-01-01"))
    return C.range_filter(df, "l_shipdate", low, high)


@query("SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_name ELSE 'REDACTED' END AS c_name FROM customer")
def mask_column(g):
    return g.raw("customer").select("c_custkey", C.mask_column("c_name", F.col("c_nationkey") < 12).alias("c_name"))


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct(g):
    return g.raw("lineitem").select("l_partkey", "l_suppkey").distinct()


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def order_by(g):
    return g.raw("part").select("p_partkey", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_partkey")


@query("""SELECT o_orderkey, (t + 1) // 2 / 100.0::DOUBLE AS dollars, t / 200.0::DOUBLE AS pre_cast, (t + 1) // 2 / 100.0::DOUBLE AS rounded, (t + 1) // 2 / 100.0::DOUBLE AS "cast",
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE 'REDACTED' END AS priority, o_orderpriority = '1-URGENT' AS is_urgent,
  CAST(CAST(o_orderdate AS DATE) - 7 AS TIMESTAMP) AS week_before
FROM (SELECT *, 2 * CAST(round(o_totalprice * 100) AS BIGINT) + o_orderkey % 2 AS t FROM orders)""")
def sql_functions(g):
    """The helpers called from SQL; every second amount has half a cent."""
    register_functions(g.spark)
    cents = (F.col("o_totalprice") * 100 + F.col("o_orderkey") % 2 * F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,2)")
    return g.spark.sql(
        """SELECT o_orderkey, cents_to_dollars(cents) AS dollars, cents_to_dollars_pre_cast(cents) AS pre_cast, cents_to_dollars_rounded(cents) AS rounded,
        cents_to_dollars_cast(cents) AS cast, mask_column(o_orderpriority, o_orderkey % 5 = 0) AS priority, flag_equals(o_orderpriority, '1-URGENT') AS is_urgent,
        date_shift_days(to_date(o_orderdate), -7) AS week_before FROM {orders}""",
        orders=g.raw("orders").withColumn("cents", cents),
    )
