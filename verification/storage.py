"""Sources and sinks: whole tables written to the shared folder and read back."""

from martmill.operators.incremental import append_new_columns
from martmill.session import scratch_path
from martmill.sources import sinks
from martmill.sources import tables as T
from verification import query
from verification.sqltext import ENRICHED, with_


@query("SELECT * FROM lineitem")
def scan_source(g):
    return T.scan_source(g.spark, g.root, "lineitem")


_PART_CSV = "SELECT p_partkey AS id, p_name AS model, p_retailprice AS price FROM part"


@query(_PART_CSV)
def load_seed_csv(g):
    path = scratch_path(g.spark, "seed")
    parts = g.raw("part").selectExpr("p_partkey AS id", "p_name AS model", "p_retailprice AS price")
    sinks.export_csv(parts, path)
    return T.load_seed_csv(g.spark, path, "id bigint, model string, price decimal(15,2)")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def export_csv(g):
    path = scratch_path(g.spark, "csv")
    sinks.export_csv(g.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path, delimiter="|")
    schema = "o_orderkey bigint, o_orderstatus string, o_totalprice decimal(15,2)"
    return g.spark.read.schema(schema).option("header", True).option("sep", "|").csv(path)


@query("SELECT * FROM orders")
def publish_view(g):
    return sinks.publish_view(g.raw("orders"), "published_orders")


@query(with_(ENRICHED) + "SELECT * FROM enriched")
def publish_table(g):
    """Order lines along a curve through ship day and customer, built twice: readers see the second build."""
    path = scratch_path(g.spark, "table")
    name = "published_" + path.rsplit("-", 1)[1]
    lines = g.lineitem_enriched()
    for build in (lines.limit(0), lines):
        out = sinks.publish_table(build, name, path, spread=["order_id", "line_number"], cluster=["event_date", "customer_id"])
    return out


@query("SELECT * FROM orders")
def clone_schema(g):
    """An empty copy that then takes every row of its model."""
    orders = g.raw("orders")
    return append_new_columns(sinks.clone_schema(g.spark, orders), orders)


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000")
def preview(g):
    from pyspark.sql import functions as F

    orders = g.raw("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sinks.preview(orders, 1000, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(g):
    return sinks.row_count(g.raw("lineitem"))
