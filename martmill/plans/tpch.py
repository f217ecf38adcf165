"""Order-line warehouse: staging, conformed views, dimensions, facts, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.functions.columns import rename_project, trunc_month
from martmill.operators.aggregates import count_and_sum
from martmill.operators.incremental import PeriodTable, inc_watermark_inclusive
from martmill.operators.joins import join_inner, join_left, join_left_preagg
from martmill.operators.partials import Rollup
from martmill.operators.quality import Check, not_null_unique

# Source column to business name, per table.
STAGING = {
    "customer": {
        "c_custkey": "customer_id",
        "c_name": "customer_name",
        "c_address": "customer_address",
        "c_nationkey": "nation_id",
        "c_phone": "customer_phone",
        "c_acctbal": "account_balance",
        "c_mktsegment": "market_segment",
        "c_comment": "customer_comment",
    },
    "lineitem": {
        "l_orderkey": "order_id",
        "l_partkey": "part_id",
        "l_suppkey": "supplier_id",
        "l_linenumber": "line_number",
        "l_quantity": "quantity",
        "l_extendedprice": "extended_price",
        "l_discount": "discount",
        "l_tax": "tax",
        "l_returnflag": "return_flag",
        "l_linestatus": "line_status",
        "l_shipdate": "event_date",
        "l_commitdate": "commit_date",
        "l_receiptdate": "receipt_date",
        "l_shipinstruct": "ship_instructions",
        "l_shipmode": "ship_mode",
        "l_comment": "lineitem_comment",
    },
    "nation": {
        "n_nationkey": "nation_id",
        "n_name": "nation_name",
        "n_regionkey": "region_id",
        "n_comment": "nation_comment",
    },
    "orders": {
        "o_orderkey": "order_id",
        "o_custkey": "customer_id",
        "o_orderstatus": "order_status",
        "o_totalprice": "order_total",
        "o_orderdate": "order_date",
        "o_orderpriority": "order_priority",
        "o_clerk": "order_clerk",
        "o_shippriority": "ship_priority",
        "o_comment": "order_comment",
    },
    "part": {
        "p_partkey": "part_id",
        "p_name": "part_name",
        "p_mfgr": "manufacturer",
        "p_brand": "brand",
        "p_type": "part_type",
        "p_size": "part_size",
        "p_container": "container",
        "p_retailprice": "retail_price",
        "p_comment": "part_comment",
    },
    "partsupp": {
        "ps_partkey": "part_id",
        "ps_suppkey": "supplier_id",
        "ps_availqty": "available_quantity",
        "ps_supplycost": "supply_cost",
        "ps_comment": "partsupp_comment",
    },
    "region": {"r_regionkey": "region_id", "r_name": "region_name", "r_comment": "region_comment"},
    "supplier": {
        "s_suppkey": "supplier_id",
        "s_name": "supplier_name",
        "s_address": "supplier_address",
        "s_nationkey": "nation_id",
        "s_phone": "supplier_phone",
        "s_acctbal": "account_balance",
        "s_comment": "supplier_comment",
    },
}


def stage(raw: DataFrame, table: str, strict: bool = False) -> DataFrame:
    """A source table under business names; columns a reduced source lacks are left out."""
    return rename_project(raw, STAGING[table], strict=strict)


def _present(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[n for n in names if n in df.columns])


def customer_geo(customers: DataFrame, nations: DataFrame, regions: DataFrame) -> DataFrame:
    """Customers with nation and region."""
    places = join_inner(nations, (regions, "region_id"))
    return _present(
        join_inner(customers, (places, "nation_id")),
        "customer_id",
        "customer_name",
        "customer_address",
        "account_balance",
        "market_segment",
        "nation_id",
        "nation_name",
        "region_id",
        "region_name",
    )


def lineitem_enriched(lineitem: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines with their order and customer.

    Orders meet customers first: the lines, by far the largest table, are then shuffled
    once, by order, and not again by customer.
    """
    described = join_inner(orders, (customers.select("customer_id", "market_segment", "nation_id"), "customer_id"))
    described = described.select(
        "order_id", "customer_id", "order_date", "order_status", "order_priority", "market_segment", "nation_id"
    )
    return join_inner(lineitem, (described, "order_id")).select(
        "order_id",
        "line_number",
        "event_date",
        "quantity",
        "extended_price",
        "discount",
        "tax",
        "return_flag",
        "customer_id",
        "order_date",
        "order_status",
        "order_priority",
        "market_segment",
        "nation_id",
    )


def order_priorities(orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Orders with the customer's region and segment, where known."""
    return join_left(orders, (geo.select("customer_id", "region_name", "market_segment"), "customer_id")).select(
        "order_id",
        "customer_id",
        "order_status",
        "order_total",
        "order_date",
        "order_priority",
        "region_name",
        "market_segment",
    )


def order_priorities_summary(orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Orders and revenue by region, segment and priority.

    Orders are first reduced to one row per customer and priority, so the join moves at most
    five rows per customer, also for a customer with a third of all orders.
    """
    keys = ["region_name", "market_segment", "order_priority"]
    partial = count_and_sum(orders, ["customer_id", "order_priority"], "order_total", "_total", "_count")
    joined = join_left(partial, (geo.select("customer_id", "region_name", "market_segment"), "customer_id"))
    return joined.groupBy(*keys).agg(
        F.sum("_count").alias("order_count"), F.sum("_total").alias("revenue_total")
    )


def customer_revenue(orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Revenue and orders of every customer, zero for those without orders."""
    return join_left_preagg(
        geo.select("customer_id", "customer_name", "region_name", "market_segment"),
        orders,
        "customer_id",
        [F.sum("order_total").alias("revenue_total"), F.count(F.lit(1)).alias("order_count")],
        defaults={"revenue_total": 0, "order_count": 0},
    )


def daily_sales(enriched: DataFrame) -> DataFrame:
    """Net revenue, units and distinct orders by ship day and customer segment."""
    return enriched.groupBy("event_date", "market_segment").agg(
        F.sum(F.col("extended_price") * (F.lit(1) - F.col("discount"))).alias("net_revenue"),
        F.sum("quantity").alias("units_sold"),
        F.countDistinct("order_id").alias("order_count"),
    )


# The same figures as parts that take in deltas of order lines and of orders.
DAILY_SALES = Rollup(
    ["event_date", "market_segment"],
    sums={"net_revenue": "extended_price * (1 - discount)", "units_sold": "quantity"},
    distinct={"order_count": "order_id"},
)
CUSTOMER_TOTALS = Rollup(["customer_id"], sums={"revenue_total": "order_total", "order_count": "1"})


def customer_revenue_of(totals: DataFrame, geo: DataFrame) -> DataFrame:
    """``customer_revenue`` from the finished totals."""
    joined = join_left(geo.select("customer_id", "customer_name", "region_name", "market_segment"), (totals, "customer_id"))
    return joined.fillna({"order_count": 0}).withColumn("revenue_total", F.coalesce("revenue_total", F.lit(0)))


def supplier_dim(suppliers: DataFrame, nations: DataFrame) -> DataFrame:
    return join_inner(suppliers, (nations.select("nation_id", "nation_name"), "nation_id")).select(
        "supplier_id", "supplier_name", "account_balance", "nation_name"
    )


def orders_fact(orders: DataFrame, geo: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Order facts; with a target, only those from its last order date on. The date filter sits
    below the join, so old orders are skipped in the scan."""
    fresh = inc_watermark_inclusive(orders, target, "order_date")
    joined = join_left(fresh, (geo.select("customer_id", "region_name", "market_segment"), "customer_id"))
    return _present(
        joined,
        "order_id",
        "customer_id",
        "order_status",
        "order_total",
        "order_date",
        "order_priority",
        "order_clerk",
        "ship_priority",
        "region_name",
        "market_segment",
    )


def run_orders_fact(table: PeriodTable, orders: DataFrame, geo: DataFrame) -> None:
    """One incremental run of the order facts, stored by order month.

    The high-water mark is read from the last month only; the merge rewrites the months
    that hold changed or new orders.
    """
    rows = orders_fact(orders, geo, table.last_period())
    table.upsert(rows.withColumn(table.period, trunc_month("order_date")))


# Declared checks of staging, intermediate tables and marts.
STAGING_CHECKS = [
    *not_null_unique("stg_regions", "region_id"),
    Check("not_null", "stg_regions", "region_name"),
    *not_null_unique("stg_nations", "nation_id"),
    Check("not_null", "stg_nations", "nation_name"),
    Check("not_null", "stg_nations", "region_id"),
    Check("relationships", "stg_nations", "region_id", ("stg_regions", "region_id")),
    *not_null_unique("stg_suppliers", "supplier_id"),
    Check("not_null", "stg_suppliers", "nation_id"),
    Check("relationships", "stg_suppliers", "nation_id", ("stg_nations", "nation_id")),
    *not_null_unique("stg_customers", "customer_id"),
    Check("not_null", "stg_customers", "nation_id"),
    Check("relationships", "stg_customers", "nation_id", ("stg_nations", "nation_id")),
    *not_null_unique("stg_parts", "part_id"),
    *not_null_unique("stg_orders", "order_id"),
    Check("not_null", "stg_orders", "customer_id"),
    Check("relationships", "stg_orders", "customer_id", ("stg_customers", "customer_id")),
    Check("not_null", "stg_lineitem", "order_id"),
    Check("relationships", "stg_lineitem", "order_id", ("stg_orders", "order_id")),
    Check("not_null", "stg_lineitem", "line_number"),
    Check("not_null", "stg_lineitem", "event_date"),
]
PARTSUPP_CHECKS = [
    Check("not_null", "stg_partsupp", "part_id"),
    Check("relationships", "stg_partsupp", "part_id", ("stg_parts", "part_id")),
    Check("not_null", "stg_partsupp", "supplier_id"),
    Check("relationships", "stg_partsupp", "supplier_id", ("stg_suppliers", "supplier_id")),
]
MART_CHECKS = [
    *not_null_unique("int_customer_geo", "customer_id"),
    Check("not_null", "int_lineitem_enriched", "order_id"),
    Check("not_null", "int_lineitem_enriched", "line_number"),
    Check("not_null", "int_order_priorities", "order_id"),
    *not_null_unique("dim_regions", "region_id"),
    *not_null_unique("dim_nations", "nation_id"),
    *not_null_unique("dim_suppliers", "supplier_id"),
    *not_null_unique("dim_parts", "part_id"),
    *not_null_unique("dim_customers", "customer_id"),
    Check("not_null", "fct_lineitem", "order_id"),
    Check("not_null", "fct_lineitem", "line_number"),
    Check("not_null", "fct_lineitem", "event_date"),
    *not_null_unique("fct_orders", "order_id"),
    Check("not_null", "fct_orders", "customer_id"),
]
