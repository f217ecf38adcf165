"""The physical plans are the ones meant, with joins planned as for large tables."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from martmill.operators import incremental as I
from martmill.operators import joins as J
from martmill.operators.quality import enforce_contract, ContractColumn
from martmill.plans import jaffle, tpch
from martmill.sources.derived import Given
from martmill.sources.tables import scan_source

ROOT = "/root/testdata/sf0.001"


@pytest.fixture
def g(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Given(spark, ROOT)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(text):
    return len(re.findall(r"Exchange (?:hash|range)partitioning", text))


def test_flagship_shuffles_order_lines_once(g):
    text = plan(tpch.daily_sales(g.lineitem_enriched()))
    # Lines by order; orders and customers by customer; orders by order; the result by its group.
    assert exchanges(text) == 5
    join = text.index("SortMergeJoin [order_id")
    assert "Exchange" in text[:join] and text[:join].count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_read(g):
    text = formatted(tpch.daily_sales(g.lineitem_enriched()))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lines = next(s for s in schemas if "l_orderkey" in s)
    assert {c.split(":")[0] for c in lines.split(",")} == {"l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


def test_date_bounds_reach_the_scan(g):
    items = jaffle.order_item_model(
        scan_source(g.spark, ROOT, "orders").select(
            F.col("o_orderdate").alias("ordered_at"), F.col("o_totalprice").alias("product_price"), F.col("o_orderkey").alias("order_id")
        )
    )
    text = formatted(jaffle.metric("order_count", items, g.order_days(), start=dt.date(1997, 1, 1), end=dt.date(1997, 2, 1)))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,1997-01-01", text)
    assert re.search(r"PushedFilters: \[.*LessThan\(o_orderdate,1997-02-02", text)


def test_not_in_is_an_ordinary_anti_join(g):
    text = plan(J.anti_key(g.stage("customer"), g.stage("orders"), "customer_id", null_blocks=True))
    assert "SortMergeJoin" in text and "LeftAnti" in text and "BroadcastExchange" not in text


def test_incremental_filter_sits_below_the_join(g):
    orders = g.stage("orders")
    text = plan(tpch.orders_fact(orders, g.customer_geo(), orders.limit(1)))
    assert text.index("SortMergeJoin") < text.index(">= Subquery") or text.index("SortMergeJoin") < text.index("Subquery")


def test_unused_supply_cost_is_not_computed(g):
    fact = jaffle.fct_order_items_v2(
        jaffle.stg_order_items(g.raw_items()), jaffle.stg_orders(g.raw_orders()),
        jaffle.stg_products(g.raw_products()), jaffle.stg_supplies(g.raw_supplies()),
    )
    assert "l_suppkey" in plan(fact)
    text = plan(fact.groupBy("customer_id").agg(F.sum("product_price")))
    assert "p_retailprice" in text and "l_suppkey" not in text.replace("order_item_id", "")
    assert text.count("SortMergeJoin") == 2


def test_product_and_supply_cost_share_a_shuffle_of_the_items(g):
    fact = jaffle.fct_order_items(
        jaffle.stg_order_items(g.raw_items()), jaffle.stg_orders(g.raw_orders()),
        jaffle.stg_products(g.raw_products()), jaffle.stg_supplies(g.raw_supplies()),
    )
    by_product = [k for k in re.findall(r"Exchange hashpartitioning\((\w+?)#", plan(fact)) if k == "product_id"]
    assert len(by_product) == 3  # items, products, supplies


def test_contract_is_checked_in_the_writing_pass(g):
    df = enforce_contract(g.stage("region"), [ContractColumn("region_id", "bigint"), ContractColumn("region_name", "string")])
    text = plan(df)
    assert "raise_error" in text and "Exchange" not in text


def test_upsert_prunes_untouched_periods(spark, tmp_path):
    table = I.PeriodTable(spark, "pruned_periods", "m", ["k"], str(tmp_path / "t"))
    rows = [(n, dt.date(2024, n, 1)) for n in range(1, 7)]
    table.create(spark.createDataFrame(rows, "k int, m date"))
    text = formatted(table.read().filter(table._in({"2024-02-01"})))
    assert re.search(r"PartitionFilters: \[.*2024-02-01", text)
    assert re.search(r"PartitionFilters: \[.*2024-06-01", formatted(table.last_period()))
