"""One key with a third of all rows, on plans without broadcasts, as at full scale."""

import re

import pytest
from pyspark.sql import functions as F

from martmill.operators import incremental as I
from martmill.operators import joins as J
from martmill.operators import lineage
from martmill.operators.quality import check_relationships
from martmill.plans import bikeshop, jaffle, tpch

N = 60_000
LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def large(spark):
    """Thresholds scaled down to the test data."""
    old = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(name, spread=500):
    return F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % spread).cast("bigint").alias(name)


def final_plan(df):
    n = len(df.collect())
    return n, df._jdf.queryExecution().executedPlan().toString()


def skew_joins(plan):
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(r"Join\(skew=true\)", final))


def test_hot_order_of_the_flagship(large):
    lines = large.range(N).select(
        hot("order_id"), F.col("id").alias("line_number"), (F.col("id") % 50).alias("event_date"),
        *[F.lit(1).alias(c) for c in ("quantity", "extended_price", "discount", "tax", "return_flag")],
        F.repeat(F.col("id").cast("string"), 3).alias("pad"),
    )
    orders = large.range(500).select(
        F.col("id").alias("order_id"), (F.col("id") % 20).alias("customer_id"),
        *[F.lit(1).alias(c) for c in ("order_date", "order_status", "order_priority")],
    )
    customers = large.range(20).select(F.col("id").alias("customer_id"), F.lit("m").alias("market_segment"), F.lit(1).alias("nation_id"))
    out = tpch.daily_sales(tpch.lineitem_enriched(lines, orders, customers))
    n, plan = final_plan(out)
    assert n == 50 and skew_joins(plan) == 1
    assert out.agg(F.sum("units_sold")).first()[0] == N


def test_hot_customer_is_one_row_per_priority_before_the_join(large):
    orders = large.range(N).select(hot("customer_id"), (F.col("id") % 5).alias("order_priority"), F.lit(1).alias("order_total"))
    geo = large.range(500).select(F.col("id").alias("customer_id"), F.lit("r").alias("region_name"), F.lit("m").alias("market_segment"))
    out = tpch.order_priorities_summary(orders, geo)
    n, plan = final_plan(out)
    assert n == 5 and out.agg(F.sum("order_count")).first()[0] == N
    final = plan.split("== Initial Plan ==")[0]
    # Both aggregation steps run below the join's sort.
    assert final.index("SortMergeJoin") < final.index("partial_count")


def test_hot_product_and_order_of_the_item_fact(large):
    items = large.range(N).select(F.col("id").cast("string").alias("order_item_id"), hot("order_id", 900), hot("product_id"))
    orders = large.range(900).select(F.col("id").alias("order_id"), F.lit("c").alias("customer_id"), F.lit(1).alias("ordered_at"))
    products = large.range(500).select(
        F.col("id").alias("product_id"), *[F.lit(1).alias(c) for c in ("product_name", "product_price", "is_food_item", "is_drink_item")]
    )
    supplies = large.range(1000).select((F.col("id") % 500).alias("product_id"), F.lit(1).cast("decimal(16,2)").alias("supply_cost"))
    n, plan = final_plan(jaffle.fct_order_items(items, orders, products, supplies))
    assert n == N and skew_joins(plan) >= 2


def test_hot_product_of_the_bike_fact(large):
    lines = large.range(N).select(
        F.col("id").alias("order_product_id"), hot("product_id"), hot("order_id"), F.lit(1).alias("order_product_quantity"), F.lit(1).alias("loaded_at")
    )
    products = large.range(500).select(F.col("id").alias("product_id"), F.lit(1).alias("product_price"), F.lit(1).alias("product_cost"))
    orders = large.range(500).select(F.col("id").alias("order_id"), F.lit(1).alias("customer_id"), F.lit(1).alias("order_date"))
    n, plan = final_plan(bikeshop.fct_order_products(lines, products, orders))
    assert n == N and skew_joins(plan) == 2


def test_hot_keys_in_anti_joins(large):
    facts = large.range(N).select(hot("k"), F.repeat(F.col("id").cast("string"), 3).alias("v"))
    even = large.range(250).select((F.col("id") * 2).alias("k"))
    for df in (
        J.anti_key(facts, even, "k"),
        check_relationships(facts, "k", even, "k"),
        I.upsert_merge(facts, even.withColumn("v", F.lit("new")), "k"),
    ):
        n, plan = final_plan(df)
        assert n >= N // 2 and skew_joins(plan) == 1


def test_hot_parent_in_a_graph(large):
    edges = large.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("v0")).otherwise(F.concat(F.lit("v"), F.col("id") % 1000)).alias("parent"),
        F.concat(F.lit("v"), (F.col("id") * 7) % 1500).alias("child"),
    )
    relations = large.range(1500).select(F.concat(F.lit("v"), "id").alias("name"), (F.col("id") > 1400).alias("is_stored"))
    hops = {r[0]: r[1] for r in lineage.view_chain_hops(edges, relations).collect()}
    assert hops["v0"] == 1
    assert lineage.downstream_count(edges).filter("parent = 'v0'").first()["is_candidate"] is True
