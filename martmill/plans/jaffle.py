"""Jaffle shop: order items with costs, customer segments, daily summary, metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.functions.calendar import date_spine, holiday_flag, time_spine_window
from martmill.functions.columns import (
    cents_to_dollars, flag_equals, not_null_filter, rename_project, scale_by, surrogate_key, to_date, trunc_day,
)
from martmill.operators import metrics as M
from martmill.operators.aggregates import avg_rounded, conditional_sum
from martmill.operators.joins import join_inner, join_left, join_unused_side
from martmill.operators.partials import Rollup
from martmill.operators.quality import Check, ContractColumn, enforce_contract, not_null_unique, project_version
from martmill.operators.ranking import SEGMENTS, rfm_metrics, rfm_segments

# Bounds of the day calendar, the second one excluded.
SPINE_RANGE = (dt.date(2010, 1, 1), dt.date(2030, 1, 1))
MARKET_SCHEMA = "report_month date, food_sales bigint, beverage_sales bigint, total_sales bigint"


def stg_customers(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {"id": "customer_id", "name": "customer_name"})


def stg_order_items(raw: DataFrame) -> DataFrame:
    return rename_project(raw, {"id": "order_item_id", "order_id": "order_id", "sku": "product_id"})


def stg_locations(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        "tax_rate",
        trunc_day("opened_at").alias("opened_date"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("order_id"),
        F.col("store_id").alias("location_id"),
        F.col("customer").alias("customer_id"),
        *[F.col(c).alias(f"{c}_cents") for c in ("subtotal", "tax_paid", "order_total")],
        *[cents_to_dollars(c).alias(c) for c in ("subtotal", "tax_paid", "order_total")],
        trunc_day("ordered_at").alias("ordered_at"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("sku").alias("product_id"),
        F.col("name").alias("product_name"),
        F.col("type").alias("product_type"),
        F.col("description").alias("product_description"),
        cents_to_dollars("price").alias("product_price"),
        flag_equals("type", "jaffle").alias("is_food_item"),
        flag_equals("type", "beverage").alias("is_drink_item"),
    )


def stg_supplies(raw: DataFrame) -> DataFrame:
    return raw.select(
        surrogate_key(["id", "sku"]).alias("supply_uuid"),
        F.col("id").alias("supply_id"),
        F.col("sku").alias("product_id"),
        F.col("name").alias("supply_name"),
        cents_to_dollars("cost").alias("supply_cost"),
        F.col("perishable").alias("is_perishable_supply"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return not_null_filter(customers, "customer_name")


def dim_order(orders: DataFrame, locations: DataFrame) -> DataFrame:
    return join_inner(orders, (locations, "location_id")).select(
        "order_id",
        "location_name",
        scale_by("tax_rate", 100).alias("tax_rate_percent"),
        "subtotal",
        "order_total",
        "ordered_at",
    )


def supply_summary(supplies: DataFrame, factor: str) -> DataFrame:
    """Supply cost per product, every cost times ``factor`` before the sum."""
    return supplies.groupBy("product_id").agg(F.sum(scale_by("supply_cost", factor)).alias("supply_cost"))


def _order_items(
    order_items: DataFrame, orders: DataFrame, products: DataFrame, supplies: DataFrame, factor: str
) -> DataFrame:
    """Items with product, supply cost and order, where known.

    Product and supply cost share the key and hence one shuffle of the items; supplies are
    summed before the join. A consumer that ignores the supply cost gets a plan without that join. Orders
    come last: what follows, such as distinct orders per customer, keeps their partitioning.
    """
    return join_left(
        order_items,
        (
            products.select("product_id", "product_name", "product_price", "is_food_item", "is_drink_item"),
            "product_id",
        ),
        (supply_summary(supplies, factor), "product_id"),
        (orders.select("order_id", "customer_id", "ordered_at"), "order_id"),
    ).select(
        "order_item_id",
        "order_id",
        "product_id",
        "customer_id",
        "ordered_at",
        "product_name",
        "product_price",
        "is_food_item",
        "is_drink_item",
        "supply_cost",
    )


def fct_order_items(order_items: DataFrame, orders: DataFrame, products: DataFrame, supplies: DataFrame) -> DataFrame:
    """Version 1."""
    return _order_items(order_items, orders, products, supplies, "1")


def fct_order_items_v2(
    order_items: DataFrame, orders: DataFrame, products: DataFrame, supplies: DataFrame
) -> DataFrame:
    """Version 2: no product name, and the base supply cost in place of the supply cost."""
    return project_version(
        _order_items(order_items, orders, products, supplies, "0.95"),
        exclude=["product_name"],
        rename={"supply_cost": "base_supply_cost"},
    )


# Contracted columns of version 1.
ORDER_ITEMS_CONTRACT = [
    ContractColumn("order_item_id", "string"),
    ContractColumn("order_id", "string"),
    ContractColumn("product_id", "string"),
    ContractColumn("customer_id", "string"),
    ContractColumn("ordered_at", "timestamp_ntz"),
    ContractColumn("product_name", "string"),
    ContractColumn("product_price", "decimal(16,2)"),
    ContractColumn("is_food_item", "boolean"),
    ContractColumn("is_drink_item", "boolean"),
    ContractColumn("supply_cost", "decimal(29,2)"),
]
ORDER_ITEMS_V2_CONTRACT = [
    c for c in ORDER_ITEMS_CONTRACT if c.name not in ("supply_cost", "product_name")
] + [ContractColumn("base_supply_cost", "decimal(29,2)", not_null=False)]


def contracted_order_items(fact: DataFrame, version: int = 1) -> DataFrame:
    return enforce_contract(fact, ORDER_ITEMS_CONTRACT if version == 1 else ORDER_ITEMS_V2_CONTRACT)


def daily_orders_summary(order_items: DataFrame, holidays: DataFrame) -> DataFrame:
    """Drink and food revenue per day, holidays marked.

    The day is summed first: the calendar then meets one row per day, not one per item.
    """
    daily = order_items.groupBy(to_date("ordered_at").alias("order_date")).agg(
        conditional_sum(F.col("is_drink_item"), "product_price").alias("drink_order_amount"),
        conditional_sum(F.col("is_food_item"), "product_price").alias("food_order_amount"),
    )
    flagged = holiday_flag(daily, "order_date", holidays)
    return flagged.select("order_date", "is_holiday", "drink_order_amount", "food_order_amount").orderBy("order_date")


def customer_rfm_segments(order_items: DataFrame) -> DataFrame:
    return rfm_segments(rfm_metrics(order_items), stored=True)


# Customer figures as parts that take in deltas of order items.
CUSTOMER_ITEMS = Rollup(
    ["customer_id"], sums={"lifetime_value": "coalesce(product_price, 0)"}, maxima={"_last": "ordered_at"}, distinct={"order_frequency": "order_id"}
)


def customer_segment_orders(segments: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers and average behaviour per segment. The customer dimension adds no column and,
    one row per customer being checked, no rows."""
    joined = join_unused_side(segments, customers, "customer_id")
    summary = joined.groupBy("customer_segment").agg(
        F.countDistinct("customer_id").alias("customer_count"),
        avg_rounded("lifetime_value", 2).alias("avg_lifetime_value"),
        avg_rounded(F.col("order_frequency").cast("decimal(20,0)"), 1).alias("avg_order_frequency"),
        avg_rounded(F.col("recency_days").cast("decimal(20,0)"), 0).alias("avg_days_since_last_order"),
    )
    return summary.orderBy(F.col("avg_lifetime_value").desc())


def time_spine_daily(spark: SparkSession, as_of: dt.date | Column) -> DataFrame:
    return time_spine_window(date_spine(spark, *SPINE_RANGE), as_of)


# ---- semantic models -----------------------------------------------------------------


def order_model(orders: DataFrame) -> M.SemanticModel:
    return M.SemanticModel(
        table=orders,
        time="ordered_at",
        measures=[],
        entities={"order_id": "order_id"},
        dimensions={
            "location_name": "location_name",
            "high_tax_area": "tax_rate_percent > 5",
            "large_order": "subtotal > 30",
        },
    )


def order_item_model(order_items: DataFrame, orders: DataFrame | None = None) -> M.SemanticModel:
    return M.SemanticModel(
        table=order_items,
        time="ordered_at",
        measures=[
            M.Measure("order_item_revenue", "sum", "product_price"),
            M.Measure("order_item_cost", "sum", "supply_cost"),
            M.Measure("order_count", "count_distinct", "order_id"),
        ],
        entities={
            "order_item": "order_item_id",
            "order_id": "order_id",
            "product": "product_id",
            "customer": "customer_id",
        },
        links={"order_id": order_model(orders)} if orders is not None else {},
    )


def market_model(market_data: DataFrame) -> M.SemanticModel:
    return M.SemanticModel(
        table=market_data,
        time="report_month",
        measures=[
            M.Measure("market_food_sales", "sum", "food_sales"),
            M.Measure("market_beverage_sales", "sum", "beverage_sales"),
            M.Measure("market_total_sales", "sum", "total_sales"),
        ],
    )


METRICS = (
    "revenue",
    "monthly_revenue_l1m",
    "mtd_revenue",
    "mom_revenue_performance",
    "order_count",
    "average_order_amount",
    "jaffle_market_share",
    "market_food_sales",
    "market_beverage_sales",
    "market_total_sales",
)


# The grains of metrics that do not answer at every one, the finest first.
GRAINS: dict[str, tuple[str | None, ...]] = {
    "mtd_revenue": ("day", "month"),
    **dict.fromkeys(("monthly_revenue_l1m", "mom_revenue_performance", "jaffle_market_share"), ("month",)),
    **dict.fromkeys(("market_food_sales", "market_beverage_sales", "market_total_sales"), ("month", "quarter", "year", None)),
}
MARKET_ONLY = ("jaffle_market_share", "market_food_sales", "market_beverage_sales", "market_total_sales")


def metric(
    name: str,
    items: M.SemanticModel,
    spine: DataFrame,
    market: M.SemanticModel | None = None,
    group_by: tuple[str, ...] = (),
    grain: str | None = "finest",
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """The named metric by ``period`` at ``grain`` and by the asked dimensions.

    ``grain=None`` gives all-time values, ``finest`` days or, for metrics that have none, months. What a metric
    cannot answer raises: offset, growth and share are by month, market totals by month or longer, month to
    date by day or by month (its last value in it), and the market knows no dimensions.
    """
    allowed = GRAINS.get(name, ("day",))
    if grain == "finest":
        grain = allowed[0]
    elif name in GRAINS and grain not in allowed:
        raise ValueError(f"{name} has no grain {grain!r}")
    if group_by and name in MARKET_ONLY:
        raise ValueError(f"{name} has no dimensions")
    if name == "revenue":
        out = M.measures(items, {name: "order_item_revenue"}, grain, group_by, start, end)
        return M.join_on_spine(M.spine_periods(spine, grain, start, end), out, M.PERIOD) if grain else out
    if name == "order_count":
        return M.measures(items, {name: "order_count"}, grain, group_by, start, end)
    if name == "average_order_amount":
        both = {"revenue": "order_item_revenue", "order_count": "order_count"}
        out = M.measures(items, both, grain, group_by, start, end)
        if grain:
            out = M.join_on_spine(M.spine_periods(spine, grain, start, end), out, M.PERIOD)
        return M.ratio(out, "revenue", "order_count", name)
    if name == "mtd_revenue":
        # A total may begin before ``start``: sum from the first of that month, then cut.
        first = start.replace(day=1) if start else None
        daily = M.measures(items, {"revenue": "order_item_revenue"}, "day", group_by, first, end)
        days = M.bounded(spine, spine.columns[0], first, end)
        out = M.bounded(M.to_date_cumulative(daily, "revenue", days, name, "month", group_by), M.PERIOD, start, end)
        if grain == "day":
            return out
        return out.groupBy(F.trunc(M.PERIOD, "month").alias(M.PERIOD), *group_by).agg(F.max_by(name, M.PERIOD).alias(name))
    if name in ("monthly_revenue_l1m", "mom_revenue_performance"):
        # The month before ``start`` is needed too, so the bounds apply to the result.
        by_month = M.measures(items, {"current_month": "order_item_revenue"}, "month", group_by)
        months = M.spine_periods(spine, "month")
        out = M.offset_on_spine(by_month, months, 1, "month", "current_month", "previous_month", group_by)
        out = M.bounded(out, M.PERIOD, start, end)
        if name == "monthly_revenue_l1m":
            return out.drop("current_month").withColumnRenamed("previous_month", name)
        out = M.ratio(out, "current_month", "previous_month", name)
        return out.withColumn(name, F.col(name) - F.lit(1))
    if market is None:
        raise ValueError(f"{name} needs the market model")
    if name == "jaffle_market_share":
        ours = M.measures(items, {"revenue": "order_item_revenue"}, "month", (), start, end)
        total = M.measures(market, {"market_total_sales": "market_total_sales"}, "month", (), start, end)
        return M.ratio(M.join_full(ours, total, M.PERIOD), "revenue", "market_total_sales", name)
    if name in ("market_food_sales", "market_beverage_sales", "market_total_sales"):
        return M.measures(market, {name: name}, grain, (), start, end)
    raise KeyError(f"no metric {name!r}")


def customer_leaderboard(items: M.SemanticModel) -> DataFrame:
    """All-time revenue by customer."""
    return M.measures(items, {"revenue": "order_item_revenue"}, group_by=("customer",))


# ---- declared checks -----------------------------------------------------------------

STAGING_CHECKS = [
    *not_null_unique("stg_customers", "customer_id"),
    *not_null_unique("stg_locations", "location_id"),
    *not_null_unique("stg_order_items", "order_item_id"),
    Check("not_null", "stg_order_items", "order_id"),
    Check("relationships", "stg_order_items", "order_id", ("stg_orders", "order_id")),
    *not_null_unique("stg_orders", "order_id"),
    Check("expression", "stg_orders", "", "order_total - tax_paid = subtotal"),
    *not_null_unique("stg_products", "product_id"),
    *not_null_unique("stg_supplies", "supply_uuid"),
]
MART_CHECKS = [
    *not_null_unique("dim_order", "order_id"),
    Check("relationships", "fct_order_items", "order_id", ("stg_orders", "order_id")),
    Check("relationships", "fct_order_items", "product_id", ("stg_products", "product_id")),
    Check("relationships", "fct_order_items", "customer_id", ("stg_customers", "customer_id")),
    *not_null_unique("int_customer_rfm_segments", "customer_id"),
    Check("not_null", "int_customer_rfm_segments", "recency_days"),
    Check("not_null", "int_customer_rfm_segments", "order_frequency"),
    Check("not_null", "int_customer_rfm_segments", "lifetime_value"),
    Check("not_null", "int_customer_rfm_segments", "rfm_score"),
    Check("not_null", "int_customer_rfm_segments", "customer_segment"),
    Check("accepted_values", "int_customer_rfm_segments", "customer_segment", SEGMENTS),
    *not_null_unique("fct_customer_segment_orders", "customer_segment"),
    Check("not_null", "fct_customer_segment_orders", "customer_count"),
    Check("not_null", "fct_customer_segment_orders", "avg_lifetime_value"),
    Check("not_null", "fct_customer_segment_orders", "avg_order_frequency"),
    Check("not_null", "fct_customer_segment_orders", "avg_days_since_last_order"),
]
