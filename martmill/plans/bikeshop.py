"""Bike shop: one set of models for three sites that differ in a few options."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from martmill.functions.calendar import date_spine
from martmill.functions.columns import (
    initcap, map_codes, rename_project, round_to, scale_by, select_except, select_subset, trunc_month,
)
from martmill.operators.incremental import (
    PeriodTable, StoredTable, inc_anti_key, inc_watermark_strict, load_incremental,
)
from martmill.operators.joins import join_left
from martmill.operators.quality import Check, not_null_unique
from martmill.sources.sinks import export_csv

# Gender codes and labels.
GENDERS = {"F": "Female", "M": "Male", "X": "Non-binary"}
# Bounds of the day dimension, the second one excluded.
DATE_RANGE = (dt.date(2020, 1, 1), dt.date(2029, 12, 31))


def stg_customers(raw: DataFrame) -> DataFrame:
    df = rename_project(
        raw,
        {
            "id": "customer_id",
            "first_name": "customer_first_name",
            "last_name": "customer_last_name",
            "email": "customer_email_address",
            "gender": "customer_gender",
            "city": "customer_city",
            "loaded_at": "loaded_at",
        },
    )
    return df.withColumn("customer_gender", map_codes("customer_gender", GENDERS))


def stg_order_products(raw: DataFrame) -> DataFrame:
    return rename_project(
        raw,
        {
            "id": "order_product_id",
            "product_id": "product_id",
            "order_id": "order_id",
            "quantity": "order_product_quantity",
            "loaded_at": "loaded_at",
        },
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    df = rename_project(
        raw,
        {
            "id": "order_id",
            "customer_id": "customer_id",
            "order_status": "order_status",
            "order_date": "order_date",
            "loaded_at": "loaded_at",
        },
    )
    return df.withColumn("order_status", initcap("order_status"))


def stg_products(raw: DataFrame) -> DataFrame:
    df = rename_project(
        raw,
        {
            "id": "product_id",
            "model": "product_name",
            "frame": "product_material",
            "category": "product_category",
            "subcategory": "product_subcategory",
            "price": "product_price",
            "product_cost": "product_cost",
            "loaded_at": "loaded_at",
        },
    )
    return df.withColumn("product_cost", round_to("product_cost", 2))


def dim_customer(customers: DataFrame) -> DataFrame:
    return select_except(customers, "loaded_at")


def dim_order(orders: DataFrame) -> DataFrame:
    return select_subset(orders, "order_id", "order_status", "order_date")


def dim_product(products: DataFrame) -> DataFrame:
    return select_except(products, "product_cost", "product_price", "loaded_at")


def dim_date(spark: SparkSession) -> DataFrame:
    return date_spine(spark, *DATE_RANGE)


@dataclass(frozen=True)
class SiteOptions:
    """Where the sites differ.

    strategy     which order products a later run loads: new keys, or those past the high-water mark
    cost_factor  multiplier on the product cost, as text, or None
    keep_loaded_at  whether the load time stays in the fact
    export_dir   where to leave a CSV copy, or None
    """

    strategy: str = "anti_key"
    cost_factor: str | None = None
    keep_loaded_at: bool = False
    export_dir: str | None = None


# Site by warehouse: lake files with merge, a lakehouse with CSV copies, a plain warehouse.
MERGING = SiteOptions(strategy="watermark", keep_loaded_at=True)
DISCOUNTING = SiteOptions(cost_factor="0.95")
PLAIN = SiteOptions()


def fct_order_products(
    order_products: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    site: SiteOptions = PLAIN,
    target: DataFrame | None = None,
) -> DataFrame:
    """Rows to load: order products with their product and order, where known."""
    if site.strategy == "watermark":
        fresh = inc_watermark_strict(order_products, target, "loaded_at")
    elif site.strategy == "anti_key":
        fresh = inc_anti_key(order_products, target, "order_product_id")
    else:
        raise ValueError(f"unknown strategy {site.strategy!r}")
    cost = products.select("product_id", "product_price", "product_cost")
    if site.cost_factor is not None:
        cost = cost.withColumn("product_cost", scale_by("product_cost", Decimal(site.cost_factor)))
    joined = join_left(fresh, (cost, "product_id"), (orders.select("order_id", "customer_id", "order_date"), "order_id"))
    columns: Sequence[str] = [
        "order_product_id",
        "product_id",
        "order_id",
        "customer_id",
        "order_date",
        "order_product_quantity",
        "product_price",
        "product_cost",
    ]
    return joined.select(*columns, *(["loaded_at"] if site.keep_loaded_at else []))


def run_fct_order_products(
    table: StoredTable | PeriodTable,
    order_products: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    site: SiteOptions = PLAIN,
) -> DataFrame:
    """One incremental run against a stored fact, with the CSV copy where the site wants one.

    New keys are appended, with any new columns. Past a high-water mark, rows are merged by key into the months of
    ``loaded_at`` that they concern.
    """
    if isinstance(table, PeriodTable) != (site.strategy == "watermark"):
        raise ValueError("the watermark strategy, and only that, needs a fact stored by period")
    if isinstance(table, PeriodTable):
        rows = fct_order_products(order_products, products, orders, site, table.last_period())
        table.upsert(rows.withColumn(table.period, trunc_month("loaded_at")), order=["loaded_at"])
        result = table.read().drop(table.period)
    else:
        load_incremental(table, lambda target: fct_order_products(order_products, products, orders, site, target))
        result = table.read()
    if site.export_dir:
        export_csv(result, site.export_dir)
    return result


SOURCE_CHECKS = [
    *not_null_unique("customers", "id"),
    *not_null_unique("orders", "id"),
    Check("relationships", "orders", "customer_id", ("customers", "id")),
    *not_null_unique("order_products", "id"),
    Check("relationships", "order_products", "product_id", ("products", "id")),
    Check("relationships", "order_products", "order_id", ("orders", "id")),
    *not_null_unique("products", "id"),
]
MODEL_CHECKS = [
    Check("accepted_values", "stg_customers", "customer_gender", ("Male", "Female", "Non-binary")),
    *not_null_unique("fct_order_products", "order_product_id"),
    Check("not_null", "fct_order_products", "order_id"),
    Check("not_null", "fct_order_products", "customer_id"),
]
