"""Reading source tables and seed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Declared sources, by group.
SOURCES = {
    "tpch": ("region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem"),
    "bike_shop": ("customers", "orders", "order_products", "products"),
    "jaffle_shop": ("raw_orders", "raw_items", "raw_stores", "raw_products", "raw_supplies", "raw_customers"),
}


def scan_source(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One raw table; filters and column lists of later steps reach the Parquet scan."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def load_seed_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file with a header row, typed by ``schema``; blanks after the commas are dropped.

    Header names other than the schema's, in its order, and values of another type make the read fail.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )


def exact(column: str | Column, precision: int = 15, scale: int = 2) -> Column:
    """A binary floating-point amount as a decimal, so that sums do not depend on row order."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal({precision},{scale})")
