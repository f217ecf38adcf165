"""Jobs over table inventories: what is deprecated, empty, undocumented or wrongly granted.

Inputs are ordinary tables with the usual catalogue columns. Results are lists of findings and
of statements somebody may run; nothing here runs them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.functions.columns import concat_qualified, map_codes, starts_with_ci
from martmill.operators.aggregates import pairs_to_map
from martmill.operators.setops import merge_lists_unique, set_minus, set_reconcile

# Table types and the word a drop statement needs; other types are left alone.
DROP_WORDS = {
    "MANAGED": "TABLE",
    "STREAMING_TABLE": "TABLE",
    "VIEW": "VIEW",
    "MATERIALIZED_VIEW": "MATERIALIZED VIEW",
}
# Schemas that are never reported as empty, in exactly this spelling.
SYSTEM_SCHEMAS = ("INFORMATION_SCHEMA", "PUBLIC")
# Listed type names that differ from the lower-cased catalogue name.
TYPE_NAMES = {"BASE TABLE": "table", "EXTERNAL TABLE": "external", "MATERIALIZED VIEW": "materializedview"}


def deprecated_relations(tables: DataFrame, expected: DataFrame, dev_prefix: str | None = None) -> DataFrame:
    """Tables and views in the inventory that no model builds any more, with a drop statement.

    ``expected`` has one column of qualified names; names are compared in upper case.
    """
    known = expected.select(F.upper(F.col(expected.columns[0])).alias("_known"))
    df = tables.filter(F.upper("table_schema") != "INFORMATION_SCHEMA")
    if dev_prefix is not None:
        df = df.filter(starts_with_ci("table_schema", dev_prefix))
    df = df.withColumn("relation_type", map_codes("table_type", DROP_WORDS)).filter(
        F.col("relation_type").isNotNull()
    )
    full_name = F.upper(concat_qualified("table_catalog", "table_schema", "table_name"))
    df = df.join(known, full_name == F.col("_known"), "left_anti")
    relation = concat_qualified("table_catalog", "table_schema", "table_name", quote="`")
    return df.select(
        F.concat(F.lit("drop "), "relation_type", F.lit(" "), relation, F.lit(";")).alias("drop_commands"),
        relation.alias("relation_name"),
    )


def empty_schemas(schemata: DataFrame, tables: DataFrame, dev_prefix: str | None = None) -> DataFrame:
    """Schemas without a table, with a drop statement."""

    def names(df: DataFrame, catalog: str, schema: str) -> DataFrame:
        df = df.filter(~F.col(schema).isin(*SYSTEM_SCHEMAS))
        if dev_prefix is not None:
            df = df.filter(starts_with_ci(schema, dev_prefix))
        return df.select(concat_qualified(catalog, schema, quote="`").alias("schema_name"))

    empty = set_minus(
        names(schemata, "catalog_name", "schema_name"),
        names(tables, "table_catalog", "table_schema"),
        ["schema_name"],
    )
    return empty.select(F.concat(F.lit("DROP SCHEMA "), "schema_name", F.lit(";")).alias("drop_commands"), "schema_name")


def describe_tables(
    tables: DataFrame,
    schema_pattern: str,
    table_pattern: str = "%",
    names: Sequence[str] | None = None,
    exclude: str = "",
) -> DataFrame:
    """Distinct listing with comments, by table name. Explicit ``names`` take the place of ``table_pattern``."""
    if names:
        table_pattern = "%"
    df = tables.filter(
        F.col("table_schema").ilike(schema_pattern)
        & F.col("table_name").ilike(table_pattern)
        & ~F.col("table_name").ilike(exclude)
    )
    if names:
        df = df.filter(F.col("table_name").isin(list(names)))
    table_type = F.coalesce(map_codes("table_type", TYPE_NAMES), F.lower("table_type"))
    description = F.regexp_replace("comment", r"^\n+|\n+$", "")
    listing = df.select(
        "table_schema", "table_name", table_type.alias("table_type"), description.alias("table_description")
    )
    return listing.distinct().orderBy("table_name")


def describe_columns(columns: DataFrame, column_tags: DataFrame) -> DataFrame:
    """Columns with their tags as one JSON object. The schema is part of the key, so tables of
    the same name in two schemas keep their own tags."""
    keys = ["table_schema", "table_name", "column_name"]
    tags = pairs_to_map(
        column_tags.withColumnRenamed("schema_name", "table_schema"), keys, "tag_name", "tag_value", "column_tags"
    )
    joined = columns.join(tags, keys, "left")
    return joined.select(
        "table_schema",
        "table_name",
        "column_name",
        F.col("full_data_type").alias("column_data_type"),
        F.regexp_replace("comment", r"^\n+|\n+$", "").alias("column_description"),
        F.col("is_nullable").alias("column_is_nullable"),
        "column_tags",
    )


def column_descriptions(columns: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Column listing with the description found under the exact name, else the lower-case name, else ''.

    ``descriptions`` holds ``table_name, column_name, column_description``. Several descriptions of one name count as
    one, the smallest that is not NULL; they are reduced before they meet the columns, in one join for both spellings.
    """
    order = F.struct(F.col("column_description").isNull(), "column_description")
    one = descriptions.groupBy("table_name", "column_name").agg(F.min_by("column_description", order).alias("_text"))
    spellings = one.groupBy("table_name", F.lower("column_name").alias("_name")).agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "_text"))).alias("_texts")
    )
    joined = columns.withColumn("_name", F.lower("column_name")).join(spellings, ["table_name", "_name"], "left")
    exact = F.map_contains_key("_texts", F.col("column_name"))
    text = F.col("_texts")[F.when(exact, F.col("column_name")).otherwise(F.col("_name"))]
    return joined.select("table_name", F.col("_name").alias("column_name"), F.coalesce(text, F.lit("")).alias("column_description"))


def grant_drift(desired: DataFrame, actual: DataFrame, privilege: str) -> DataFrame:
    """Schema grants to add and to take away.

    ``desired`` holds ``schema_name, roles`` per model, roles as a list that may be empty or NULL;
    ``actual`` holds ``schema_name, role, privilege``. Schemas no model lives in are left alone.
    """
    wanted = merge_lists_unique(desired, "schema_name", "roles", "role")
    managed = desired.select("schema_name").distinct()
    held = actual.filter(F.col("privilege") == privilege).join(managed, "schema_name", "left_semi")
    return set_reconcile(wanted, held, ["schema_name", "role"], add="grant", remove="revoke")
