"""Aggregations. All built-in aggregates combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martmill.functions.columns import ColumnLike, as_column


def count_and_sum(df: DataFrame, keys: Sequence[str], amount: ColumnLike, total: str, count: str) -> DataFrame:
    """Rows and amount per key; NULL keys form a group of their own."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), F.sum(as_column(amount)).alias(total))


def sum_expr(df: DataFrame, keys: Sequence[str], **sums: ColumnLike) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(as_column(c)).alias(name) for name, c in sums.items()])


def count_distinct(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact distinct count. The first shuffle is on keys and value together, so a hot key spreads."""
    return df.groupBy(*keys).agg(F.countDistinct(value).alias(name))


def conditional_sum(condition: Column, amount: ColumnLike) -> Column:
    """Sum of the amount where the condition holds; other rows add zero."""
    return F.sum(F.when(condition, as_column(amount)).otherwise(F.lit(0)))


def avg_rounded(c: ColumnLike, places: int) -> Column:
    return F.round(F.avg(as_column(c)), places)


def global_max(df: DataFrame, c: str, name: str) -> DataFrame:
    return df.agg(F.max(c).alias(name))


def max_per_key(df: DataFrame, key: str, c: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(c).alias(name))


def pairs_to_map(df: DataFrame, keys: Sequence[str], name: str, value: str, out: str) -> DataFrame:
    """Key/value rows as one JSON object per entity, keys in order.

    Repeated names are first reduced to their greatest value, on the map side, so what one
    entity collects is its set of distinct names, which is the size of its result row.
    """
    single = df.groupBy(*keys, name).agg(F.max(value).alias(value))
    pairs = F.sort_array(F.collect_list(F.struct(F.col(name), F.col(value))))
    return single.groupBy(*keys).agg(F.to_json(F.map_from_entries(pairs)).alias(out))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key, the one with the greatest ``order`` values.

    An aggregate over structs, not a window: it combines on the map side, so many
    copies of one key never meet in one task. Equal ``order`` values are settled by
    the remaining columns, which keeps the choice the same on every run.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    sortable = [c for c in rest if not df.schema[c].dataType.simpleString().startswith(("map", "variant"))]
    if len(sortable) != len(rest):
        raise TypeError("latest_per_key needs columns that can be ordered")
    row = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)
