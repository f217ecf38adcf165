"""Join shapes.

No join here carries a broadcast hint for a table that can grow: Spark broadcasts a
side only after checking its size against ``spark.sql.autoBroadcastJoinThreshold``,
from statistics at planning time and from real shuffle sizes at run time. Larger
sides go through a sort-merge join whose skewed partitions are split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_inner(fact: DataFrame, *dims: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Inner equi-joins of a fact with dimensions, one after the other."""
    for dim, keys in dims:
        fact = fact.join(dim, _keys(keys), "inner")
    return fact


def join_left(fact: DataFrame, *dims: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """Left equi-joins; put dimensions with the same key next to each other, they share a shuffle."""
    for dim, keys in dims:
        fact = fact.join(dim, _keys(keys), "left")
    return fact


def join_left_preagg(
    left: DataFrame, many: DataFrame, key: str, aggregates: Sequence[Column], defaults: dict[str, object] | None = None
) -> DataFrame:
    """Aggregate the many side to one row per key, then left join, so that no row fans out.

    ``defaults`` fills the named aggregates where the many side has no row.
    """
    joined = left.join(many.groupBy(key).agg(*aggregates), key, "left")
    for name, value in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return joined


def join_unused_side(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join whose right side contributes no column.

    With one right row per key the result is ``left`` itself, and Catalyst sees that
    from the distinct below and removes the join, so ``right`` is not even read.
    """
    return left.join(right.select(key).distinct(), key, "left").select(*left.columns)


def anti_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    parents = parent.select(F.col(parent_key or key).alias("_parent"))
    return child.filter(F.col(key).isNotNull()).join(parents, F.col(key) == F.col("_parent"), "left_anti")


def semi_members(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key has a parent."""
    parents = parent.select(F.col(parent_key or key).alias("_parent"))
    return child.join(parents, F.col(key) == F.col("_parent"), "left_semi")


def anti_key(delta: DataFrame, target: DataFrame, key: str, null_blocks: bool = False) -> DataFrame:
    """Delta rows whose key is not yet in the target.

    The default reads ``NOT EXISTS``: rows with a NULL key pass. ``null_blocks=True`` reads
    SQL's ``NOT IN``: one NULL key in the target lets nothing pass, and rows with a
    NULL key pass only while the target is empty. Either way this is an ordinary anti join;
    a literal NOT IN would broadcast the whole target.
    """
    known = target.select(F.col(key).alias("_known"))
    fresh = delta.join(known, F.col(key) == F.col("_known"), "left_anti")
    if not null_blocks:
        return fresh
    # One row: 0 for an empty target, 1 for keys without NULL, 2 where a NULL is present.
    state = known.agg(
        F.coalesce(F.max(F.when(F.col("_known").isNull(), F.lit(2)).otherwise(F.lit(1))), F.lit(0))
    ).scalar()
    return fresh.filter((state == 0) | ((state == 1) & F.col(key).isNotNull()))


def filter_above_max(df: DataFrame, c: str, target: DataFrame, target_c: str | None = None) -> DataFrame:
    """``c > (select max(c) from target)``: nothing passes while the target is empty."""
    return df.filter(F.col(c) > target.agg(F.max(target_c or c)).scalar())


def join_on_spine(spine: DataFrame, daily: DataFrame, day: str) -> DataFrame:
    """Calendar left join an already aggregated table, so that empty days appear."""
    return spine.join(daily, day, "left")


def join_full(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Full join of two tables aggregated to the same keys; NULL keys meet each other."""
    keys = _keys(keys)
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    joined = left.join(other, same, "full")
    merged = [F.coalesce(F.col(k), F.col(f"_r_{k}")).alias(k) for k in keys]
    return joined.select(*merged, *[c for c in joined.columns if c not in keys and not c.startswith("_r_")])
