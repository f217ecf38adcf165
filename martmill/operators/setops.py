"""Set differences and list unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_minus(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``; NULLs compare equal."""
    return a.select(*columns).subtract(b.select(*columns))


def set_reconcile(desired: DataFrame, actual: DataFrame, keys: Sequence[str], add: str, remove: str) -> DataFrame:
    """Both one-sided differences in one full join, marked with an ``action``."""
    want = desired.select(*keys).distinct().withColumn("_want", F.lit(True))
    have = actual.select(*keys).distinct().withColumn("_have", F.lit(True))
    action = F.when(F.col("_have").isNull(), add).when(F.col("_want").isNull(), remove)
    joined = want.join(have, list(keys), "full").withColumn("action", action)
    return joined.filter(F.col("action").isNotNull()).select("action", *keys)


def merge_lists_unique(df: DataFrame, key: str, items: str, item: str) -> DataFrame:
    """Union of the list column per key, one row per distinct item.

    Kept long on purpose: a list per key would gather all of one key's items in one task.
    """
    return df.select(key, F.explode(items).alias(item)).distinct()
