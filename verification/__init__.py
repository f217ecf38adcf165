"""Registered queries, each with an independent SQL statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from martmill.session import tune
from martmill.sources.derived import Given

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles and days as midnight timestamps: types both engines print alike."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double").alias(f.name)
        elif isinstance(f.dataType, DateType):
            c = c.cast("timestamp_ntz").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the given tables under its own name."""

    def register(fn: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Given(tune(spark), sf_dir)))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return register


def load_all() -> None:
    from verification import (  # noqa: F401
        bikeshop, functions, incremental, jaffle, joins, metadata, metrics, partials, quality, ranking, storage, tpch,
    )
