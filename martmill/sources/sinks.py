"""Publishing results."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.operators.cuts import order_number
from martmill.session import materialise


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


# Bits of a column's place on the curve: at most 2^6 ranges of about as many rows.
_CURVE_BITS = 6


def _below(number: Column, bounds: Sequence[float]) -> Column:
    """How many of the sorted bounds lie below a number, by halving: a place beyond the last bound is NULL, and so not below."""
    halves = F.array(*[F.lit(1 << bit) for bit in reversed(range(_CURVE_BITS))])
    return F.aggregate(halves, F.lit(0), lambda at, step: at + F.when(F.get(F.lit(bounds), at + step - 1) < number, step).otherwise(0))


def curve_position(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's place on a Z-curve through the columns: the bits of their range numbers, taken in turn.

    The ranges of all columns come from one pass of approximate quantiles; they decide where a row is stored, nothing else.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [order_number(F.col(c), kinds[c]).cast("double") for c in columns]
    steps = [i / (1 << _CURVE_BITS) for i in range(1, 1 << _CURVE_BITS)]
    found = df.agg(*[F.percentile_approx(n, F.array(*map(F.lit, steps)), 10_000) for n in numbers]).first()
    place = F.lit(0).cast("bigint")
    for k, (number, cuts) in enumerate(zip(numbers, found)):
        bounds = sorted(b for b in set(cuts or []) if b == b)  # nothing is above NaN
        at = _below(number, bounds) if bounds else F.lit(0)
        # A range's bits on the curve, by its number: the number is found once a row.
        bits = [sum((n >> bit & 1) << (bit * len(columns) + k) for bit in range(_CURVE_BITS)) for n in range(len(bounds) + 1)]
        place = place + F.lit(bits).cast("array<bigint>")[at]
    return place


def publish_table(
    df: DataFrame,
    name: str,
    path: str,
    spread: Sequence[str],
    sort: Sequence[str] = (),
    cluster: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    files: int | None = None,
) -> DataFrame:
    """Rebuild a Parquet table and switch its readers to it.

    Every build goes into a new folder below ``path``; only when all of it is written does the view ``name`` of the
    catalogue point there, in one step. A build that fails leaves the old table as it was, and queries that have
    begun go on reading the old files, until ``prune_versions`` deletes them.

    ``sort`` orders rows by a few columns, so that file statistics prune a filter on the first of them. ``cluster`` lays them
    along a space-filling curve through two or more columns, so that a filter on any of them skips most files.
    ``spread`` names the table's key: it goes into the range bounds behind the other columns, so that one very
    frequent value still fills several tasks and files. ``files`` fixes their number (with adaptive execution, by
    size otherwise).

    The curve, the range bounds and the build itself each read all rows, so an ordered build stores them first, once.
    """
    order = list(dict.fromkeys([*partition_by, *sort]))
    if order or cluster:
        df = materialise(df, "unordered")
    if cluster:
        df = df.withColumn("_curve", curve_position(df, cluster))
        order.append("_curve")
    if order:
        bounds = [*order, *[c for c in spread if c not in order]]
        dealt = df.repartitionByRange(files, *bounds) if files else df.repartitionByRange(*bounds)
        df = dealt.sortWithinPartitions(*order, *[c for c in cluster if c not in order])
    version = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    writer = df.drop("_curve").write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{version}`")
    return df.sparkSession.table(name)


def prune_versions(spark: SparkSession, name: str, path: str) -> list[str]:
    """Delete the builds below ``path`` that the table no longer reads; returns their names."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    live = "".join(spark.table(name).inputFiles())
    old = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and f"/{s.getPath().getName()}/" not in live]
    for folder in old:
        fs.delete(folder, True)
    return sorted(folder.getName() for folder in old)


def export_csv(df: DataFrame, directory: str, delimiter: str = ",", header: bool = True) -> None:
    """Overwrite a directory with CSV part files, one per task."""
    df.write.mode("overwrite").option("header", header).option("sep", delimiter).csv(directory)


def clone_schema(spark: SparkSession, source: DataFrame) -> DataFrame:
    """An empty table with the columns of another."""
    return spark.createDataFrame([], source.schema)


def create_table_like(spark: SparkSession, new: str, existing: str) -> None:
    """The same in the catalogue: a new empty table with the definition of an existing one."""
    spark.sql("CREATE TABLE IDENTIFIER(:new) LIKE IDENTIFIER(:old)", {"new": new, "old": existing})


def preview(df: DataFrame, n: int = 1000, order_by: Sequence[str] = ()) -> DataFrame:
    """The first rows; give ``order_by`` for a repeatable choice."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
