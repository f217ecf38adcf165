"""Incremental loads.

The upper half works on DataFrames: which delta rows qualify, and what the target
holds afterwards. The lower half loads tables of Spark's catalogue: some only take additions, of others the touched
periods are rewritten. One writer per target is assumed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from martmill.operators.aggregates import latest_per_key
from martmill.operators.joins import anti_key, filter_above_max
from martmill.session import materialise

# Fixed value: where an inclusive high-water mark starts on an empty target.
EPOCH_DAY = "1900-01-01"


# ---- which rows of the delta qualify -------------------------------------------------


def inc_anti_key(delta: DataFrame, target: DataFrame | None, key: str, null_blocks: bool = False) -> DataFrame:
    """Rows with a key the target lacks; changes to known keys are never seen."""
    return delta if target is None else anti_key(delta, target, key, null_blocks)


def inc_watermark_strict(delta: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows past the target's greatest value. Late rows equal to it are left out, and an
    existing but empty target lets nothing pass."""
    return delta if target is None else filter_above_max(delta, column, target)


def inc_watermark_inclusive(
    delta: DataFrame, target: DataFrame | None, column: str, floor: str = EPOCH_DAY
) -> DataFrame:
    """Rows from the target's greatest value on, that value included."""
    if target is None:
        return delta
    kind = target.schema[column].dataType
    mark = target.agg(F.coalesce(F.max(column), F.lit(floor).cast(kind))).scalar()
    return delta.filter(F.col(column) >= mark)


# ---- what the target holds afterwards ------------------------------------------------


def append_new_columns(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Target rows followed by delta rows; columns new on either side are NULL on the other."""
    return target.unionByName(delta, allowMissingColumns=True)


def one_per_key(delta: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` of every key; rows with a NULL key all stay."""
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    return latest_per_key(delta.filter(has_key), keys, order).unionByName(delta.filter(~has_key))


def upsert_merge(
    target: DataFrame, delta: DataFrame, keys: str | Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Replace matching keys and insert new ones.

    ``order`` names the columns that decide between several delta rows of one key;
    without it the delta must hold one row per key. Keys match by plain equality:
    rows with a NULL key are inserted, never replaced.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order:
        delta = one_per_key(delta, keys, order)
    kept = target.join(delta.select(*keys), keys, "left_anti")
    return append_new_columns(kept, delta)


def upsert_delete_insert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the target rows of every key in the delta, then insert the whole delta."""
    kept = target.join(delta.select(*keys), list(keys), "left_anti")
    return append_new_columns(kept, delta)


def append_only(
    target: DataFrame, delta: DataFrame, batch_column: str | None = None, batch_id: object = None
) -> DataFrame:
    """Add the delta. With a batch column, rows of an earlier try of the same batch go first."""
    if batch_column:
        target = target.filter(~F.col(batch_column).eqNullSafe(F.lit(batch_id)))
        delta = delta.withColumn(batch_column, F.lit(batch_id))
    return append_new_columns(target, delta)


def microbatch_replace(
    target: DataFrame, batch: DataFrame, event_time: str, start: dt.date, end_exclusive: dt.date
) -> DataFrame:
    """Replace all days in ``[start, end_exclusive)``, also days the batch no longer mentions."""
    day = F.col(event_time).cast("date")
    inside = (day >= F.lit(start)) & (day < F.lit(end_exclusive))
    kept = target.filter(~F.coalesce(inside, F.lit(False)))
    return append_new_columns(kept, batch.filter(inside))


# ---- tables of the catalogue ---------------------------------------------------------
#
# Spark's own partitioned Parquet tables: columns are added by ALTER TABLE, periods are replaced by dynamic partition
# overwrite, which stages all files and moves them into place when the job commits, period by period. So a job that fails
# leaves the table as it was. What a table format would add is given up: a driver lost during the moves, or between them and the
# removal of emptied periods, leaves some periods new and some old (running the load again completes it), a reader
# may meet that state, old versions are gone, and two writers are not kept apart.


def _table(spark: SparkSession, name: str) -> DataFrame | None:
    if not spark.catalog.tableExists(name):
        return None
    spark.catalog.refreshTable(name)  # another session, such as a stream's, may have loaded it
    return spark.table(name)


def insert_overwrite(df: DataFrame, name: str, partition_by: Sequence[str], location: str | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` into a table, in the place of the partitions it has rows for, or, with ``append``, beside what is there.

    The first load makes the table, at ``location`` or in the warehouse. Columns that arrive later are added and read as
    NULL in older rows; columns a load lacks are NULL. A column must not change its type.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])  # few files per partition, several for a very large one
    table = _table(spark, name)
    if table is None:
        writer = df.write.format("parquet").option("partitionOverwriteMode", "dynamic")
        writer = writer.option("path", location) if location else writer
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
        return
    kinds = {f.name: f.dataType for f in table.schema.fields}
    for f in df.schema.fields:
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()} in the table and {f.dataType.simpleString()} in the load")
        if f.name not in table.columns:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS (`{f.name}` {f.dataType.simpleString()})")
    columns = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in spark.table(name).columns]
    df.select(*columns).write.insertInto(name, overwrite=mode == "overwrite")


class StoredTable:
    """A table that only takes additions. For targets whose rows are replaced there is ``PeriodTable``."""

    def __init__(self, spark: SparkSession, name: str, location: str | None = None):
        self.spark, self.name, self.location = spark, name, location

    def read(self) -> DataFrame | None:
        """The table, or None before the first load."""
        return _table(self.spark, self.name)

    def append(self, df: DataFrame) -> None:
        insert_overwrite(df, self.name, (), self.location, mode="append")


def load_incremental(table: StoredTable, build: Callable[[DataFrame | None], DataFrame]) -> None:
    """One run of an incremental model that adds rows: the whole input the first time, a delta after that.

    ``build`` gets the current target, or None on the first run, and returns the rows to add.
    """
    table.append(build(table.read()))


class PeriodTable:
    """A table partitioned by a date column that holds the first day of each period.

    The period is whatever the caller truncates to: days, months. ``keys`` identify a row for upserts. Each load writes the
    touched periods and only those.
    """

    def __init__(self, spark: SparkSession, name: str, period: str, keys: Sequence[str], location: str | None = None):
        self.spark, self.name, self.period, self.keys, self.location = spark, name, period, list(keys), location

    def read(self) -> DataFrame | None:
        """The table, or None before the first load."""
        return _table(self.spark, self.name)

    def periods(self) -> list[str]:
        """The periods with rows, in order; rows without a period are not listed."""
        if self.read() is None:
            return []
        listed = [r[0].partition("=")[2] for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()]
        return sorted(p for p in listed if p[:1].isdigit())

    def last_period(self) -> DataFrame | None:
        """The rows of the latest period, which holds the high-water mark; no rows if the table is empty, None
        if it was never loaded."""
        table, periods = self.read(), self.periods()
        if table is None:
            return None
        return table.filter(F.col(self.period) == F.lit(periods[-1]).cast("date")) if periods else table.limit(0)

    def _write(self, rows: DataFrame) -> None:
        kind = rows.schema[self.period].dataType
        if not isinstance(kind, DateType):
            raise TypeError(f"the period {self.period} must be a date, not {kind.simpleString()}")
        insert_overwrite(rows, self.name, [self.period], self.location)

    def _remove(self, periods: Iterable[str | None]) -> None:
        for p in periods:
            value = "NULL" if p is None else f"DATE '{p}'"
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (`{self.period}` = {value})")

    def _period_list(self, df: DataFrame) -> set[str | None]:
        # Calendar periods, not rows: at most one value per partition.
        return {r[0] for r in df.select(F.col(self.period).cast("string")).distinct().collect()}

    def _in(self, touched: set[str | None]) -> Column:
        named = F.col(self.period).isin([dt.date.fromisoformat(t) for t in sorted(t for t in touched if t is not None)])
        return named | F.col(self.period).isNull() if None in touched else named

    def _refuse_repeats(self, rows: DataFrame) -> None:
        twice = rows.dropna(subset=self.keys).groupBy(*self.keys).count().filter("count > 1").select(*self.keys).first()
        if twice is not None:
            raise ValueError(f"several rows for the key {tuple(twice)}; name an order that picks one")

    def create(self, df: DataFrame) -> None:
        """A whole new table in the place of what there is; the old one is gone before the new one is written."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self._write(df)

    def replace(self, batch: DataFrame, start: dt.date, end_exclusive: dt.date) -> None:
        """Replace the periods that begin in ``[start, end_exclusive)``; those without new rows become empty."""
        batch = batch.filter((F.col(self.period) >= F.lit(start)) & (F.col(self.period) < F.lit(end_exclusive)))
        new = self._period_list(batch)
        self._write(batch)
        self._remove(p for p in self.periods() if str(start) <= p < str(end_exclusive) and p not in new)

    def replace_mentioned(self, batch: DataFrame) -> None:
        """Replace just the periods the batch has rows for."""
        self._write(batch)

    def upsert(self, delta: DataFrame, keys_move: bool = True, order: Sequence[str] = ()) -> None:
        """Upsert by key; a key may move to another period.

        Several rows of one key fail unless ``order`` names the columns that pick one. Rows with a NULL key are
        inserted, never replaced. A narrow pass over keys and periods finds the periods that hold replaced rows; it is
        left out with ``keys_move=False``, for keys that never change their period. Only these periods and
        those of the delta are rebuilt. The same delta once more changes nothing, but for rows with a NULL key.
        """
        if order:
            delta = one_per_key(delta, self.keys, order)
        delta = materialise(delta, "delta")
        if not order:
            self._refuse_repeats(delta)
        target = self.read()
        if target is None:
            self._write(delta)
            return
        own = self._period_list(delta)
        left: set[str | None] = set()
        if keys_move:
            hit = target.select(*self.keys, self.period).join(delta.select(*self.keys), self.keys, "left_semi")
            left = self._period_list(hit) - own
        rows = upsert_merge(target.filter(self._in(own | left)), delta, self.keys)
        kept = left and self._period_list(target.filter(self._in(left)).join(delta.select(*self.keys), self.keys, "left_anti"))
        self._write(rows)
        self._remove(left - (kept or set()))
