"""Mergeable partial aggregates: aggregates that a delta brings up to date, and one scan for many groupings.

A ``Rollup`` names sums, maxima and exact distinct counts by keys. Its *parts* hold, per group, one row with the sums and
maxima and rows with the members of each distinct set: whole numbers as words of 64 bits, other values one by one.
Parts of two inputs add up to the parts of both, and parts by finer keys to those by coarser ones; figures are
read off at the end. Rows can be added but not taken back, as maxima and sets do not tell how often they held a value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from martmill.session import materialise

_TOTALS = -1
_WORD = 64


@dataclass(frozen=True)
class Rollup:
    """Sums, maxima and distinct counts, each a name and an SQL expression, by keys."""

    keys: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    maxima: Mapping[str, str] = field(default_factory=dict)
    distinct: Mapping[str, str] = field(default_factory=dict)

    def _combined(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.groupBy(*keys, "_of", "_word").agg(
            *[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.maxima], F.bit_or("_bits").alias("_bits")
        )

    def parts(self, df: DataFrame) -> DataFrame:
        """The parts of an input: one scan, one shuffle, summed by task before it."""
        held = df.select(
            *self.keys,
            *[F.expr(c).alias(n) for n, c in (dict(self.sums) | dict(self.maxima)).items()],
            *[F.expr(c).alias(f"_d{i}") for i, c in enumerate(self.distinct.values())],
        )
        numbers = list(self.sums) + list(self.maxima)
        entries = [F.struct(F.lit(_TOTALS).alias("_of"), F.lit(None).cast("string").alias("_word"), F.lit(None).cast("bigint").alias("_bits"), *numbers)]
        for i in range(len(self.distinct)):
            value = F.col(f"_d{i}")
            word, bits = value.cast("string"), F.lit(1).cast("bigint")
            if isinstance(held.schema[f"_d{i}"].dataType, (ByteType, ShortType, IntegerType, LongType)):
                bits = F.expr(f"shiftleft(1L, CAST(pmod(_d{i}, {_WORD}) AS INT))")
                word = F.expr(f"CAST((_d{i} - pmod(_d{i}, {_WORD})) div {_WORD} AS STRING)")
            none = [F.lit(None).cast(held.schema[n].dataType).alias(n) for n in numbers]
            entries.append(F.when(value.isNotNull(), F.struct(F.lit(i).alias("_of"), word.alias("_word"), bits.alias("_bits"), *none)))
        tagged = held.select(*self.keys, F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_e")).select(*self.keys, "_e.*")
        return self._combined(tagged, self.keys)

    def merged(self, *parts: DataFrame) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return self._combined(out, self.keys)

    def _figures(self) -> list[Column]:
        sizes = [F.coalesce(F.sum(F.when(F.col("_of") == i, F.bit_count("_bits"))), F.lit(0)).cast("bigint").alias(n) for i, n in enumerate(self.distinct)]
        return [*[F.sum(c).alias(c) for c in self.sums], *[F.max(c).alias(c) for c in self.maxima], *sizes]

    def finished(self, parts: DataFrame) -> DataFrame:
        """One row per group: sums, maxima, distinct counts."""
        return parts.groupBy(*self.keys).agg(*self._figures())

    def at_sets(self, parts: DataFrame, sets: Mapping[str, Mapping[str, Column]], name: str = "grouping") -> DataFrame:
        """The figures for several sets of coarser keys, given by name and as columns of the keys: each row is named by its
        set, and keys that are not in the set are NULL."""
        kinds = {c: parts.select(key.alias(c)).schema[c].dataType for keys in sets.values() for c, key in keys.items()}
        asked = [
            F.struct(F.lit(label).alias(name), *[(keys[c] if c in keys else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()])
            for label, keys in sets.items()
        ]
        held = ["_of", "_word", "_bits", *self.sums, *self.maxima]
        spread = parts.select(F.explode(F.array(*asked)).alias("_k"), *held).select("_k.*", *held)
        return self._combined(spread, [name, *kinds]).groupBy(name, *kinds).agg(*self._figures())


_SLOT, _BATCH = "_slot", "_batch"


def apply_delta(spark: SparkSession, path: str, rollup: Rollup, delta: DataFrame, batch: int, slots: int = 64) -> None:
    """Adds a delta to the parts stored at ``path``.

    Groups are dealt into slots, one folder each; only the slots of the delta's groups are read and written again, by
    Spark's dynamic partition overwrite. Batches are numbered upwards. A slot notes the last batch it took and takes none twice,
    so a load that failed half-way is completed by running it again. One writer at a time; a reader during a load may
    see some slots before it and some after.
    """
    slot = F.pmod(F.xxhash64(*rollup.keys), F.lit(slots)).cast("int").alias(_SLOT)
    old = stored_parts(spark, path)
    if old is None:
        rows = rollup.parts(delta).select("*", slot)
    else:
        touched = {r[0] for r in delta.select(slot).distinct().collect()}  # ``slots`` at most
        done = {r[0] for r in old.groupBy(_SLOT).agg(F.max(_BATCH).alias("b")).where(F.col("b") >= batch).collect()}
        fresh = sorted(touched - done)
        if not fresh:
            return
        new = rollup.parts(delta.where(slot.isin(fresh)))
        rows = rollup.merged(old.where(F.col(_SLOT).isin(fresh)).drop(_BATCH, _SLOT), new).select("*", slot)
    rows = materialise(rows.withColumn(_BATCH, F.lit(batch)), "merged-parts")
    dealt = rows.hint("rebalance", F.col(_SLOT))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_SLOT).parquet(path)


def stored_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored parts; None before the first delta."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return None
    return spark.read.parquet(path)
