"""Mixing sources to target weights by hash thresholds: histograms of tokens, nested budgets, no sort.

Every source gets a target number of words. Its documents are taken ``floor(target / source size)`` times whole, and
what remains of the budget is taken once more from the documents whose hash lies below the source's threshold. The
threshold is found by summing words per (source, hash bucket), choosing the bucket in which the running sum crosses the
budget, and splitting only that bucket again, until its documents are told apart by 48 bits of hash.

Defined cases
* A null text has size 0; documents without words take no words. Null is a source of its own, the last in order.
* Repeated rows (same id, same text) share a hash and are taken or left together; which rows are taken depends on
  their content only, so reruns agree.
* A source's taken words differ from its target by at most half of its last document, and mostly far less: small
  documents fill what the last one leaves. A source without a document small enough keeps that difference.
* An empty table gives no rows; if no document has words, all targets are 0. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martmill.session import materialise

BITS, LEVELS = 12, 4  # buckets per step and steps: 48 bits of hash in all


def words(text: str) -> Column:
    """Number of runs of bytes other than blank and 0x09 to 0x0D."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """``target`` of each row of (source, source_size): shares by weight, no target above cap * source_size.

    The sources that stop at their cap are those with the smallest source_size / weight, so a running sum in that
    order finds the level at which the others share the rest: one row per source takes part, never a document.
    """
    order = F.struct(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (
        (F.row_number().over(Window.orderBy(order)) - 1) % len(weights) + 1).cast("int")))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), order)
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - cap * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    ranked = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") > cap * F.col("source_size"))
    share = F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("level")))).over(everything)
    return ranked.select("source", "source_size", F.when(F.col("full") | share.isNull(), cap * F.col("source_size")).otherwise(
        share["level"] * F.col("weight")).cast("double").alias("target"))


def _bucket(level: int) -> Column:
    """The hash bits of one refinement step, the highest first."""
    return F.shiftrightunsigned("hash", 64 - BITS * (level + 1)).bitwiseAND(F.lit(2**BITS - 1)).cast("int")


def _prefix(level: int) -> Column:
    """The hash bits of all steps before ``level`` as a number."""
    return F.shiftrightunsigned("hash", 64 - BITS * level) if level else F.lit(0).cast("long")


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """s, limit and left: the rows of source ``s`` whose first 48 hash bits are below ``limit`` have at most the budget
    in words, and ``left`` of it remains; the rows of the bucket at ``limit`` are added if that comes nearer to it.

    ``budgets`` has the columns s and left, one row per source.
    """
    found = materialise(budgets.select("s", F.col("left").cast("double"), F.lit(0).cast("long").alias("limit"), F.lit(0).cast("long").alias("next")), "mix-level")
    for level in range(LEVELS):
        inside = sized.join(found.select("s", "limit"), sized["source"].eqNullSafe(F.col("s")))
        histogram = inside.where(_prefix(level) == F.col("limit")).groupBy("s", _bucket(level).alias("b")).agg(F.sum("size").alias("w"))
        summed = histogram.withColumn("upto", F.sum("w").over(Window.partitionBy("s").orderBy("b"))).withColumnRenamed("s", "hs")
        c = F.col("c")
        crossed = summed.join(found.select(F.col("s").alias("fs"), "left"), F.col("hs").eqNullSafe(F.col("fs"))).groupBy("hs").agg(
            F.min(F.when(F.col("upto") > F.col("left"), F.struct("b", (F.col("upto") - F.col("w")).alias("below"), "w"))).alias("c"),
            F.max("upto").alias("all"),
        )
        found = materialise(
            found.join(crossed, F.col("s").eqNullSafe(F.col("hs")), "left").select(
                "s", (F.col("left") - F.coalesce(c["below"], F.col("all"), F.lit(0))).alias("left"),
                (F.col("limit") * 2**BITS + F.coalesce(c["b"], F.when(F.col("all").isNull(), 0).otherwise(2**BITS))).cast("long").alias("limit"),
                F.coalesce(c["w"], F.lit(0)).cast("long").alias("next"),
            ),
            "mix-level",
        )
    nearer = (F.col("next") > 0) & (F.col("next") < 2 * F.col("left"))
    return found.select("s", (F.col("limit") + nearer.cast("int")).alias("limit"), F.when(nearer, F.col("left") - F.col("next")).otherwise(F.col("left")).alias("left"))


def _chosen(limit: str) -> Column:
    return F.shiftrightunsigned("hash", 64 - BITS * LEVELS) < F.col(limit)


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=(1.0, 2.0, 3.0), cap: float = 3.0) -> DataFrame:
    """doc_id, hash, source, size, source_size, target, copies and taken of every row: ``taken`` is size * copies.

    A second threshold mends what the last document of the first leaves open: of the documents beyond the first
    threshold, those of at most a quarter of the remaining words fill it.
    """
    sized = materialise(
        df.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"),
                  F.xxhash64(F.col(key), F.col(text), F.lit("mix")).alias("hash")),
        "mix-sizes",
    )
    sizes = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = materialise(source_targets(sizes, weights, cap).withColumnRenamed("source", "s").withColumn("epochs", epochs), "mix-targets")
    first = thresholds(sized, targets.select("s", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("left")))
    first = materialise(first.withColumnRenamed("s", "s1").withColumnRenamed("limit", "limit1"), "mix-first")
    small = sized.join(first, sized["source"].eqNullSafe(F.col("s1"))).where(~_chosen("limit1") & (4 * F.col("size") <= F.col("left"))).select("source", "size", "hash")
    second = thresholds(materialise(small, "mix-small"), first.select(F.col("s1").alias("s"), F.greatest("left", F.lit(0.0)).alias("left")))
    plan = targets.join(first.withColumnRenamed("left", "room"), F.col("s").eqNullSafe(F.col("s1"))).join(
        second.select(F.col("s").alias("s2"), F.col("limit").alias("limit2")), F.col("s").eqNullSafe(F.col("s2")))
    once_more = _chosen("limit1") | ((4 * F.col("size") <= F.col("room")) & _chosen("limit2"))
    copies = F.when(F.col("epochs") + once_more.cast("long") > cap, F.col("epochs")).otherwise(F.col("epochs") + once_more.cast("long"))
    return sized.join(materialise(plan, "mix-plan"), sized["source"].eqNullSafe(F.col("s"))).select(
        "doc_id", "hash", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))
