"""Ranks over a whole table, and the scores built on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martmill.operators.cuts import cut_rows
from martmill.session import materialise

# monotonically_increasing_id() keeps the partition above bit 33, the row below it.
_ROW_BITS = 33


def _placed(df: DataFrame, order_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with their slice and place in a global order, and per slice the rows before it.

    The sort columns are spread by range over all tasks. Since they end in a unique key, a
    value shared by a third of the rows is cut into several slices as well. The
    slices are written out before they are counted: range bounds come from a
    sample, and a recomputed sample could move rows between slices.
    """
    ordered = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    stored = materialise(ordered, "rank")
    placed = stored.withColumn("_slice", F.shiftright("_at", _ROW_BITS)).withColumn(
        "_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    # One row per slice, so this window and the broadcast are as small as the shuffle is wide.
    sizes = placed.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        "_slice",
        (F.sum("_n").over(Window.orderBy("_slice")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(Window.partitionBy()).alias("_total"),
    )
    return placed.drop("_at"), before


def rank_first(df: DataFrame, metric: str, tiebreak: str, name: str = "rank", total: str | None = None) -> DataFrame:
    """Ranks 1..n by ``metric``, ties in order of the unique ``tiebreak``, without a one-task sort."""
    placed, before = _placed(df, [metric, tiebreak])
    ranked = placed.join(F.broadcast(before), "_slice").withColumn(
        name, F.col("_before") + F.col("_row") + F.lit(1)
    )
    if total:
        ranked = ranked.withColumnRenamed("_total", total)
    return ranked.drop("_slice", "_row", "_before", "_total")


def _cut_ranks(n: int, q: int) -> list[int]:
    """The last rank of every bucket but the highest: rank r of n falls into bucket ceil((r - 1) * q / (n - 1)), at least 1."""
    return [b * (n - 1) // q + 1 for b in range(1, q)] if n > 1 else []


def quantile_buckets(df: DataFrame, metrics: Mapping[str, tuple[str, bool]], tiebreak: str, q: int = 5, stored: bool = False) -> DataFrame:
    """Cut each metric at evenly spaced quantiles of its ranks into ``q`` labelled buckets, several metrics at a time.

    ``metrics`` maps a column to the label's name and whether labels ascend with it. Linear quantiles of the
    ranks, not NTILE: rank r of n falls into bucket ceil((r - 1) * q / (n - 1)), at least 1, in whole numbers
    throughout; equal values go by the unique ``tiebreak``, NULL comes first. A single row is in bucket 1 before labels are reversed.

    The rows are stored once (not again, if ``stored`` says that they are) and never sorted or shuffled: the rows at the cuts are found by nested histograms
    (``operators.cuts``), and every row is compared with them.
    """
    df = df if stored else materialise(df, "buckets")
    cuts = cut_rows(df, list(metrics), lambda n: _cut_ranks(n, q), tiebreak)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    labels = {}
    for metric, (name, ascending) in metrics.items():
        place = F.struct(F.col(metric).alias("v"), F.col(tiebreak).alias("k"))
        label = F.lit(1)
        for value, key in cuts[metric]:
            cut = F.struct(F.lit(value).cast(kinds[metric]).alias("v"), F.lit(key).cast(kinds[tiebreak]).alias("k"))
            label = label + (place > cut).cast("int")
        labels[name] = (label if ascending else F.lit(q + 1) - label).cast("int")
    return df.withColumns(labels)


def quantile_bucket(
    df: DataFrame, metric: str, tiebreak: str, name: str, q: int = 5, ascending: bool = True
) -> DataFrame:
    """``quantile_buckets`` of one metric."""
    return quantile_buckets(df, {metric: (name, ascending)}, tiebreak, q)


def rfm_metrics(
    lines: DataFrame,
    customer: str = "customer_id",
    ordered_at: str = "ordered_at",
    order: str = "order_id",
    amount: str = "product_price",
) -> DataFrame:
    """Recency, frequency and value per customer.

    Recency counts whole days back from the last order of the whole table, orders
    without a customer included. That date is taken from the customer-level result,
    which is stored once, so the order lines are read a single time.
    """
    per_customer = materialise(
        lines.groupBy(customer).agg(
            F.max(ordered_at).alias("_last"),
            F.countDistinct(order).alias("order_frequency"),
            F.coalesce(F.sum(amount), F.lit(0)).alias("lifetime_value"),
        ),
        "rfm",
    )
    return rfm_of(per_customer, customer)


def rfm_of(per_customer: DataFrame, customer: str = "customer_id") -> DataFrame:
    """The metrics from stored customer figures: ``_last`` order, ``order_frequency``, ``lifetime_value``."""
    snapshot = per_customer.agg(F.max("_last")).scalar()
    elapsed = F.extract(F.lit("DAY"), snapshot - F.col("_last"))
    return per_customer.filter(F.col(customer).isNotNull()).select(
        customer, elapsed.cast("int").alias("recency_days"), "order_frequency", "lifetime_value"
    )


# Segment names, tested from top to bottom.
SEGMENTS = ("Champions", "Loyal Customers", "Potential Loyalists", "At-Risk", "Hibernating")


def rfm_segments(metrics: DataFrame, customer: str = "customer_id", stored: bool = False) -> DataFrame:
    """Quintile scores, the three-digit score text and the customer segment; ``stored``: the metrics come from a table."""
    scored = quantile_buckets(
        metrics, {"recency_days": ("_r", False), "order_frequency": ("_f", True), "lifetime_value": ("_m", True)}, customer, stored=stored
    )
    r, f = F.col("_r"), F.col("_f")
    best, loyal, recent, fading, lost = SEGMENTS
    segment = (
        F.when((r >= 4) & (f >= 4), best)
        .when((r >= 3) & (f >= 3), loyal)
        .when(r >= 3, recent)
        .when(r >= 2, fading)
        .otherwise(lost)
    )
    score = F.concat(*[F.col(c).cast("string") for c in ("_r", "_f", "_m")])
    return scored.select(
        customer,
        "recency_days",
        "order_frequency",
        "lifetime_value",
        score.alias("rfm_score"),
        segment.alias("customer_segment"),
    )
