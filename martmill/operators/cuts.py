"""Exact order statistics of several columns at once, by nested histograms and without a sort.

Rows are ordered by a metric and, among equal values, by a unique key. A cut is the row of a given rank in that order. A
pass over the rows counts, for every range that still holds a wanted rank, how many rows fall into each of its bins;
only the bins with a wanted rank are looked at in the next pass, and the ranges of all columns share each pass. Once a
value is held by more rows than ``few``, the key decides, piece by piece, in the same way. Ranges of at most ``few`` rows
are read as they are. What reaches the driver is one row per bin and range, and ``few`` rows per cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, TimestampNTZType, TimestampType,
)

# Bytes of a text that one piece of it takes, and the bits that say how many there were.
_PIECE, _SHORT = 6, 3


def order_number(c: Column, kind: DataType, piece: int = 0) -> Column:
    """A number in the order of the values; texts are read ``_PIECE`` bytes at a time."""
    if isinstance(kind, StringType):
        held = F.substring(c.cast("binary"), 1 + _PIECE * piece, _PIECE)
        padded = F.rpad(F.hex(held), 2 * _PIECE, "0")
        return F.conv(padded, 16, 10).cast("decimal(38,0)") * (1 << _SHORT) + F.octet_length(held)
    if isinstance(kind, DecimalType):
        return (c * F.lit(10**kind.scale).cast("decimal(38,0)")).cast("decimal(38,0)") if kind.scale else c.cast("decimal(38,0)")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("decimal(38,0)")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("decimal(38,0)")
    if isinstance(kind, (BooleanType, ByteType, ShortType, IntegerType, LongType)):
        return c.cast("int" if isinstance(kind, BooleanType) else "bigint").cast("decimal(38,0)")
    if isinstance(kind, (FloatType, DoubleType)):  # the bits, of which those of negative numbers count backwards
        bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(c.cast("double"), F.lit(0.0)) + 0.0).cast("bigint")
        return F.when(c.isNotNull(), F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)).cast("decimal(38,0)")
    raise TypeError(f"no order statistics of {kind.simpleString()}")


@dataclass
class _Range:
    """Rows of a metric that share ``fixed`` numbers and lie in [low, high] of the next one (any, if that is not known)."""

    metric: str
    fixed: tuple = ()
    low: int | None = None
    high: int | None = None
    rows: int = 0
    before: int = 0  # rows of the whole table in front of the range
    ranks: list[int] = field(default_factory=list)


class _Order:
    """The numbers that rows are ordered by: the pieces of a metric (one, but for a text), then those of the key."""

    def __init__(self, df: DataFrame, metrics: Sequence[str], key: str):
        self.kinds, self.key = {f.name: f.dataType for f in df.schema.fields}, key
        texts = [m for m in metrics if isinstance(self.kinds[m], StringType)]
        longest = df.agg(*[F.max(F.octet_length(m)) for m in texts]).first() if texts else ()
        self.pieces = {m: 1 for m in metrics} | {m: max(1, -(-(n or 0) // _PIECE)) for m, n in zip(texts, longest)}

    def at(self, metric: str, n: int) -> Column:
        column, piece = (metric, n) if n < self.pieces[metric] else (self.key, n - self.pieces[metric])
        return order_number(F.col(column), self.kinds[column], piece)

    def inside(self, r: _Range) -> Column:
        held = F.lit(True)
        for n, value in enumerate(r.fixed):
            held = held & (self.at(r.metric, n).isNull() if value is None else self.at(r.metric, n) == _whole(value))
        if r.low is not None:
            held = held & self.at(r.metric, len(r.fixed)).between(_whole(r.low), _whole(r.high))
        return F.coalesce(held, F.lit(False))


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def _counted(df: DataFrame, order: _Order, ranges: Sequence[_Range], bins: int) -> list[list[tuple]]:
    """Per range its bins in order, NULLs first: rows, smallest and largest number, and those of the number that follows
    (none, if that is NULL somewhere)."""
    entries = []
    for i, r in enumerate(ranges):
        at = order.at(r.metric, len(r.fixed))
        if r.low is None:
            place = F.when(at.isNull(), -1).otherwise(0)
        else:
            place = F.floor((at - _whole(r.low)) / _whole(-(-(r.high - r.low + 1) // bins)))
        named = F.struct(F.lit(i).alias("i"), place.cast("int").alias("bin"), at.alias("at"), order.at(r.metric, len(r.fixed) + 1).alias("then"))
        entries.append(F.when(order.inside(r), named))
    tagged = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")
    counts = tagged.groupBy("i", "bin").agg(F.count(F.lit(1)), F.min("at"), F.max("at"), F.min("then"), F.max("then"), F.count("then"))
    out: list[list[tuple]] = [[] for _ in ranges]
    for i, _, n, *bounds, known in sorted(counts.collect(), key=lambda x: (x[0], x[1])):  # ``bins`` per range at most
        low, high, then_low, then_high = (None if b is None else int(b) for b in bounds)
        out[i].append((n, low, high, *((then_low, then_high) if known == n else (None, None))))
    return out


def _narrowed(r: _Range, found: list[tuple]) -> list[_Range]:
    """The bins of a range that hold a wanted rank."""
    out, before = [], r.before
    for n, low, high, then_low, then_high in found:
        ranks = [k for k in r.ranks if before < k <= before + n]
        if ranks and low == high:  # one number only: the next one decides
            out.append(_Range(r.metric, (*r.fixed, low), then_low, then_high, n, before, ranks))
        elif ranks:
            out.append(_Range(r.metric, r.fixed, low, high, n, before, ranks))
        before += n
    return out


def cut_rows(df: DataFrame, metrics: Sequence[str], ranks: Callable[[int], Sequence[int]], key: str, bins: int = 1024, few: int = 4096) -> dict[str, list[tuple]]:
    """Per metric the (value, key) of the rows with the ranks that ``ranks`` gives for the number of rows, counted from
    1 in the order of (metric, key), NULL first.

    ``df`` is read once per pass, so it should be stored; keys must be unique.
    """
    order = _Order(df, metrics, key)
    open_ = [_Range(metric) for metric in metrics]
    counted = _counted(df, order, open_, bins)
    wanted = sorted(ranks(sum(found[0] for found in counted[0])))
    for r in open_:
        r.ranks = wanted
    ready: list[_Range] = []
    while open_:
        narrowed = [x for r, found in zip(open_, counted) for x in _narrowed(r, found)]
        ready += [r for r in narrowed if r.rows <= few]
        open_ = [r for r in narrowed if r.rows > few]
        counted = _counted(df, order, open_, bins) if open_ else []
    out: dict[str, list[tuple]] = {metric: [] for metric in metrics}
    if not ready:
        return out
    # A range's rows are few: they are sorted as one list, and the wanted ones are taken out of it.
    entries = [F.when(order.inside(r), F.lit(i)) for i, r in enumerate(ready)]
    hit = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("_range"), F.col(key).alias("_key"), *[F.col(m).alias(f"_m{n}") for n, m in enumerate(metrics)])
    own = [F.col("_range").isin([i for i, r in enumerate(ready) if r.metric == m]) for m in metrics]  # each range is sorted by its own metric
    values = F.struct(*[F.when(o, F.col(f"_m{n}")).alias(f"_m{n}") for n, o in enumerate(own)], "_key")
    lists = hit.groupBy("_range").agg(F.sort_array(F.collect_list(values)).alias("all"))
    places = F.array(*[F.array(*[F.lit(k - r.before - 1) for k in r.ranks]) for r in ready])
    picked = lists.select("_range", F.transform(F.get(places, F.col("_range")), lambda k: F.get("all", k)).alias("rows")).collect()
    for i, rows in picked:
        n = list(metrics).index(ready[i].metric)
        out[ready[i].metric] += [(k, row[f"_m{n}"], row["_key"]) for k, row in zip(ready[i].ranks, rows)]
    return {metric: [x[1:] for x in sorted(found, key=lambda x: x[0])] for metric, found in out.items()}
