"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A row descends region, rack and shard, and the largest draw wins at each level. A shard draws ln(u) / weight, where u in
(0, 1) is a hash of the row's key and the shard's name; the draw of a rack is the largest of its shards', that of a
region the largest of its racks'. The largest of such draws is distributed like one draw with the summed weight, so a
subtree is won in proportion to its weight, and a change of weight moves rows only into or out of the subtree that
changed. (With draws of their own, racks and regions would let a shard that joins them move rows to its neighbours.)
A node shares its weight among its children in proportion to theirs.

A shard's place in the tree and its draw do not depend on the number of shards, so for every number one more shard takes
rows only into itself, and a run with that number gives what ``grown_shard`` says.

Defined cases
* A null key is hashed like a key of its own: such rows share a shard. A null text has size 8 and the CRC of no bytes.
* Repeated rows go to one shard and take slots of their own. Slots are given by cell (a hash of the row), then key,
  CRC and size; equal rows are counted before they are shuffled, so that a frequent row is one row there.
* An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martmill.session import materialise

Tree = Sequence[tuple[str, float, object]]


def balanced_tree(shards: int = 24, racks: int = 2, regions: int = 3) -> Tree:
    """Shards 0 to ``shards - 1`` of weight 1, dealt over the racks of the regions: (name, weight, children) per node."""
    out = []
    for region in range(min(regions, shards)):
        members = []
        for rack in range(racks):
            ids = range(region + regions * rack, shards, regions * racks)
            if ids:
                members.append((f"region{region}/rack{rack}", float(len(ids)), [(f"shard{i}", 1.0, i) for i in ids]))
        out.append((f"region{region}", sum(m[1] for m in members), members))
    return out


def draw(key: Column, name: str, weight: float) -> Column:
    """ln(u) / weight with u from the upper 52 bits of a hash of key and shard."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12).cast("double") + 0.5) / float(2**52)
    return F.ln(u) / F.lit(float(weight))


def _winner(key: Column, tree: Tree, total: float) -> Column:
    """The largest draw below a node of weight ``total``, as (draw, shard); an exact tie goes to the larger shard."""
    of_children, found = sum(weight for _, weight, _ in tree), []
    for name, weight, below in tree:
        share = total * weight / of_children
        if isinstance(below, int):
            found.append(F.struct(draw(key, name, share).alias("draw"), F.lit(below).cast("int").alias("shard")))
        else:
            found.append(_winner(key, below, share))
    return F.greatest(*found) if len(found) > 1 else found[0]


def descend(key: Column, tree: Tree) -> Column:
    """The shard of a key: the child with the largest draw at each level."""
    return _winner(key, tree, sum(weight for _, weight, _ in tree))["shard"]


def shard_rows(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 24, cells: int = 1024) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    Slots: equal rows are counted, each shard's rows fall into ``cells`` cells, rows are numbered within a cell and
    shifted by the rows of the shard's earlier cells. At most ``shards * cells`` offsets are broadcast.
    """
    value = F.col(key)
    compact = (
        df.select(
            value.cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        )
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("shard", descend(F.col("doc_id"), balanced_tree(shards)))
        .withColumn("grown_shard", descend(F.col("doc_id"), balanced_tree(shards + 1)))
        .withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32", "size", F.lit("cell")), F.lit(cells)).cast("int"))
    )
    stored = materialise(compact, "shards")
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("shard", "cell").agg(F.sum("n").alias("rows")).select(
        "shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored.withColumn("earlier", F.coalesce(F.sum("n").over(within), F.lit(0))).join(F.broadcast(offsets), ["shard", "cell"])
    first = F.col("offset") + F.col("earlier")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(first, first + F.col("n") - 1)).alias("slot"), "grown_shard",
    )
