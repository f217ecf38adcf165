"""Document fingerprints from closed syncmers, in DataFrame functions only.

A text's tokens are its runs of up to 24 characters other than blank and 0x09 to 0x0D. Characters of longer runs, and
those of scripts written without blanks (Chinese, Japanese, Thai, Lao, Tibetan, Burmese, Khmer), are tokens one by one.
A k-mer of tokens is an anchor if the smallest hash of its s-mers is that of its first or last one. Whether a k-mer is
an anchor depends on its own tokens alone, so equal passages give equal anchors wherever they stand, and anchors with
their positions can be matched between texts. Two texts are matched by all their distinct anchors, each at its first
place: ``in_order`` gives the most common anchors that follow each other in both texts, and nearness is their share of
all distinct anchors of both. The fingerprint, the ``SKETCH`` smallest distinct anchor hashes, is a key to look up texts
with; ``likeness`` of two fingerprints only estimates how many anchors are common.

Defined cases
* A null text is empty. A text with tokens but no closed k-mer (always with fewer than k tokens) is one anchor; one
  without tokens has none and an empty fingerprint. Two texts without tokens have nearness 1, one without and another 0.
* A null id comes after all others. Rows with one id follow each other in the order of a hash of their text; equal
  rows follow each other and are counted before they are shuffled. A single row is its own next document.
* An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martmill.session import materialise

BLANK = r"\x20\x09-\x0D"
UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u19e0-\u19ff\u3000-\u30ff\u31f0-\u31ff\u3400-\u9fff\uaa60-\uaa7f\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff"
SPACED = f"[^{BLANK}{UNSPACED}]"
TOKEN = f"(?<!{SPACED}){SPACED}{{1,24}}+(?!{SPACED})|[^{BLANK}]"  # a run is never cut by its start: that would move all cuts behind an insertion
K, S, SKETCH = 5, 2, 64
KEY = ["absent", "id", "h"]


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the anchors of a text as (position, hash), in order of position (tokens from 0)."""
    h, g, n = f"{out}_h", f"{out}_g", F.size(f"{out}_h")
    df = df.withColumn(h, F.transform(F.regexp_extract_all(F.col(text), F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x)))
    df = df.withColumn(g, F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1))))
    first, last, inner = lambda i: F.get(g, i), lambda i: F.get(g, i + 3), lambda i: F.least(F.get(g, i + 1), F.get(g, i + 2))
    closed = lambda i: F.least(first(i), last(i)) <= inner(i)
    kmer = lambda i: F.shiftright(F.xxhash64(F.get(g, i), F.get(g, i + 2), F.get(h, i + 4)), 32).cast("int")
    places = F.when(n >= K, F.filter(F.sequence(F.lit(0), F.greatest(n - K, F.lit(0))), closed)).otherwise(F.array().cast("array<int>"))
    whole = F.array(F.struct(F.lit(0).alias("position"), F.shiftright(F.xxhash64(h), 32).cast("int").alias("hash")))
    found = F.transform(places, lambda i: F.struct(i.cast("int").alias("position"), kmer(i).alias("hash")))
    df = df.withColumn(out, found)
    return df.withColumn(out, F.when((n > 0) & (F.size(out) == 0), whole).otherwise(F.col(out))).drop(h, g)


def sketch(anchors: Column, size: int = SKETCH) -> Column:
    """The smallest distinct hashes of an anchor list, ascending."""
    return F.slice(F.sort_array(F.array_distinct(F.transform(anchors, lambda a: a["hash"]))), 1, size)


def likeness(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Share of the smallest hashes of both sketches that both hold."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(F.array_intersect(union, a), b)) / F.greatest(F.size(union), F.lit(1)))


def _firsts(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds ``out``: hash * 2^32 + place of the first of each distinct hash, by hash."""
    df = df.withColumn(out, F.sort_array(F.transform(hashes, lambda x, i: F.shiftleft(x.cast("long"), 32) + i)))
    return df.withColumn(out, F.filter(out, lambda x, i: (i == 0) | (F.shiftright(x, 32) != F.shiftright(F.get(out, i - 1), 32))))


def in_order(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``: how many distinct hashes of the lists ``a`` and ``b`` follow each other in both, at their first places.

    Equal hashes stand side by side once both lists are sorted together. The places in ``b``, in the order of ``a``, then
    give the longest rising chain: ``low[k]`` is the lowest place at which a chain of k + 1 ends.
    """
    both, places, low31 = f"{out}_m", f"{out}_p", F.lit(2**31 - 1)
    side = F.lit(2**31).cast("long")  # the second list sorts after the first
    none, first, second = F.array().cast("array<int>"), f"{out}_a", f"{out}_b"
    shared = F.arrays_overlap(a, b)
    df = df.withColumn(first, F.when(shared, F.col(a)).otherwise(none)).withColumn(second, F.when(shared, F.col(b)).otherwise(none))
    df = _firsts(_firsts(df, first, first), second, second)
    df = df.withColumn(both, F.sort_array(F.concat(first, F.transform(second, lambda x: x + side)))).drop(first, second)
    hash_of = lambda x: F.shiftright(x, 32)
    follower = lambda i: F.get(both, i + 1)
    met = F.transform(both, lambda x, i: F.when(hash_of(x) == hash_of(follower(i)), F.shiftleft(x.bitwiseAND(low31), 32) + follower(i).bitwiseAND(low31)))
    df = df.withColumn(places, F.transform(F.sort_array(F.filter(met, lambda x: x.isNotNull())), lambda x: x.bitwiseAND(low31)))

    def step(low: Column, x: Column) -> Column:
        k = F.size(F.filter(low, lambda y: y < x))
        inner = F.concat(F.slice(low, F.lit(1), k), F.array(x), F.slice(low, k + 2, F.size(low)))
        return F.when((F.size(low) == 0) | (F.element_at(low, -1) < x), F.concat(low, F.array(x))).otherwise(inner)

    chain = F.aggregate(places, F.array().cast("array<long>"), step, F.size)
    return df.withColumn(out, F.when(F.col(places) == F.sort_array(places), F.size(places)).otherwise(chain)).drop(both, places)


def nearness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds ``out``: the share of the distinct hashes of both lists that is common and in the same order."""
    n = f"{out}_n"
    df = in_order(df, a, b, n)
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - F.col(n)
    return df.withColumn(out, F.when(union == 0, 1.0).otherwise(F.col(n) / F.greatest(union, F.lit(1)))).drop(n)


def fingerprint(hashes: Column) -> Column:
    """A sketch as lowercase hex, 8 digits a hash."""
    return F.array_join(F.transform(hashes, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def _followers(keys: DataFrame) -> DataFrame:
    """``keys`` with the key of the next row in the order absent, id, h as struct ``next``; the last row's is the first.

    Rows are range-partitioned into slices and stored; a slice's last row takes the first of the next slice, from a
    table of one row per slice.
    """
    order, here = [F.col(c) for c in KEY], F.struct(*KEY)
    slices = materialise(keys.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "syncmer-order")
    firsts = slices.groupBy("slice").agg(F.min(here).alias("first"))
    everything = Window.partitionBy()
    after = firsts.select("slice", F.coalesce(F.lead("first").over(Window.orderBy("slice")), F.min("first").over(everything)).alias("after"))
    following = F.lead(here).over(Window.partitionBy("slice").orderBy(*order))
    return slices.withColumn("following", following).join(F.broadcast(after), "slice").select(*KEY, "n", "n_chars", F.coalesce("following", "after").alias("next"))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    Texts are shuffled once, by id and hash; each then receives its follower's anchors and the passage that replaces its end.
    """
    rows = df.select(F.col(key).isNull().alias("absent"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    keys = rows.groupBy(*KEY, F.char_length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("n"))
    order = materialise(_followers(keys), "syncmer-next").withColumn("m", F.floor(F.col("n_chars") / 4).cast("int"))
    texts = rows.dropDuplicates(KEY)
    wanted = order.select(*[F.col("next")[c].alias(c) for c in KEY], F.struct(*KEY).alias("of"), "m")
    hashes = lambda c: F.transform(c, lambda x: x["hash"])
    supplied = with_anchors(texts.join(wanted, KEY), "text", "anchors").select(*[F.col("of")[c].alias(c) for c in KEY], F.left("text", F.col("m")).alias("passage"), hashes("anchors").alias("c"))
    own = texts.join(order, KEY).join(supplied, KEY)

    # Of n equal rows, the last is followed by the next document and the others by their own text.
    kept = F.left("text", (F.col("n_chars") - F.col("m")).cast("int"))
    cases = F.array(
        F.struct(F.lit(1).cast("long").alias("rows"), F.lit(False).alias("again"), F.concat(kept, "passage").alias("edited")),
        F.struct((F.col("n") - 1).alias("rows"), F.lit(True).alias("again"), F.concat(kept, F.left("text", F.col("m"))).alias("edited")),
    )
    own = own.withColumn("case", F.explode(F.filter(cases, lambda c: c["rows"] > 0))).select("absent", "id", "n_chars", "text", "c", "case.*")
    own = with_anchors(with_anchors(own, "text", "anchors"), "edited", "edited_anchors").withColumn("a", hashes("anchors")).withColumn("b", hashes("edited_anchors"))
    own = nearness(nearness(own, "a", "b", "near_edited"), "a", "c", "near_next")
    return own.select(
        F.when(~F.col("absent"), F.col("id")).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(sketch(F.col("anchors"))).alias("fingerprint"), fingerprint(sketch(F.col("edited_anchors"))).alias("edited_fingerprint"),
        "near_edited", F.when(F.col("again"), 1.0).otherwise(F.col("near_next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("copy"),
    ).drop("copy")
