"""Ranked lexical search by the NRA algorithm: sequential reads of impact-sorted lists, score intervals per document.

``index`` writes a table of postings: documents are numbered within blocks of bounded size, and a row holds one term of
one block with the places of its documents and its occurrences there (the row without a term holds the block's ids and
lengths). ``search`` keeps the rows of the queries' terms, and every block answers every query by itself:

* each term's list is sorted by impact, largest first, and read from the top in rounds, every list of a query in turn;
* a document's lower bound is what has been read of it; its upper bound adds, for each list where it has not come up, the
  impact that list has reached (nothing, once the list is at its end);
* reading ends when no document that reaches the k-th lower bound has an open interval, and an unread one cannot reach
  it. So members, ties and scores are all final.

A block keeps its k best per query, and the best of all blocks follow by rank. No list of a corpus-wide frequent term
meets in one task, and no score or document id passes through the driver; queries go along with their terms' rows, in
chunks.

Score, in whole numbers: w = floor(1000 * ln((2 N + 2) / (2 df + 1))) per term; a document of n terms has
m = 10 + 90 n N div L; a term that occurs tf times adds w * (10^9 tf div (1000 tf + 8 m)).

Defined cases
* Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lower-cased. A null or
  empty text, or one without terms, is no document and counts nowhere; a query without terms gets no rows.
* A document without an id is one; its null id comes last among equal scores. Repeated rows are documents of their own
  and may fill several ranks; a query row that occurs twice is answered twice.
* Fewer than k documents with a score above 0: all are returned. Empty tables give no rows.
* Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martmill.session import materialise

POSTINGS = "block long, term binary, places array<int>, counts array<int>, ids array<long>"
#: Every byte that no term holds becomes a blank, A-Z become a-z; bytes beyond ASCII stay.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(data: bytes | None) -> list[bytes]:
    return data.translate(_TABLE).split() if data else []


def _block_rows(number: int, ids: list[int | None], lengths: list[int], numbers: list[np.ndarray], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """The block's own row, and one row per term, by term number."""
    names = [x.split()[0] for x in POSTINGS.split(", ")]
    one = lambda v, t: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
    yield pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.list_(pa.int32())), one(lengths, pa.int32()), one(ids, pa.int64())], names)
    size = np.int64(len(ids))
    place = np.repeat(np.arange(size), [len(x) for x in numbers])
    code, count = np.unique(np.concatenate(numbers) * size + place, return_counts=True)
    first = np.flatnonzero(np.diff(code // size, prepend=-1))
    words, offsets = list(known), np.append(first, len(code))
    for lo in range(0, len(first), 50_000):
        hi = min(lo + 50_000, len(first))
        at, part = pa.array((offsets[lo : hi + 1] - offsets[lo]).astype(np.int32)), slice(offsets[lo], offsets[hi])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(hi - lo, number)), pa.array(words[lo:hi], pa.binary()), pa.ListArray.from_arrays(at, pa.array((code[part] % size).astype(np.int32))),
             pa.ListArray.from_arrays(at, pa.array(count[part].astype(np.int32))), pa.nulls(hi - lo, pa.list_(pa.int64()))], names)


def _indexer(documents: int, terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def start():
            known: defaultdict[bytes, int] = defaultdict()
            known.default_factory = known.__len__
            return [], [], [], known

        number, held = TaskContext.get().partitionId() << 32, 0
        ids, lengths, numbers, known = start()
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = terms_of(data.as_py())
                if not found:
                    continue
                ids.append(doc_id)
                lengths.append(len(found))
                numbers.append(np.fromiter(map(known.__getitem__, found), np.int64, len(found)))
                held += len(found)
                if held >= terms or len(ids) >= documents:
                    yield from _block_rows(number, ids, lengths, numbers, known)
                    number, held = number + 1, 0
                    ids, lengths, numbers, known = start()
        if ids:
            yield from _block_rows(number, ids, lengths, numbers, known)

    return run


def index(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = 4096, terms: int = 1_000_000) -> DataFrame:
    """The stored postings. A block holds at most so many documents, and ends with the document that reaches so many terms."""
    source = docs.select(F.col(key).cast("long"), F.col(text).cast("string").cast("binary"))
    return materialise(source.mapInArrow(_indexer(documents, terms), POSTINGS), "nra-postings")


def queries_of(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(uid, item_id, term): the distinct terms of every query row, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(u, i, t) for u, i, data in zip(*(batch.column(k).to_pylist() for k in range(3))) for t in sorted(set(terms_of(data)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["uid", "item_id", "term"])

    marked = items.select(F.monotonically_increasing_id(), F.col(key).cast("long"), F.col(text).cast("string").cast("binary"))
    return materialise(marked.mapInArrow(run, "uid long, item_id long, term binary"), "nra-queries")


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one occurrence list adds per unit of weight: 10^9 tf div (1000 tf + 8 m)."""
    exact = int(lengths.max(initial=0)) * 90 * documents < 2**63
    m = 10 + (90 * lengths.astype(np.int64 if exact else object) * documents) // total
    return ((1_000_000_000 * counts.astype(np.int64)) // (1000 * counts.astype(np.int64) + 8 * m)).astype(np.int64)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int, ranks: np.ndarray, depth: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """The k best of n documents (scores above 0, equal ones by ``ranks``) and their scores.

    Each list holds places and impacts, by impact, largest first. ``depth`` entries of every list are read in the first
    round, and twice as many in each that follows.
    """
    lists = [(p, i) for p, i in lists if len(p)]
    lower, seen = np.zeros(n, np.int64), np.zeros((len(lists), n), bool)
    read = 0
    while lists:
        upto, reached = read + depth, np.zeros(len(lists), np.int64)
        for t, (places, impact) in enumerate(lists):
            part = places[read:upto]
            lower[part] += impact[read:upto]
            seen[t, part] = True
            reached[t] = impact[upto - 1] if upto < len(places) else 0  # the next entry adds no more than the last one read
        read, depth = upto, 2 * depth
        found = int((lower > 0).sum())
        least = int(np.partition(lower, n - k)[n - k]) if found >= k else 1  # of the k-th, or of anything that counts
        open_lists = np.flatnonzero(reached)
        if not len(open_lists):
            break
        if reached.sum() >= least:  # a document that no list has shown could still get in
            continue
        near = np.flatnonzero(lower + reached.sum() >= least)
        missing = (reached[open_lists, None] * ~seen[np.ix_(open_lists, near)]).sum(axis=0)
        if not ((missing > 0) & (lower[near] + missing >= least)).any():
            break
    if not lists:
        return np.zeros(0, np.int64), lower[:0]
    best = np.flatnonzero(lower >= least)
    best = best[np.lexsort((ranks[best], -lower[best]))][:k]
    return best, lower[best]


FOUND = "uid long, doc_id long, score long"


def _searcher(documents: int, total: int, k: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """The k best of one block for every query of one chunk."""
        own = table.column("term").is_null().to_numpy(zero_copy_only=False)
        block = table.filter(pa.array(own))
        ids, lengths = block.column("ids")[0].values, block.column("counts")[0].values.to_numpy()
        ranks = np.argsort(np.argsort([i if i is not None else 2**63 - 1 for i in ids.to_pylist()], kind="stable"), kind="stable")
        lists: dict[int, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        rows = table.filter(pa.array(~own))
        for places, counts, weight, uids in zip(rows.column("places"), rows.column("counts"), rows.column("weight").to_pylist(), rows.column("uids").to_pylist()):
            at, counts = places.values.to_numpy(), counts.values.to_numpy()
            impact = impacts(counts, lengths[at], documents, total) * weight
            order = np.argsort(-impact, kind="stable")
            for uid in uids:
                lists[uid].append((at[order], impact[order]))
        out = [(np.full(len(best), uid), ids.take(pa.array(best)), score) for uid, own_lists in lists.items() for best, score in [nra(own_lists, len(lengths), k, ranks)]]
        columns = [np.concatenate([o[0] for o in out]), pa.concat_arrays([o[1] for o in out]), np.concatenate([o[2] for o in out])] if out else [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["uid", "doc_id", "score"])

    return run


def search(postings: DataFrame, queries: DataFrame, k: int = 10, chunk: int = 512, vocabulary: int = 200_000) -> DataFrame:
    """item_id, rank, doc_id, score of each query's k best documents, from ``index`` and ``queries_of``.

    Queries are answered in chunks of about ``chunk``; up to ``vocabulary`` terms of theirs are sent to every task to
    find their postings, more are joined by a shuffle.
    """
    spark = postings.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    documents, total = postings.where("term IS NULL").agg(F.sum(F.size("ids")), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    asked, distinct = queries.agg(F.count_distinct("uid"), F.count_distinct("term")).first()
    if not documents or not asked:
        return empty
    chunks = -(-asked // chunk)
    wanted = queries.groupBy(F.pmod(F.xxhash64("uid"), F.lit(chunks)).alias("chunk"), "term").agg(F.collect_list("uid").alias("uids"))
    few = F.broadcast if distinct * chunks <= vocabulary else lambda df: df  # a term is in each chunk at most once
    held = postings.where("term IS NOT NULL").join(few(wanted.select("term").distinct()), "term", "left_semi")
    frequency = held.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * F.lit(documents) + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weighted = materialise(wanted.join(frequency, "term").select("chunk", "term", weight.alias("weight"), "uids"), "nra-weights")
    lists = held.join(few(weighted), "term").select("block", "chunk", "term", "places", "counts", "ids", "weight", "uids")
    blocks = postings.where("term IS NULL").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), "term", "places", "counts", "ids",
                                                   F.lit(None).cast("long").alias("weight"), F.lit(None).cast("array<long>").alias("uids"))
    found = lists.unionAll(blocks).groupBy("block", "chunk").applyInArrow(_searcher(documents, total, k), FOUND)
    best = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(queries.select("uid", "item_id").distinct(), "uid").select("item_id", "rank", "doc_id", "score")
