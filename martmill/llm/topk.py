"""Exact top-k search by inner product: term-at-a-time accumulation over postings, partition selection, merge.

Defined cases
* A vector that is null, or holds a null or non-finite component, takes no part, and no row without an id does.
* Components beyond a vector's length count as zero; an empty vector scores 0 against everything.
* Rows with the query's own id are never its candidates. Every other row is one candidate, so repeated rows can
  fill several ranks, and a query row that occurs twice is answered twice.
* Ties go to the smaller id. Fewer candidates than k: all are returned. No queries or no candidates: no rows.
* Other columns of the table, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martmill.session import materialise

LOWEST = -(2**63)


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, factor: float = 256.0) -> DataFrame:
    """Columns ``id`` and ``vector``: floor(factor * x) of every component, for the rows that take part."""
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(factor) * x.cast("double"))).alias("vector"),
    )


def _matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column as a matrix, zero beyond each row's length."""
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max([0, *lengths]) if width is None else width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keep = at < out.shape[1]  # a term that no query has adds nothing
    out[row[keep], at[keep]] = values[keep]
    return out


def _score_type(queries: np.ndarray, rows: np.ndarray):
    """The smallest number type that holds every inner product exactly."""
    bound = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, rows.shape[1])
    return np.int32 if bound < 2**30 else np.int64 if bound < 2**62 else object


def accumulate(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores [row, query]: for each term, its posting list is weighted by the queries and scattered into the scores."""
    kind = _score_type(queries, rows)
    queries, rows = queries.astype(kind), rows.astype(kind)
    scores = np.zeros((len(rows), len(queries)), kind)
    for term in range(rows.shape[1]):
        weights = queries[:, term]
        if not weights.any():
            continue
        posting = np.flatnonzero(rows[:, term])
        if len(posting) == len(rows):
            scores += np.multiply.outer(rows[:, term], weights)
        elif len(posting):
            scores[posting] += np.multiply.outer(rows[posting, term], weights)
    return np.clip(scores, LOWEST + 1, 2**63 - 1).astype(np.int64) if kind is object else scores


def _select(scores: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of every row that reaches the k-th score of a query in this tile; all ties stay."""
    lowest = np.iinfo(scores.dtype).min
    own = np.nonzero(ids[:, None] == query_ids[None, :])
    scores[own] = lowest
    at = max(0, len(ids) - k)
    least = np.partition(scores, at, axis=0)[at]
    row, query = np.nonzero((scores >= least) & (scores > lowest))
    return query, ids[row], scores[row, query].astype(np.int64)


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.searchsorted(query, query, side="left")
    keep = np.arange(len(query)) - first < k
    return query[keep], ids[keep], scores[keep]


def _searcher(block, k: int, tile: int, width: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids, query_ids, queries = block.value
        found = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            ids = batch.column("id").to_numpy()
            rows = _matrix(batch.column("vector"), queries.shape[1])
            for a in range(0, len(ids), tile):
                parts = [found]
                for q in range(0, len(uids), width):
                    scores = accumulate(queries[q : q + width], rows[a : a + tile])
                    query, vec, score = _select(scores, ids[a : a + tile], query_ids[q : q + width], k)
                    parts.append((query + q, vec, score))
                found = _best(*(np.concatenate(x) for x in zip(*parts)), k)
        query, vec, score = found
        if len(query):
            yield pa.RecordBatch.from_arrays([pa.array(uids[query]), pa.array(query_ids[query]), pa.array(vec), pa.array(score)], ["uid", "query_id", "vec_id", "score"])

    return search


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = 8192, tile: int = 1024, width: int = 128) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    Both frames have the columns of ``integer_vectors``. Queries are taken in blocks of about ``block`` rows, the only
    data sent whole to the tasks; each block meets every candidate in one pass, each task keeps its k best per query,
    and these are merged per query.
    """
    spark = candidates.sparkSession
    stored = materialise(queries.withColumn("uid", F.monotonically_increasing_id()), "topk-queries")
    blocks = -(-stored.count() // block)
    partial = None
    for b in range(blocks):
        rows = stored.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == b).orderBy("uid").toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        vectors = _matrix(rows.column("vector").combine_chunks())
        sent = spark.sparkContext.broadcast((rows.column("uid").to_numpy(), rows.column("id").to_numpy(), vectors))
        part = candidates.select("id", "vector").mapInArrow(_searcher(sent, k, tile, width), "uid long, query_id long, vec_id long, score long")
        partial = part if partial is None else partial.unionAll(part)
    if partial is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
