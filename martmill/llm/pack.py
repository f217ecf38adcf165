"""Packing token sequences by cutting-stock column generation.

Documents longer than a sequence are cut into full sequences and a rest. The histogram of piece lengths, in steps of
``unit`` tokens, is a cutting-stock problem: a linear program over patterns (how many pieces of each length class
share a sequence) whose columns are priced by a knapsack dynamic program. Rounded patterns are then filled with the
pieces of each class in the order of their rank. The histogram has at most ``capacity / unit`` classes at any input
size, so the program is solved on the driver; ranks, lookups and offsets are Spark's work.

Defined cases
* A null or empty text is the end token alone. Repeated rows are packed each; equal pieces of equal documents (same
  id and content) are counted before they are shuffled and get consecutive ranks.
* A null id is packed like any other. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martmill.llm.stores import kept
from martmill.session import materialise

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordTokenizer:
    """Ids of whole texts from a lower-casing tokenizer that drops white space: each distinct word is encoded once.

    Such a tokenizer never joins text across white space, so a text's ids are those of its words in order, and A-Z may
    be lowered first (but for texts with the marks of special tokens, which are matched before lowering). Words and ids
    are kept up to ``keep`` words, then the store starts afresh; a word's number is its place in the store.
    """

    def __init__(self, path: str, keep: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode, self.keep, self.ends = tokenizer.encode_batch_fast, keep, None
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.ends = np.zeros(tokenizer.get_vocab_size() + 1, bool)
            self.ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.ids, self.count, self.first = np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.used = 0

    def _encoded(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Words of letters alone are encoded many in one text and told apart by the ids that end a
        word, if the vocabulary marks these."""
        plain = [i for i, w in enumerate(words) if w.isalpha()] if self.ends is not None else []
        out: list = [None] * len(words)
        for a in range(0, len(plain), 512):
            part = plain[a : a + 512]
            ids = np.array(self.encode([" ".join([words[i] for i in part])], add_special_tokens=False)[0].ids)
            lists = np.split(ids, np.flatnonzero(self.ends[ids]) + 1)[:-1]
            if len(lists) == len(part):
                for i, own in zip(part, lists):
                    out[i] = own
        rest = [i for i, own in enumerate(out) if own is None]
        for i, e in zip(rest, self.encode([words[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def _learn(self, words: list[bytes]) -> None:
        lists = self._encoded([w.decode() for w in words])
        old, count = len(self.known) - len(words), np.fromiter(map(len, lists), np.int32, len(lists))
        more = np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum()))
        for name, size in (("ids", self.used + len(more)), ("count", old + len(words)), ("first", old + len(words))):
            if size > len(getattr(self, name)):
                setattr(self, name, np.resize(getattr(self, name), 2 * size))
        self.ids[self.used : self.used + len(more)] = more
        self.count[old : old + len(words)] = count
        self.first[old : old + len(words)] = self.used + np.cumsum(count) - count
        self.used += len(more)

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.known) > self.keep:
            self.forget()
        old, number, places = len(self.known), self.known.__getitem__, []
        for text in texts:
            words = (text.encode("utf-8", "replace") if "<|" in text else text.encode("utf-8", "replace").lower()).split()
            places.append(np.fromiter(map(number, words), np.int64, len(words)))
        if len(self.known) > old:
            self._learn(list(islice(reversed(self.known), len(self.known) - old))[::-1])
        for at in places:
            count = self.count[at]
            yield self.ids[np.repeat(self.first[at] - (np.cumsum(count) - count), count) + np.arange(count.sum())]


def _tokenizer(path: str) -> WordTokenizer:
    """One store per worker process, kept from task to task until another operator runs there."""
    return kept(("tokenizer", path), lambda: WordTokenizer(path))


def cut(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """The pieces of every document: full sequences and a rest, the end token included."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for whole in batches:
            rows = []
            for part in (whole.slice(a, 128) for a in range(0, whole.num_rows, 128)):
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), tokenizer(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for a in range(0, len(ids), capacity):
                        piece = ids[a : a + capacity]
                        rows.append((doc_id, a, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5,
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(pieces, PIECES)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The best value of a pattern, and how many of each class it holds."""
    best, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        fit = sizes <= w
        gain = np.where(fit, best[np.where(fit, w - sizes, 0)] + values, -1.0)
        c = int(gain.argmax())
        best[w], chosen[w] = (gain[c], c) if gain[c] > best[w - 1] else (best[w - 1], -1)
    pattern, w = np.zeros(len(sizes), np.int64), capacity
    while w > 0:
        if chosen[w] < 0:
            w -= 1
        else:
            pattern[chosen[w]] += 1
            w -= sizes[chosen[w]]
    return best[capacity], pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (as rows) and their fractional use: revised simplex, columns priced by the knapsack program.

    Stops when no pattern has a negative reduced cost, or the bound objective / knapsack value shows that the
    objective is within ``gap`` of the optimum.
    """
    each = capacity // sizes
    patterns = np.diag(each).astype(float)  # column c: a sequence of class c alone
    inverse, use = np.diag(1.0 / each), demand / each
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        value, pattern = knapsack(np.maximum(duals, 0), sizes, capacity)
        if value <= 1 + gap:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        use = np.maximum(use - ratio[leave] * step, 0)
        use[leave] = ratio[leave]
        inverse[leave] /= step[leave]
        others = np.arange(len(sizes)) != leave
        inverse[others] -= np.outer(step[others], inverse[leave])
        patterns[:, leave] = pattern
    return patterns.T.astype(np.int64), use


def plan_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, how often) that hold every piece: the program's patterns rounded down, then the largest that fit."""
    if not len(sizes):
        return []
    left, out = demand.astype(np.int64).copy(), []
    patterns, use = column_generation(sizes, demand, capacity)
    for pattern, times in sorted(zip(patterns, use), key=lambda x: -int(x[0] @ sizes)):
        held = pattern > 0
        times = min(int(times + 1e-6), int((left[held] // pattern[held]).min())) if held.any() else 0
        if times:
            out.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern, room = np.zeros(len(sizes), np.int64), capacity
        for c in np.argsort(-sizes):
            pattern[c] = min(left[c], room // sizes[c])
            room -= pattern[c] * sizes[c]
        held = pattern > 0
        times = int((left[held] // pattern[held]).min())
        out.append((pattern, times))
        left -= times * pattern
    return out


def _intervals(sizes: np.ndarray, plan: list[tuple[np.ndarray, int]]) -> dict[int, np.ndarray]:
    """By class: rows of (first rank, first sequence, pieces per sequence, first slot), by first rank."""
    out, taken, sequence = {int(s): [] for s in sizes}, np.zeros(len(sizes), np.int64), 0
    for pattern, times in plan:
        slot = 0
        for c in np.flatnonzero(pattern):
            out[int(sizes[c])].append((taken[c], sequence, pattern[c], slot))
            taken[c] += times * pattern[c]
            slot += pattern[c]
        sequence += times
    return {c: np.array(rows, np.int64) for c, rows in out.items()}


def pack(pieces: DataFrame, capacity: int = 2048, unit: int = 8, cells: int = 128) -> DataFrame:
    """Adds sequence_id and offset to the rows of ``cut``."""
    size = F.ceil(F.col("length") / unit).cast("int")
    stored = materialise(
        pieces.groupBy("doc_id", "start", "length", "ids_crc32", "doc_tokens").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("size", size).withColumn("cell", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(cells)).cast("int")),
        "pack-pieces",
    )
    histogram = {r["size"]: r["n"] for r in stored.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # capacity / unit rows at most
    sizes = np.array(sorted(histogram), np.int64)
    intervals = _intervals(sizes, plan_patterns(sizes, np.array([histogram[s] for s in sizes.tolist()], np.int64), capacity // unit))

    before = Window.partitionBy("size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored.groupBy("size", "cell").agg(F.sum("n").alias("rows")).select("size", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("size", "cell").orderBy("doc_id", "start", "ids_crc32", "length", "doc_tokens").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("shift") + F.coalesce(F.col("earlier"), F.lit(0))
    ranked = stored.withColumn("earlier", F.sum("n").over(within)).join(F.broadcast(offsets), ["size", "cell"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "size", F.explode(F.sequence(first, first + F.col("n") - 1)).alias("rank"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for c in np.unique(size):
                own, table = size == c, intervals[int(c)]
                first_rank, first_sequence, per, first_slot = table[np.searchsorted(table[:, 0], rank[own], side="right") - 1].T
                sequence[own] = first_sequence + (rank[own] - first_rank) // per
                slot[own] = first_slot + (rank[own] - first_rank) % per
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(slot)], [*names, "sequence_id", "slot"])

    placed = ranked.mapInArrow(assign, PIECES + ", sequence_id long, slot long")
    earlier = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")).drop("slot")
