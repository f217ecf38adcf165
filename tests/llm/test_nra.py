"""Ranked search against scoring every document, and the stop rule of the reads."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from martmill.llm import nra
from martmill.llm.ship import shipped

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=10):
    terms = lambda t: [x.translate(LOWER) for x in TERM.findall(t)] if t else []
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total, df = len(held), sum(s for *_, s in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, s in held:
            m = 100 - 90 + (90 * s * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            scores += [(-score, i is None, i)] if score > 0 else []
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def frames(spark, docs, items):
    spark = shipped(spark)
    return (spark.createDataFrame([(i, t, 1, "x", 0) for i, t in docs], "doc_id long, text string, block int, term string, score int").repartition(3),
            spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, uid int"))


def made():
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)] + ["Straße", "naïve", "漢字", "ÀB", "the", "a-b", "x_1"]
    docs = [(i, " ".join(r.choice(words[: r.choice([8, 67])]) for _ in range(r.choice([1, 5, 30, 200])))) for i in range(300)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(40)] + [(5, docs[5][1]), (None, "w1 w2 w3"), (None, None), (2000, ""), (2001, " .,!? \n"), (2002, "w3 " * 20_000), (2003, "THE Straße"), (2004, "the STRASSE")]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 12, 50])))) for i in range(25)] + [(3, "w1"), (3, "w1"), (None, "w2 w2"), (90, None), (91, ""), (92, "nowhere"), (93, "!!")]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"documents": 7}, {"terms": 50}])
def test_search(spark, settings):
    docs, items = made()
    d, i = frames(spark, docs, items)
    got = nra.search(nra.index(d, **settings), nra.queries_of(i), chunk=10, vocabulary=0 if settings else 1000)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute(docs, items)


def test_nothing_to_search(spark):
    docs, items = made()
    for a, b in (([], items), (docs, []), ([(1, None), (2, "?")], items), (docs, [(1, None)])):
        d, i = frames(spark, a, b)
        assert nra.search(nra.index(d), nra.queries_of(i)).collect() == []


def test_reads_end_early_and_final():
    r = np.random.default_rng(3)
    n, k = 4000, 10
    read = []
    for _ in range(60):
        lists, sums = [], np.zeros(n, np.int64)
        for _ in range(r.integers(1, 6)):
            places = r.permutation(n)[: r.integers(1, n)]
            impact = np.sort((r.pareto(0.5, len(places)) * 10).astype(np.int64).clip(0, 10**9))[::-1]
            sums[places] += impact
            lists.append((places, impact))
        best, scores = nra.nra(lists, n, k, np.arange(n), depth=4)
        order = np.lexsort((np.arange(n), -sums))[:k]
        order = order[sums[order] > 0]
        assert best.tolist() == order.tolist() and scores.tolist() == sums[order].tolist()
    one = (np.arange(n), np.arange(n, 0, -1) * 10)

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop)
            return super().__getitem__(at)

    assert nra.nra([(one[0], one[1].view(Watched))], n, k, np.arange(n), depth=4)[0].tolist() == list(range(k))
    assert max(read) < 100  # of 4000


def test_lengths_beyond_64_bits():
    assert nra.impacts(np.array([3]), np.array([2_000_000_000]), 10**9, 10**12).tolist() == [3_000_000_000 // (3000 + 8 * (10 + 90 * 2_000_000_000 * 10**9 // 10**12))]
