"""Cross-tokenizer alignment against a brute-force reading of the whole texts, and the monoid's laws."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from martmill.llm import align
from martmill.llm.ship import shipped

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{i % 97}x{i % 31}" for i in range(900))
TEXTS = [
    "The cat sat on the mat.\nAnd the dog ran away.", None, "", " ", "  \t\n ", "Ärger über größere Mäuse", "a  b   c\n\n d \t e\r\n f", "x ", " x", "\nx", "漢字テスト 😀 ok", "one<|endoftext|>two <s> </s> <0x41> <unk>", "bad ▁ piece",
    LONG, LONG, "y" * 700, "z" * 500 + " " + "q" * 900 + " end", "   x 　\ny\u0085 z", "fin\x1c \x1fa", "if (x) {\r\n  y();\r\n}\r\n", "é " * 300, "The cat sat on the mat.\nAnd the dog ran away.", "ﬁ Ａ ² don't we'll I'm  'S", "tab\there", "\x00 nul\x00", "#### token = \"0123\" \n\n\n  code",
]


@pytest.fixture(scope="module")
def pair():
    return align.Pair(A, B)


def tokens_of(pair, text):
    """Both id lists of a blank and the text, from the tokenizers on the whole text; none if bytes differ."""
    if not text:
        return [], []
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    if text.strip(" ") == "":
        b = pair.b.encode(text)
    data = (" " + text).encode()
    same = b"".join(pair.a_bytes[i] for i in a) == data == b"".join(pair.b_bytes[i] for i in b)
    return (a, b) if same else ([], [])


def brute(pair, rows):
    """The contract's columns, by comparing all pairs of neighbouring byte ranges."""
    linked, docs = [], defaultdict(set)
    for n, (_, text) in enumerate(rows):
        a, b = tokens_of(pair, text)
        ranges = []
        for ids, table in ((a, pair.a_bytes), (b, pair.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            ranges.append(own)
        links, j = [], 0
        for lo, hi, x in ranges[0]:
            while j and ranges[1][j - 1][1] > lo:
                j -= 1
            while j < len(ranges[1]) and ranges[1][j][0] < hi:
                if ranges[1][j][1] > lo:
                    links.append((x, ranges[1][j][2]))
                j += 1
        ends = sorted({r[1] for r in ranges[0]} & {r[1] for r in ranges[1]})
        groups, start = [], 0
        for e in ends:
            groups.append(",".join(str(i) for lo, hi, i in ranges[0] if start < hi <= e) + "|" + ",".join(str(i) for lo, hi, i in ranges[1] if start < hi <= e))
            start = e
        for p in links:
            docs[p].add(n)
        linked.append((len(a), len(b), groups, links))
    top = Counter()
    for (x, y), of in docs.items():
        top[x] = max(top[x], len(of))
    return Counter((key, n_a, n_b, len(groups), len(links), sum(len(docs[p]) == top[p[0]] for p in links), sum(len(docs[p]) for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for (key, _), (n_a, n_b, groups, links) in zip(rows, linked))


def frame(spark, rows):
    return shipped(spark).createDataFrame([(k, t, 1, "x", 2) for k, t in rows], "doc_id long, text string, uid int, pairs string, block int").repartition(3)


NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("span", [65_536, 64, 7])
def test_align(spark, pair, span):
    rows = [(i if i != 4 else None, t) for i, t in enumerate(TEXTS)] + [(3, "The cat"), (3, "The cat")]
    got = align.align(frame(spark, rows), A, B, span=span, block=2000, fan=2)
    assert tuple(got.columns) == NAMES
    assert Counter(map(tuple, got.collect())) == brute(pair, rows)


def test_empty_table(spark):
    assert align.align(frame(spark, []), A, B).count() == 0
    assert align.align(frame(spark, [(1, None)]), A, B).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")


def random_text(r):
    return "".join(r.choice(["a", "the", " ", "  ", "\n", "\t", "é", "漢", "ing", "0", ".", "\r\n", " ", "'s", "😀", "{"]) for _ in range(r.randint(1, 60)))


def test_words_are_read_apart(pair):
    r = random.Random(5)
    for _ in range(400):
        text = random_text(r)
        words = align.WORDS.findall(" " + text)
        assert "".join(words) == " " + text
        found = list(pair.encode(words))
        a, b = tokens_of(pair, text)
        if a:
            assert [i for x, _ in found for i in x] == a and [i for _, y in found for i in y] == b, text
        else:
            assert None in found


def test_stretches_cover_every_byte(pair):
    r = random.Random(6)
    for _ in range(300):
        text, span = random_text(r) + "x" * r.choice([0, 0, 40]) + random_text(r), r.choice([1, 3, 8, 30])
        data, low, whole = (" " + text).encode(), 0, align.NONE
        for start, lo, hi, part in align.stretches(text, span):
            assert lo == low and start <= lo and data[start:].startswith(part.encode()) and start + len(part.encode()) >= hi
            tokens = pair.tokens(part, start)
            whole, low = whole.followed(tokens.within(lo, hi)), hi
        assert low == len(data) and (whole.a.tolist(), whole.b.tolist()) == tokens_of(pair, text)


def test_composition_is_associative(pair):
    r = random.Random(7)
    for _ in range(100):
        tokens = pair.tokens(" " + "".join(c for c in random_text(r) + "supercalifragilistic unbelievably" if c.isalnum() or c == " "))
        end = int(tokens.a_end[-1])
        cuts = sorted({0, end, *(r.randint(0, end) for _ in range(6))})
        parts = [align.fragment(tokens.within(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]

        def tree(parts):
            if len(parts) == 1:
                return parts[0]
            k = r.randint(1, len(parts) - 1)
            return align.compose(tree(parts[:k]), tree(parts[k:]))

        want = align.spelled(tokens)[0]
        for _ in range(3):
            runs = align.closed(tree(parts))
            assert ";".join(align.spelled(t)[0] for t in runs) == want
            assert sorted(np.concatenate([align.linked(t) for t in runs])) == sorted(align.linked(tokens))
