"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

A tokenizer A (byte-level BPE) and a tokenizer B (pieces with byte fallback) both cover a blank followed by the text.
Byte offsets where tokens of both end cut the tokens into groups. A *fragment* is what a stretch of bytes knows of this:
the tokens up to the first common end (open head), the closed groups behind it, and the tokens after the last common end
(open tail); without a common end all its tokens are open. Fragments compose: the left one's tail and the right one's
head become one closed group. Composition is associative, so any tree over the stretches of a text gives the same groups.

Both tokenizers read the words of a text apart, where a word begins at a blank or line feed behind a character that is
no white space. So
* a text up to ``span`` bytes is the product of its words' fragments, each closed at both ends. A worker keeps the
  fragments of words it has met; a block of texts stores which words each text holds, and how often;
* a longer text is cut at every multiple of ``span`` bytes, wherever in a word that falls. A stretch's task reads from
  the word around its start to the word around its end and keeps the tokens that end inside the stretch. Fragments then
  meet ``fan`` at a time, round by round, in different tasks. A cut inside a word longer than a stretch moves to
  the word's end, as nobody can read half of such a word.

The number of documents that hold an id pair linked is summed by block before it is shuffled; blocks then fetch the
totals of their own distinct pairs. No table of pairs is sent to every task.

Defined cases
* A text that is null, empty or not valid UTF-8, or one that either tokenizer does not give back byte for byte (the
  character U+2581, for instance), has no tokens: zeros and an empty digest. Ids and marks of special tokens in a text are plain text.
* A null id is a document like any other; repeated rows are documents of their own, and each counts.
* An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.llm.stores import kept
from martmill.session import materialise

BLANK = "▁"
#: A word: white space that begins with a blank or line feed, and what follows up to the next such place.
WORDS = re.compile(r"[ \n]\s*\S*(?:[^\S \n]\s*\S*)*")
#: The same places in bytes: a blank or line feed behind anything but white space.
STARTS = re.compile(rb"(?<![\t-\r\x1c- ])(?<!\xc2\x85)(?<!\xc2\xa0)(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80)[ \n]")
OPEN = ("a", "a_end", "b", "b_end")


# --- the monoid ------------------------------------------------------------------------------------------------------


class Tokens(NamedTuple):
    """Ids of both tokenizers in order, and the byte offsets where they end."""

    a: np.ndarray
    a_end: np.ndarray
    b: np.ndarray
    b_end: np.ndarray

    def within(self, low: int, high: int) -> Tokens:
        """Those that end after ``low`` and not after ``high``."""
        x, y = np.searchsorted(self.a_end, (low, high), side="right")
        z, w = np.searchsorted(self.b_end, (low, high), side="right")
        return Tokens(self.a[x:y], self.a_end[x:y], self.b[z:w], self.b_end[z:w])

    def followed(self, other: Tokens) -> Tokens:
        return Tokens(*(np.concatenate(x) for x in zip(self, other)))


NONE = Tokens(*(np.zeros(0, np.int64),) * 4)


class Fragment(NamedTuple):
    """Open head, runs of closed groups in order, open tail; without a common end ``runs`` is None and all is head."""

    head: Tokens
    runs: list[Tokens] | None
    tail: Tokens


def fragment(tokens: Tokens) -> Fragment:
    ends = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)
    if not len(ends):
        return Fragment(tokens, None, NONE)
    first, last = int(ends[0]), int(ends[-1])
    inner = tokens.within(first, last)
    return Fragment(tokens.within(-1, first), [inner] if len(inner.a) else [], tokens.within(last, 2**62))


def compose(x: Fragment, y: Fragment) -> Fragment:
    if x.runs is None:
        return Fragment(x.head.followed(y.head), y.runs, y.tail)
    if y.runs is None:
        return Fragment(x.head, x.runs, x.tail.followed(y.head))
    return Fragment(x.head, [*x.runs, x.tail.followed(y.head), *y.runs], y.tail)


def closed(x: Fragment) -> list[Tokens]:
    """The runs of groups of a whole text: its start is a common end, so the head is closed, too."""
    return [t for t in (x.head, *(x.runs or ()), x.tail) if len(t.a)]


def linked(tokens: Tokens) -> np.ndarray:
    """A id * 2^32 + B id of every overlapping pair of complete groups: between two ends lies one token of each."""
    ends = np.union1d(tokens.a_end, tokens.b_end)
    a, b = tokens.a[np.searchsorted(tokens.a_end, ends)], tokens.b[np.searchsorted(tokens.b_end, ends)]
    return (a.astype(np.int64) << 32) | b.astype(np.int64)


def spelled(tokens: Tokens) -> tuple[str, int]:
    """Groups as text, and their number."""
    ends = np.intersect1d(tokens.a_end, tokens.b_end, assume_unique=True)
    a, b = tokens.a.tolist(), tokens.b.tolist()
    x, y = [0, *np.searchsorted(tokens.a_end, ends, side="right").tolist()], [0, *np.searchsorted(tokens.b_end, ends, side="right").tolist()]
    return ";".join(f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}" for i, k, j, m in zip(x, x[1:], y, y[1:])), len(ends)


# --- the two tokenizers ----------------------------------------------------------------------------------------------


class Pair:
    """Both tokenizers, with the bytes of every id."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level BPE shows these bytes as themselves,
        letter = {chr(c): c for c in shown} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in shown)}  # others from 256 on
        size = max(self.a.get_vocab().values()) + 1
        self.a_bytes = [b""] * size
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(letter.get(c, 63) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = np.array([*map(len, self.a_bytes)]), np.array([*map(len, self.b_bytes)])
        self.blank = self.b.piece_to_id(BLANK)
        if any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in pieces):
            raise ValueError("a piece goes on over a blank or line feed behind something else, so words can't be read apart")

    def encode(self, parts: list[str]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Ids of A and B of each part, which begins with white space; None if they do not give back its bytes."""
        b_ids = self.b.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)  # B puts a blank before
        for part, a, b in zip(parts, self.a.encode_batch_fast(parts, add_special_tokens=False), b_ids):
            a, data = a.ids, part.encode()
            if part == " ":
                b = [self.blank]
            elif part[0] != " ":
                b = b[1:] if b and b[0] == self.blank else []
            good = b"".join(map(self.a_bytes.__getitem__, a)) == data == b"".join(map(self.b_bytes.__getitem__, b))
            yield (a, b) if good else None

    def read(self, words: list[str], together: int = 1000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all words, one word after the other, and both numbers per word; none for a word that
        cannot be read. Words that end in anything but white space are encoded many in one text."""
        a_ids: list[np.ndarray] = []
        b_ids: list[np.ndarray] = []
        counts = np.zeros((len(words), 2), np.int64)
        for first in range(0, len(words), together):
            part = words[first : first + together]
            found = self._joined(part) if not any(w[-1].isspace() for w in part) else None
            if found is None:
                lists = [x or ([], []) for x in self.encode(part)]
                found = *(np.array([i for x in lists for i in x[k]], np.int64) for k in (0, 1)), np.array([[len(x), len(y)] for x, y in lists])
            a_ids.append(found[0])
            b_ids.append(found[1])
            counts[first : first + together] = found[2]
        return np.concatenate(a_ids), np.concatenate(b_ids), counts

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        text = "".join(words)
        data, word_ends = text.encode(), np.cumsum([len(w.encode()) for w in words])
        a, b = self.a.encode(text, add_special_tokens=False).ids, self.b.encode("a" + text)
        counts, lead = [], 0
        while lead < len(b) and self.b_size[b[:lead]].sum() < 2:  # the blank that B puts before, and the "a"
            lead += 1
        b = b[lead:]
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        for ids, sizes in ((a, self.a_size), (b, self.b_size)):
            ends = np.cumsum(sizes[ids])
            at = np.searchsorted(ends, word_ends)
            if (ends[at] != word_ends).any():
                return None
            counts.append(np.diff(at + 1, prepend=0))
        return np.array(a, np.int64), np.array(b, np.int64), np.stack(counts, axis=1)

    def tokens(self, part: str, start: int = 0) -> Tokens | None:
        found = next(self.encode([part]))
        if found is None:
            return None
        a, b = np.array(found[0], np.int64), np.array(found[1], np.int64)
        return Tokens(a, start + np.cumsum(self.a_size[a]), b, start + np.cumsum(self.b_size[b]))


def _pair(a_path: str, b_path: str) -> Pair:
    return kept(("pair", a_path, b_path), lambda: Words(Pair(a_path, b_path))).pair


class Words:
    """The closed fragments of the words met so far: groups as text, numbers of tokens and groups, numbered links.

    Words are forgotten between blocks when there are more than ``keep``.
    """

    def __init__(self, pair: Pair, keep: int = 150_000) -> None:
        self.pair, self.keep = pair, keep
        self.forget()

    def forget(self) -> None:
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.pairs: defaultdict[int, int] = defaultdict()  # number of an id pair
        self.pairs.default_factory = self.pairs.__len__
        self.text: list[bytes] = []
        self.counts = np.zeros((0, 4), np.int32)  # tokens of A, of B, groups, links; no tokens: the word can't be read
        self.first, self.links, self.used = np.zeros(0, np.int64), np.zeros(0, np.int32), 0

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The words of each text, by number, in order."""
        words = [WORDS.findall(" " + t) if t else [] for t in texts]
        old = len(self.known)
        at = [np.fromiter(map(self.known.__getitem__, w), np.int64, len(w)) for w in words]
        if len(self.known) > old:
            self._learn([*islice(reversed(self.known), len(self.known) - old)][::-1], old)
        return at

    def _learn(self, words: list[str], old: int) -> None:
        pair, new = self.pair, old + len(words)
        a, b, tokens = pair.read(words)
        a_end, b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        # every word that can be read has the same bytes in both, so the ends of all words agree
        ends = np.union1d(a_end, b_end)
        last_a, last_b = np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)
        common = ends[(a_end[last_a] == ends) & (b_end[last_b] == ends)] if len(ends) else ends
        word_of_a = np.repeat(np.arange(len(words)), tokens[:, 0])
        links = np.bincount(word_of_a[last_a], minlength=len(words))
        groups = np.bincount(word_of_a[np.searchsorted(a_end, common)], minlength=len(words))
        keys, number = np.unique((a[last_a] << 32) | b[last_b], return_inverse=True)
        own = np.fromiter(map(self.pairs.__getitem__, keys.tolist()), np.int32, len(keys))[number]
        if new > len(self.counts):
            self.counts, self.first = np.resize(self.counts, (2 * new, 4)), np.resize(self.first, 2 * new)
        if self.used + len(own) > len(self.links):
            self.links = np.resize(self.links, 2 * (self.used + len(own)))
        self.counts[old:new] = np.column_stack((tokens, groups, links))
        self.links[self.used : self.used + len(own)] = own
        self.first[old:new] = self.used + np.cumsum(links) - links
        self.used += len(own)
        self.text += _texts(a, a_end, b, b_end, common, tokens)

    def links_of(self, numbers: np.ndarray) -> np.ndarray:
        """The numbered links of words, one after the other."""
        n = self.counts[numbers, 3].astype(np.int64)
        return self.links[np.repeat(self.first[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]

    def pair_ids(self) -> np.ndarray:
        return np.fromiter(self.pairs, np.int64, len(self.pairs))


def _texts(a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, common: np.ndarray, tokens: np.ndarray) -> list[bytes]:
    """The groups of each word as text: every id in decimal, with the sign that follows it."""
    group = np.concatenate((2 * np.searchsorted(common, a_end), 2 * np.searchsorted(common, b_end) + 1))
    order = np.argsort(group, kind="stable")
    ids, at = np.concatenate((a, b)), np.concatenate((a_end, b_end))
    last = np.isin(at, common)
    sign = np.where(last, np.where(np.arange(len(ids)) < len(a), ord("|"), ord(";")), ord(","))[order]
    ids, width = ids[order], len(str(int(ids.max(initial=0))))
    powers = 10 ** np.arange(width - 1, -1, -1)
    shown = np.concatenate((ids[:, None] // powers % 10 + ord("0"), sign[:, None]), axis=1).astype(np.uint8)
    wanted = np.concatenate((ids[:, None] >= powers, np.ones((len(ids), 1), bool)), axis=1)
    wanted[:, width - 1] = True  # id 0
    data, ends = shown[wanted].tobytes(), np.append(0, np.cumsum(wanted.sum(axis=1)))
    ends = ends[np.append(0, np.cumsum(tokens.sum(axis=1)))].tolist()
    return [data[x : max(x, y - 1)] for x, y in zip(ends, ends[1:])]


def _decoded(value: bytes | None) -> str:
    try:
        return (value or b"").decode()
    except UnicodeDecodeError:
        return ""


# --- texts of one stretch: products of words ------------------------------------------------------------------------

BLOCKS = (
    "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "words array<int>, times array<int>, pairs array<long>"
)
DOCUMENT, DICTIONARY, TOTALS = 0, 1, 2


class _Block:
    """Texts of one task, up to a number of bytes: one row each, one with the links of their words, one with the number
    of texts that hold each pair."""

    def __init__(self, number: int, words: Words) -> None:
        if len(words.known) > words.keep:
            words.forget()
        self.number, self.words, self.rows, self.held, self.bytes = number, words, [], [], 0
        self.counts = np.zeros(0, np.int32)

    def add(self, doc_ids: list[int | None], data: list[bytes | None]) -> None:
        words, texts = self.words, [*map(_decoded, data)]
        self.bytes += sum(len(d) for d in data if d)
        for doc_id, numbers in zip(doc_ids, words.numbers(texts)):
            sums = words.counts[numbers]
            if not len(numbers) or not sums[:, 0].all():
                self.rows.append((doc_id, 0, 0, 0, 0, ""))
                self.held.append((numbers[:0], numbers[:0]))
                continue
            digest = hashlib.sha256(b";".join(map(words.text.__getitem__, numbers.tolist()))).hexdigest()
            self.rows.append((doc_id, *sums.sum(axis=0, dtype=np.int64).tolist(), digest))
            distinct, times = np.unique(numbers, return_counts=True)
            self.held.append((distinct.astype(np.int32), times.astype(np.int32)))
            if len(words.pairs) > len(self.counts):
                self.counts = np.concatenate((self.counts, np.zeros(2 * len(words.pairs) - len(self.counts), np.int32)))
            self.counts[np.unique(words.links_of(distinct))] += 1

    def batches(self) -> Iterator[pa.RecordBatch]:
        words = self.words
        number, ids = np.unique(np.concatenate([x for x, _ in self.held]), return_inverse=True)
        ends = np.cumsum([0] + [len(x) for x, _ in self.held])
        times = np.concatenate([y for _, y in self.held])
        for lo in range(0, len(self.rows), 2000):  # rows of moderate batches
            hi = min(lo + 2000, len(self.rows))
            at = pa.array((ends[lo : hi + 1] - ends[lo]).astype(np.int32))
            part = slice(ends[lo], ends[hi])
            yield self._batch(DOCUMENT, list(zip(*self.rows[lo:hi])), pa.ListArray.from_arrays(at, pa.array(ids[part].astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(times[part].astype(np.int32))), None)
        pair_ids = words.pair_ids()
        sizes = words.counts[number, 3].astype(np.int32)
        yield self._batch(DICTIONARY, None, _one(sizes, pa.int32()), None, _one(pair_ids[words.links_of(number)], pa.int64()))
        held = np.flatnonzero(self.counts)
        yield self._batch(TOTALS, None, None, _one(self.counts[held], pa.int32()), _one(pair_ids[held], pa.int64()))

    def _batch(self, kind: int, rows, words, times, pairs) -> pa.RecordBatch:
        n = len(rows[0]) if rows else 1
        columns = [pa.array([kind] * n, pa.int32()), pa.array([self.number] * n, pa.int64())]
        columns += [pa.array(c, t) for c, t in zip(rows or [[None]] * 6, [pa.int64()] * 5 + [pa.string()])]
        columns += [pa.nulls(n, pa.list_(t)) if x is None else x for x, t in ((words, pa.int32()), (times, pa.int32()), (pairs, pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in BLOCKS.split(", ")])


def _one(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _blocks(a_path: str, b_path: str, size: int, many: int = 128):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = kept(("pair", a_path, b_path), lambda: Words(Pair(a_path, b_path)))
        number, block = TaskContext.get().partitionId() << 32, None
        for whole in batches:
            for batch in (whole.slice(i, many) for i in range(0, whole.num_rows, many)):
                block = block or _Block(number, words)
                block.add(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                if block.bytes >= size:
                    yield from block.batches()
                    number, block = number + 1, None
        if block:
            yield from block.batches()

    return run


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _looked_up(blocks: pa.Table, totals: pa.Table) -> pa.Table:
    """One block's rows with the totals of their links."""
    kind = blocks.column("kind").to_numpy()
    rows = blocks.filter(pa.array(kind == DOCUMENT)).combine_chunks()
    names = [x.split()[0] for x in RESULT.split(", ")]
    best, summed = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
    dictionary = blocks.filter(pa.array(kind == DICTIONARY))
    if totals.num_rows:
        sizes = dictionary.column("words").combine_chunks().flatten().to_numpy()
        links = dictionary.column("pairs").combine_chunks().flatten().to_numpy()
        order = np.argsort(totals.column("pair").to_numpy())
        at = order[np.searchsorted(totals.column("pair").to_numpy(), links, sorter=order)]
        word = np.repeat(np.arange(len(sizes)), sizes)
        of_word = [np.zeros(len(sizes), np.int64) for _ in range(2)]
        for out, values in zip(of_word, (totals.column("best").to_numpy(zero_copy_only=False), totals.column("total").to_numpy())):
            np.add.at(out, word, values[at].astype(np.int64))
        held = rows.column("words").combine_chunks()
        ids, times = held.flatten().to_numpy(), rows.column("times").combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(rows.num_rows), np.diff(held.offsets.to_numpy()))
        for out, values in zip((best, summed), of_word):
            np.add.at(out, row, values[ids] * times)
    columns = {n: rows.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")} | {"n_best": pa.array(best), "count_sum": pa.array(summed)}
    return pa.table([columns[n] for n in names], names)


# --- longer texts: fragments of stretches, composed over tasks -----------------------------------------------------------

STRETCHES = "uid long, doc_id long, at long, start long, low long, high long, part string"


def stretches(text: str, span: int) -> Iterator[tuple[int, int, int, str]]:
    """(start of the part, low, high, part) of each stretch of a blank and the text."""
    data = (" " + text).encode()

    def around(b: int) -> tuple[int, int]:
        """The word's start at or before b, and at or after it."""
        after = STARTS.search(data, b)
        before = b
        while not STARTS.match(data, before):
            before = max(data.rfind(b" ", 0, before), data.rfind(b"\n", 0, before))
        return before, after.start() if after else len(data)

    low, start = 0, 0
    while low < len(data):
        high = (low // span + 1) * span
        if high < len(data):
            before, after = around(high)
            if after - before > span:
                high = before = after
        else:
            high = before = after = len(data)
        yield start, low, high, data[start:after].decode()
        low, start = high, before


def _stretched(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in STRETCHES.split(", ")]
        for batch in batches:
            for uid, doc_id, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = _decoded(data)
                for at, (start, low, high, part) in enumerate(stretches(text, span) if text else [(0, 0, 0, "")]):
                    yield pa.RecordBatch.from_pylist([dict(zip(names, (uid, doc_id, at, start, low, high, part)))], pa.schema(
                        [(n, pa.string() if n == "part" else pa.int64()) for n in names]))

    return run


_OPENS = ", ".join(f"{side}_{x} array<long>" for side in ("head", "tail") for x in OPEN)
FRAGMENTS = f"uid long, at long, cut boolean, {_OPENS}, place long, run string, n_groups long, pairs array<long>, times array<int>"
_FRAGMENT_NAMES = [x.split()[0] for x in FRAGMENTS.split(", ")]


def _fragment_row(uid: int, at: int | None, x: Fragment | None, run: Tokens | None) -> dict:
    """A fragment without its runs (``at`` is null: none), and one run of closed groups, ordered by ``place``."""
    row = dict.fromkeys(_FRAGMENT_NAMES) | {"uid": uid, "at": at}
    if x is not None:
        row |= {"cut": x.runs is not None} | {f"{side}_{n}": v.tolist() for side in ("head", "tail") for n, v in zip(OPEN, getattr(x, side))}
    if run is not None and len(run.a):
        pairs, times = np.unique(linked(run), return_counts=True)
        text, groups = spelled(run)
        row |= {"place": int(run.a_end[0]), "run": text, "n_groups": groups, "pairs": pairs.tolist(), "times": times.tolist()}
    return row


def _fragment_schema() -> pa.Schema:
    kinds = {"array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in FRAGMENTS.split(", "))])


def _fragments(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        schema = _fragment_schema().append(pa.field("bad", pa.bool_())).append(pa.field("n_a", pa.int64())).append(pa.field("n_b", pa.int64()))
        for batch in batches:
            for r in batch.to_pylist():
                tokens = pair.tokens(r["part"], r["start"]) if r["part"] else None
                own = NONE if tokens is None else tokens.within(r["low"], r["high"])
                found = fragment(own)
                row = _fragment_row(r["uid"], r["at"], found, found.runs[0] if found.runs else None)
                yield pa.RecordBatch.from_pylist([row | {"bad": tokens is None, "n_a": len(own.a), "n_b": len(own.b)}], schema)

    return run


def _opened(row: dict) -> Fragment:
    head, tail = (Tokens(*(np.array(row[f"{side}_{n}"], np.int64) for n in OPEN)) for side in ("head", "tail"))
    return Fragment(head, [] if row["cut"] else None, tail)


def _composer(fan: int, last: bool):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """The product of neighbouring fragments, and a row for each run that their meeting closes."""
        uid, at = (k.as_py() for k in key)
        whole = None
        for row in sorted(table.to_pylist(), key=lambda r: r["at"]):
            whole = _opened(row) if whole is None else compose(whole, _opened(row))
        runs = closed(whole) if last else whole.runs or []
        rows = [_fragment_row(uid, None, None, t) for t in runs]
        if not last:
            rows.append(_fragment_row(uid, at, whole, None))
        return pa.Table.from_pylist(rows, _fragment_schema())

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per text from its runs in order, read one by one."""
    uid, digest, out = None, None, []
    for batch in batches:
        for own, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != uid:
                out += [(uid, digest.hexdigest())] if digest else []
                uid, digest = own, hashlib.sha256()
                digest.update(run.encode())
            else:
                digest.update(b";" + run.encode())
    out += [(uid, digest.hexdigest())] if digest else []
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.string())], ["uid", "groups_sha256"])


def _long_texts(docs: DataFrame, a_path: str, b_path: str, span: int, fan: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """(uid, doc_id, n_a, n_b, good), the closed runs and the fragments' counts of texts over ``span`` bytes."""
    marked = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    parts = materialise(marked.mapInArrow(_stretched(span), STRETCHES), "align-stretches")
    longest = parts.agg(F.max("at")).first()[0]
    if longest is None:
        return None
    spread = parts.repartition(F.xxhash64("uid", "at"))
    first = materialise(spread.mapInArrow(_fragments(a_path, b_path), FRAGMENTS + ", bad boolean, n_a long, n_b long"), "align-fragments")
    texts = parts.where("at = 0").select("uid", "doc_id").join(
        first.groupBy("uid").agg((~F.max("bad")).alias("good"), F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")), "uid")
    columns, state, n = _FRAGMENT_NAMES, first, longest + 1
    runs = first.select(*columns)
    while True:
        groups = state.where("at IS NOT NULL").select("uid", F.floor(F.col("at") / fan).alias("at_"), *columns[1:]).groupBy("uid", "at_")
        n = -(-n // fan)
        state = materialise(groups.applyInArrow(_composer(fan, n == 1), FRAGMENTS), "align-composed")
        runs = runs.unionAll(state)
        if n == 1:
            break
    return texts, runs.where("place IS NOT NULL").select("uid", "place", "run", "n_groups", "pairs", "times"), first


# --- the operator ------------------------------------------------------------------------------------------------------


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", span: int = 65_536, block: int = 8 << 20, fan: int = 8) -> DataFrame:
    """Per row: numbers of tokens, groups and links, links that are their A id's most frequent, documents summed over
    links, and the digest of the groups."""
    source = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = F.octet_length("text")
    binary = F.col("text").cast("binary").alias("text")
    short = source.where(F.col("text").isNull() | (size <= span)).select("doc_id", binary)
    stored = materialise(short.mapInArrow(_blocks(a_path, b_path, block), BLOCKS), "align-blocks")
    held = stored.where(F.col("kind") == TOTALS).select("block", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.times").alias("n"))
    counts = held.select("pair", "n")

    long = _long_texts(source.where(size > span).select("doc_id", binary), a_path, b_path, span, fan)
    if long:
        texts, runs, _ = long
        runs = runs.join(texts.where("good").select("uid"), "uid", "left_semi")
        own = runs.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).groupBy("uid", F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("times"))
        own = materialise(own, "align-long-links")
        counts = counts.unionAll(own.select("pair", F.lit(1)))
    totals = counts.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("a", F.shiftright("pair", 32))
    top = totals.groupBy("a").agg(F.max("total").alias("top"))
    totals = materialise(totals.join(top, "a").select("pair", "total", (F.col("total") == F.col("top")).alias("best")), "align-totals")

    fetched = held.select(F.col("block").alias("of"), "pair").join(totals, "pair")
    out = stored.where(F.col("kind") != TOTALS).groupBy("block").cogroup(fetched.groupBy("of")).applyInArrow(_looked_up, RESULT)
    if not long:
        return out
    sums = own.join(totals, "pair").groupBy("uid").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("total")).alias("count_sum"))
    groups = runs.groupBy("uid").agg(F.sum("n_groups").alias("n_groups"))
    digests = runs.select("uid", "place", "run").repartition("uid").sortWithinPartitions("uid", "place").select("uid", "run").mapInArrow(_digests, "uid long, groups_sha256 string")
    whole = texts.join(groups, "uid", "left").join(sums, "uid", "left").join(digests, "uid", "left")
    number = lambda c: F.when(F.col("good"), F.coalesce(F.col(c), F.lit(0))).otherwise(0).cast("long").alias(c)
    return out.unionAll(whole.select("doc_id", *map(number, ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), F.when(F.col("good"), F.col("groups_sha256")).otherwise("").alias("groups_sha256")))
