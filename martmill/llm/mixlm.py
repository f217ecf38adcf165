"""Language-model scores by logistic context mixing.

A text is its words (lower-case A-Z) and one end, spelled byte by byte with a terminator after each word; the end is an
empty word. Each symbol is a path of binary decisions in a prefix code. Three predictors give every bit a log odds:
the spelling so far in its word, and the last three bytes with the class the text seems to belong to, both hashed into
slots whose counts come from the training words of the whole corpus, and the spelling so far in a hashed table of this
text alone. Weights chosen by a gate (what each predictor has seen) mix them, and a correction by the mixed odds
refines the result. Beside its spelling, a word can come by name, with its share of the training words of the corpus, of
one class (a training label, such as the language) or of the text so far; how much each way counts is learned, too. Every
word is spelled, however frequent it is. All that is learned starts anew with each text, from values fitted to all
training texts, and is taught by every block after that block has been scored; blocks double from 8 words. The words' log
probabilities add up to the text's.

The starting values: every training text is read once as it will be scored, but with weights that stay, and with its own
occurrences of each word taken out of the word's counts and of its bits'. Slopes and curvatures of all texts' bits add up
by gate and bucket, and one damped Newton step over all weights and corrections together gives where texts start.

Word counts are exact: each split of the corpus sends its distinct words with their training counts to hash ranges, which
add them up and send every split the corpus counts of its words; the texts wait as word numbers. Only the two tables of
bit counts (2 * SLOTS slots each, whatever the input), the sums of the Newton step (some 8000 numbers) and one number per
byte reach the driver.

Defined cases
* A null or empty text is the end alone. Equal texts get equal scores. Repeated rows are scored, and learned from, each.
* Rows without an id count as the id ''. Nothing to learn from: all counts are 0, the bits' odds start even.
* An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martmill.llm.shingles import mixed
from martmill.session import materialise

TERMINATOR = 256
SLOTS = 2**22
LOCAL = 2**12
GATES = 100
BUCKETS = 24
RATE, PACE, PRIOR = 0.05, 1.0, 6.0
SPLIT_WORDS = 1_000_000
FIRST_BLOCK, LAST_BLOCK, GROUP_WORDS = 8, 1024, 65536
GROUP_TEXTS = 512
BITS_AT_ONCE = 131_072  # a step's arrays
WORDS_A_TASK = 1_000_000
CHUNKS = 16
DAMPING, LONGEST_STEP = 4.0, 1.0  # of the step from the first weights to those that texts start from
CROSS = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]  # pairs of predictors
EVIDENCE = GATES * (3 + len(CROSS)) + 3 * GATES * BUCKETS + 2 * BUCKETS
LOCAL_BITS = LOCAL.bit_length()  # of a place in a text's own table with the bit's value
CONTEXT_AT = LOCAL_BITS + 3  # the rest of a bit's description, after the state of its word slot


class Code:
    """A prefix code over the 256 bytes and the terminator, from their counts: nodes and bits of every symbol's path."""

    def __init__(self, counts: np.ndarray) -> None:
        heap = [(float(c) + 1.0, s, None) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        nodes = TERMINATOR + 1
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            heapq.heappush(heap, (a[0] + b[0], nodes, (a, b)))
            nodes += 1
        paths: dict[int, list[tuple[int, int]]] = {}
        todo = [(heap[0], [])]
        while todo:
            (_, name, below), path = todo.pop()
            if below is None:
                paths[name] = path
            else:
                todo += [(child, [*path, (name, bit)]) for bit, child in enumerate(below)]
        self.length = np.array([len(paths[s]) for s in range(TERMINATOR + 1)])
        self.start = np.cumsum(self.length) - self.length
        self.nodes, self.bits = (np.array([step[i] for s in range(TERMINATOR + 1) for step in paths[s]]) for i in (0, 1))


class Spelling:
    """The bits of a list of distinct words, word after word: ``first`` and ``count`` by word; per bit its value, its
    slots in the two corpus tables and in a text's own table."""

    def __init__(self, words: list[bytes], code: Code, block: int = 1000) -> None:
        if len(words) > block:  # in blocks, to keep the steps between small
            parts = [Spelling(words[a : a + block], code) for a in range(0, len(words), block)]
            for name in ("bit", "slot", "recent", "local", "count"):
                setattr(self, name, np.concatenate([p.__dict__.pop(name) for p in parts]))
            self.first = np.cumsum(self.count) - self.count
            return
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        data[ends - 1] = TERMINATOR
        place = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
        with np.errstate(over="ignore"):
            powers = np.ones(max(1, int(lengths.max(initial=1))), np.uint64)
            powers[1:] = np.uint64(0x9E3779B97F4A7C15)
            powers = np.cumprod(powers)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(data.astype(np.uint64) + np.uint64(1)) * powers[place])])
            spelled = mixed(sums[:-1] - sums[np.repeat(ends - lengths, lengths)] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
            recent = np.zeros(len(data), np.uint64)
            for back in (1, 2, 3):
                before = np.zeros(len(data), np.uint64)
                before[back:] = data[:-back] + 1
                recent = recent * np.uint64(512) + np.where(place >= back, before, np.uint64(0))
            steps = code.length[data]
            at = np.repeat(code.start[data], steps) + np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
            node = code.nodes[at].astype(np.uint64)
            one = mixed(np.repeat(spelled, steps) + node * np.uint64(0x9E3779B97F4A7C15))
            two = mixed(np.repeat(mixed(recent + np.uint64(77)), steps) + node * np.uint64(0xC2B2AE3D27D4EB4F))
        self.bit = code.bits[at].astype(np.int8)
        self.slot, self.recent = (one & np.uint64(SLOTS - 1)).astype(np.int32), (two >> np.uint64(11)).astype(np.int32)
        self.local = ((one >> np.uint64(40)) & np.uint64(LOCAL - 1)).astype(np.int16)
        last = np.cumsum(steps)[ends - 1] if len(words) else np.zeros(0, np.int64)
        self.first = np.concatenate([[0], last[:-1]]) if len(words) else last
        self.count = last - self.first


def _steps(bits: int) -> Iterator[slice]:
    return (slice(a, a + BITS_AT_ONCE) for a in range(0, bits, BITS_AT_ONCE))


def recent_slot(recent: np.ndarray, group) -> np.ndarray:
    """The slot of the last bytes within a class (0: any)."""
    return (recent ^ (np.asarray(group) * 0x2545F491)) & (SLOTS - 1)


def odds(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a one, and what was seen: 0 nothing, 1 one bit only and rarely, 2 one bit only, 3 both, 4 both often."""
    seen, both = zeros + ones, (zeros > 0) & (ones > 0)
    state = sum(x.view(np.int8) for x in (seen > 0, both | (seen >= 4), both, both & (seen >= 64)))
    return np.log((ones + 0.05) / (zeros + 0.05)).astype(np.float32, copy=False), state


def start_weights() -> np.ndarray:
    """[gate, predictor]: where learning begins, before any text."""
    out = np.zeros((GATES, 3), np.float32)
    for gate in range(GATES):
        word, recent = gate // 20, gate // 4 % 5
        out[gate] = (0.0, 1.0, 1.0, 0.9, 1.0)[word], (0.0, 0.5, 0.7, 0.7, 0.9)[recent] * (1.0, 0.3, 0.1, 0.2, 0.0)[word], (0.0, 0.1, 0.2, 0.2)[gate % 4]
    return out


class State:
    """Weights [predictor, text * GATES + gate] and corrections [text * BUCKETS + bucket], with the sums of squared
    gradients that set their pace; and by text how many words came by name from the corpus, from each class and
    from the text itself, and by their spelling."""

    def __init__(self, weights: np.ndarray, fix: np.ndarray, named: np.ndarray, texts: int = 1) -> None:
        self.named = np.tile(named, (texts, 1)).astype(np.float64)
        self.weights, self.fix = np.tile(weights.T, texts).astype(np.float32), np.tile(fix, texts).astype(np.float32)
        self.power, self.fix_power = np.full(self.weights.shape, PACE, np.float32), np.full(self.fix.shape, PACE, np.float32)

    def learn(self, texts: slice, gate, bucket, miss, x, rate: float) -> None:
        """Teaches the state of some neighbouring texts; ``gate`` and ``bucket`` count from the first of them."""
        gates, buckets = (slice(texts.start * n, texts.stop * n) for n in (GATES, BUCKETS))
        for k in range(3):
            g = np.bincount(gate, miss * x[k], gates.stop - gates.start)
            self.power[k, gates] += g * g
            self.weights[k, gates] += rate * g / np.sqrt(self.power[k, gates])
        g = np.bincount(bucket, miss, buckets.stop - buckets.start)
        self.fix_power[buckets] += g * g
        self.fix[buckets] += rate * g / np.sqrt(self.fix_power[buckets])


class Mixer:
    """Scores texts, given as word numbers of a spelling, against the corpus tables.

    What is fixed of a bit is packed in one number: its value, its place in a text's own table, the state of its word
    slot, and the number of its context (the last bytes) among those of the spelling, by which the tables are kept.
    """

    def __init__(self, spelling: Spelling, share: np.ndarray, word_table, recent_table, start: tuple[np.ndarray, ...], rate: float = RATE) -> None:
        self.first, self.count, self.slot, self.share = spelling.first, spelling.count, spelling.slot, share
        self.start, self.rate = start, rate
        self.classes = start[2].shape[1] - 3
        self.one, seen_one = word_table  # by bit
        held = np.zeros(SLOTS, bool)
        for some in _steps(len(spelling.bit)):
            held[spelling.recent[some] & (SLOTS - 1)] = True
        self.contexts, number = np.flatnonzero(held), np.cumsum(held) - 1 << CONTEXT_AT
        self.fixed = np.empty(len(spelling.bit), np.int64)
        for some in _steps(len(self.fixed)):
            self.fixed[some] = number[spelling.recent[some] & (SLOTS - 1)] | spelling.local[some].astype(np.int64) << 1 | spelling.bit[some]
            if len(seen_one):
                self.fixed[some] |= seen_one[some].astype(np.int64) << LOCAL_BITS
        if len(recent_table[0]):
            slots = self._slots()
            self.two, self.seen_two = (by_slot[slots] for by_slot in recent_table)

    def _slots(self) -> np.ndarray:
        """The slots of the contexts, class after class."""
        return np.concatenate([recent_slot(self.contexts, k) for k in range(self.classes + 1)])

    def narrowed(self, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What two corpus tables hold of the spelling: by bit, and by class and context."""
        word, recent = (t.view(np.complex64) for t in tables)  # a slot's zeros and ones in one go
        by_bit = np.empty(len(self.slot), np.complex64)
        for some in _steps(len(by_bit)):
            by_bit[some] = word[self.slot[some]]
        return by_bit.view(np.float32), recent[self._slots()].view(np.float32)

    def group(self, texts: list[np.ndarray], own: "Own | None" = None) -> np.ndarray:
        """Natural log probability of each text, block by block, all texts in step.

        With ``own``, the weights stay, and what the bits teach is added up there.
        """
        n, lengths = len(texts), np.array([len(t) for t in texts])
        starts = np.cumsum(lengths) - lengths
        pairs, every = numbered(texts, len(self.first)) if own is None else (own.pairs, own.every)
        text_of, word_of = np.divmod(pairs, len(self.first))
        shares = self.share[word_of] if own is None else own.share(text_of, word_of, pairs)
        total, came = np.zeros(n), np.zeros(len(pairs))
        state = State(*self.start, n)
        counts = np.zeros(2 * n * LOCAL, np.float32)  # zeros and ones side by side
        at, block = 0, FIRST_BLOCK
        while at < lengths.max(initial=0):
            live = np.flatnonzero(lengths > at)
            now = np.bincount(np.concatenate([every[starts[i] + at : starts[i] + min(at + block, lengths[i])] for i in live]), minlength=len(pairs))
            pair = np.flatnonzero(now)
            of_text, word, times = text_of[pair], word_of[pair], now[pair]
            held = state.named / state.named.sum(axis=1, keepdims=True)
            ways = held[of_text] * np.concatenate([shares[pair], (came[pair] / max(1, at))[:, None], np.zeros((len(word), 1))], axis=1)
            ways[:, -1] = held[of_text, -1] * self._spell(state, counts, held, of_text, word, pair, times.astype(np.float32), lengths > at + block, own)
            both = np.maximum(ways.sum(axis=1), 1e-300)
            total += np.bincount(of_text, np.log(both) * times, n)
            if own is not None or at + block < lengths.max():
                came[pair] += times
                for k in range(ways.shape[1]):
                    state.named[:, k] += np.bincount(of_text, ways[:, k] / both * times, n)
            at, block = at + block, min(2 * block, LAST_BLOCK)
        if own is not None:
            own.named += (state.named - self.start[2]).sum(axis=0)
        return total

    def _spell(self, state: State, counts: np.ndarray, held: np.ndarray, of_text, word, pair, often, going, own: "Own | None") -> np.ndarray:
        """The probability of each word's spelling in its text; the bits then teach the state, or are added up in ``own``.

        A few texts at a time, and only those that go on learn.
        """
        group = np.where(held[:, 1:-2].max(axis=1, initial=0) > 0.3, held[:, 1:-2].argmax(axis=1) + 1, 0) if held.shape[1] > 3 else np.zeros(len(held), int)
        bits, out = self.count[word], np.empty(len(word), np.float32)
        begins = np.flatnonzero(np.diff(of_text, prepend=-1))
        cuts = begins[np.diff((np.cumsum(bits) - bits)[begins] // BITS_AT_ONCE, prepend=-1) > 0]
        for a, b in zip(cuts, [*cuts[1:], len(word)]):
            texts = slice(of_text[a], of_text[b - 1] + 1)
            out[a:b] = self._spell_some(state, counts, group, texts, of_text[a:b], word[a:b], pair[a:b], often[a:b], going[texts].any(), own)
        return np.exp(out)

    def _spell_some(self, state: State, counts: np.ndarray, group: np.ndarray, texts: slice, of_text, word, pair, often, learn: bool, own: "Own | None") -> np.ndarray:
        """Natural log probability of each word's spelling, of some neighbouring texts."""
        bits = self.count[word]
        starts = np.cumsum(bits) - bits
        spread = lambda x: np.repeat(x, bits)
        pos = spread(self.first[word] - starts)
        pos += np.arange(len(pos))
        fixed = self.fixed.take(pos)
        side = (fixed & (2 * LOCAL - 1)) + spread(of_text * (2 * LOCAL))
        zeros, ones = counts.take(side & -2), counts.take(side | 1)
        bit = (fixed & 1).astype(np.int8)
        times = spread(often)
        context = (fixed >> CONTEXT_AT) + spread(group[of_text] * len(self.contexts))
        if own is None:
            text = spread(of_text - texts.start)
            one, gate = self.one.take(pos), ((fixed >> LOCAL_BITS) & 7).astype(np.int8) * np.int8(20)
            two, seen_two = self.two.take(context), self.seen_two.take(context)
        else:
            counted = (group == 0) | (group == own.groups)
            text = None if counted[texts].all() else spread(of_text)
            one, gate, two, seen_two = own.odds(pos, context, bit, spread(own.times[pair].astype(np.float32)), counted, text)
        seen = zeros + ones
        gate = gate + seen_two * np.int8(4) + sum(x.view(np.int8) for x in (seen > 0, seen >= 3, (zeros > 0) & (ones > 0)))
        x = one, two, np.log((ones + np.float32(0.2)) / (zeros + np.float32(0.2)))
        place = gate.astype(np.int64) if own is not None else text * GATES + gate
        gates, buckets = (slice(texts.start * n, texts.stop * n) for n in (GATES, BUCKETS))
        mix, two_, three = (state.weights[k, gates].take(place) for k in range(3))
        mix *= x[0]
        two_ *= x[1]
        mix += two_
        three *= x[2]
        mix += three
        np.clip(mix, -11, 11, out=mix)
        bucket = (mix + 11.5).astype(np.int64)
        at = bucket if own is not None else text * BUCKETS + bucket
        mix += state.fix[buckets].take(at)
        sign = 1 - 2 * bit.astype(np.float32)
        p = 1 / (1 + np.exp(mix * sign))  # of the bit that came
        miss = (p - 1) * sign * times
        if own is not None:
            own.add(place, bucket, miss, p * (1 - p) * times, x)
        elif learn:
            state.learn(texts, place, at, miss, x, self.rate)
        if learn:
            np.add.at(counts, side, times)
        return np.add.reduceat(np.log(np.maximum(p, 1e-12)), starts)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probabilities; texts of like length go in one group."""
        out = np.zeros(len(texts))
        for some in alike(texts):
            out[some] = self.group([texts[i] for i in some])
        return out


def numbered(texts: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of text and word (text * words + word) in order, and the number of each word's pair."""
    lengths = [len(t) for t in texts]
    shift = np.int64(sum(lengths)).item().bit_length()
    pair = np.repeat(np.arange(len(texts)), lengths) * np.int64(words) + np.concatenate(texts)
    if (len(texts) * words << shift).bit_length() > 63:
        return np.unique(pair, return_inverse=True)
    both = np.sort(pair << shift | np.arange(len(pair)))  # numbers sort faster than places
    pair = both >> shift
    new = np.diff(pair, prepend=-1) > 0
    number = np.empty(len(pair), np.int64)
    number[both & ((1 << shift) - 1)] = np.cumsum(new) - 1
    return pair[new], number


def alike(texts: list[np.ndarray]) -> Iterator[list[int]]:
    """Groups of texts of like length, by place."""
    order, a = sorted(range(len(texts)), key=lambda i: len(texts[i])), 0
    while a < len(order):
        b = a + 1
        while b < len(order) and b - a < GROUP_TEXTS and (b + 1 - a) * min(LAST_BLOCK, len(texts[order[b]])) <= GROUP_WORDS:
            b += 1
        yield order[a:b]
        a = b


class Own:
    """A group of training texts seen by a corpus without them, and the sums of what their bits teach.

    Of each text, its occurrences of a word are taken out of that word's counts and of the counts of that word's bits.
    """

    def __init__(self, counts: np.ndarray, totals: np.ndarray, tables: np.ndarray) -> None:
        self.counts, self.totals, self.tables = counts, totals, tables
        self.cells, self.named = np.zeros((8 + len(CROSS), GATES * BUCKETS)), np.zeros(len(totals) + 2)

    def begin(self, texts: list[np.ndarray], groups: np.ndarray) -> None:
        self.groups, self.lengths = groups, np.array([len(t) for t in texts])
        self.pairs, self.every = numbered(texts, self.counts.shape[1])
        self.times = np.bincount(self.every, minlength=len(self.pairs))

    def often(self, pair: np.ndarray) -> np.ndarray:
        """How often a text has a word."""
        return self.times[np.searchsorted(self.pairs, pair)].astype(np.float32)

    def share(self, of_text, word, pair) -> np.ndarray:
        left, rest = self.counts[:, word].T.astype(float), np.repeat(self.totals[None, :].astype(float), len(word), axis=0)
        times, group = self.often(pair), self.groups[of_text]
        left[:, 0] -= times
        rest[:, 0] -= self.lengths[of_text]
        some = np.flatnonzero(group)
        left[some, group[some]] -= times[some]
        rest[some, group[some]] -= self.lengths[of_text[some]]
        return np.maximum(left, 0) / np.maximum(rest, 1)

    def odds(self, slot, recent, bit, times, counted: np.ndarray, text) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log odds and states of the word slots and of the slots of the last bytes; ``counted``: by text, whether the
        latter hold the text itself (all do, if ``text`` is None)."""
        out = []
        for table, at, taken in ((self.tables[0], slot, times), (self.tables[1], recent, times if text is None else times * counted[text])):
            zeros, ones = table.view(np.complex64).take(at).view(np.float32).reshape(-1, 2).T  # both in one go
            of_ones = taken * bit
            out += odds(np.maximum(zeros - (taken - of_ones), 0), np.maximum(ones - of_ones, 0))
        one, seen_one, two, seen_two = out
        return one, seen_one * np.int8(20), two, seen_two

    def add(self, gate, bucket, miss, curve, x) -> None:
        """Adds to the sums by gate and bucket: slopes, curvatures of pairs of predictors and of each with the
        correction, and the correction's slope and curvature."""
        cell = (gate * BUCKETS + bucket).astype(np.int16)
        order = np.argsort(cell, kind="stable")
        cell, miss, curve, *x = (v.take(order) for v in (cell, miss, curve, *x))
        first = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1])
        parts = np.empty((len(self.cells), len(cell)), np.float32)
        for k in range(3):
            np.multiply(miss, x[k], parts[k])
            np.multiply(curve, x[k], parts[3 + len(CROSS) + k])
        for i, (k, m) in enumerate(CROSS):
            np.multiply(parts[3 + len(CROSS) + k], x[m], parts[3 + i])
        parts[-2], parts[-1] = miss, curve
        self.cells[:, cell[first]] += np.add.reduceat(parts, first, axis=1)

    def sums(self) -> np.ndarray:
        cells = self.cells.reshape(-1, GATES, BUCKETS)
        return np.concatenate([cells[: 3 + len(CROSS)].sum(axis=2).ravel(), cells[3 + len(CROSS) : -2].ravel(), cells[-2:].sum(axis=1).ravel()])


def stepped(weights: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and corrections after one Newton step, damped and bounded, from these weights and no correction."""
    by_gate = sums[: 9 * GATES].reshape(9, GATES)
    across = sums[9 * GATES : -2 * BUCKETS].reshape(3, GATES, BUCKETS)
    slope = np.concatenate([by_gate[:3].T.ravel(), sums[-2 * BUCKETS : -BUCKETS]])
    curve = np.zeros((3 * GATES + BUCKETS,) * 2)
    gates, buckets = 3 * np.arange(GATES), 3 * GATES + np.arange(BUCKETS)
    for (k, m), own in zip(CROSS, by_gate[3:]):
        curve[gates + k, gates + m] = curve[gates + m, gates + k] = own
    for k in range(3):
        curve[np.ix_(gates + k, buckets)] = across[k]
        curve[np.ix_(buckets, gates + k)] = across[k].T
    curve[buckets, buckets] = sums[-BUCKETS:]
    step = np.clip(np.linalg.solve(curve + DAMPING * np.eye(len(curve)), slope), -LONGEST_STEP, LONGEST_STEP)
    step = step.round(4)  # the order in which tasks' sums are added leaves no trace
    return weights + step[: 3 * GATES].reshape(GATES, 3).astype(np.float32), step[3 * GATES :].astype(np.float32)


# --- the corpus ------------------------------------------------------------------------------------------------------
STORED = "split long, range int, words binary, numbers binary, ids binary, lengths binary, tokens binary"
ANSWERS = "split long, range int, words binary, numbers binary, totals array<long>, symbols array<long>"


def text_words(text: str | None) -> list[bytes]:
    """The words of a text and its end, the empty word."""
    return [*(text.encode("utf-8", "replace").lower().split() if text else ()), b""]


def _packed(words: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(words), 1)


def _unpacked(blob: bytes) -> list[bytes]:
    return zlib.decompress(blob).split(b" ")


def _numbers(array: np.ndarray) -> bytes:
    """Packed: all first bytes, then all second ones, and so on, most of which are zeros."""
    array = np.ascontiguousarray(array).reshape(-1)
    return zlib.compress(array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes(), 1)


def _read(blob: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(kind.itemsize, -1).T).reshape(-1).view(kind)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)], [n for n, _ in fields])


def _split(ranges: int, classes: int):
    """Texts as word numbers by split, and each split's distinct words with their training counts by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, flushes = TaskContext.get().partitionId(), 0

        def flush() -> pa.RecordBatch:
            words, lengths = list(known), np.array([len(t) for t in tokens], np.int32)
            every, n = np.concatenate(tokens), len(words)
            group = np.repeat(np.array(groups), lengths)
            counts = np.stack([np.bincount(every[group >= 0], minlength=n), *(np.bincount(every[group == k], minlength=n) for k in range(1, classes + 1))])
            home = np.fromiter((zlib.crc32(w) % ranges for w in words), np.int64, n)
            order = np.argsort(home, kind="stable").astype(np.int32)
            cuts, split = np.searchsorted(home[order], np.arange(ranges + 1)), part << 24 | flushes
            rows = [(split, i, _packed([words[j] for j in order[a:b]]), _numbers(counts[:, order[a:b]]), None, None, None) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            rows.append((split, None, _packed(words), _numbers(order), _numbers(np.array(ids, np.int64)), _numbers(lengths), _numbers(every)))
            return _batch(rows, STORED)

        def begin():
            fresh: defaultdict[bytes, int] = defaultdict()
            fresh.default_factory = fresh.__len__
            return fresh, [], [], [], 0

        known, tokens, groups, ids, held = begin()
        for batch in batches:
            for doc_id, text, held_out, group in zip(*(batch.column(i) for i in range(4))):
                own = text_words(text.as_py())
                tokens.append(np.fromiter(map(known.__getitem__, own), np.uint32, len(own)))
                out, doc_id = held_out.as_py(), doc_id.as_py()
                groups.append(-1 if out else group.as_py())
                ids.append((doc_id or 0, doc_id is None, out, groups[-1]))
                held += len(own)
                if held >= SPLIT_WORDS:
                    yield flush()
                    flushes += 1
                    known, tokens, groups, ids, held = begin()
        if tokens:
            yield flush()

    return run


def _count(classes: int):
    def run(table: pa.Table) -> pa.Table:
        """Of a hash range: the training words with their counts, and for each split the counts of its words."""
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        splits, places, counts = table.column("split").to_pylist(), [], []
        for words, numbers in zip(table.column("words"), table.column("numbers")):
            places.append(np.fromiter(map(index.__getitem__, _unpacked(words.as_py())), np.int64))
            counts.append(_read(numbers.as_py(), np.int64).reshape(classes + 1, -1))
        total = np.zeros((classes + 1, len(index)), np.int64)
        for at, n in zip(places, counts):
            total[:, at] += n  # a split has a word once
        number = table.column("range")[0].as_py()
        rows = [(s, number, None, _numbers(total[:, at]), None, None) for s, at in zip(splits, places)]
        learned = np.flatnonzero(total[0] > 0)
        words = list(index)
        words = [words[i] for i in learned]
        if words:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            symbols = np.bincount(np.frombuffer(b"".join(words), np.uint8), np.repeat(total[0][learned], lengths), 257).astype(np.int64)
            symbols[TERMINATOR] = total[0].sum()
            rows.append((-1, number, _packed(words), _numbers(total[:, learned]), [len(words), *total.sum(axis=1).tolist()], symbols.tolist()))
        return pa.Table.from_batches([_batch(rows, ANSWERS)])

    return run


def _bit_counts(code, classes: int):
    """A task's counts of bits by slot, in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, 2 * SLOTS), np.float32)
        for batch in batches:
            for blob, numbers in zip(batch.column("words"), batch.column("numbers")):
                words = _unpacked(blob.as_py())
                counts = _read(numbers.as_py(), np.int64).reshape(classes + 1, -1)
                for a in range(0, len(words), 20_000):
                    add_bits(tables, Spelling(words[a : a + 20_000], code.value), counts[:, a : a + 20_000])
        size = 2 * SLOTS // CHUNKS
        for t in range(2):
            for c in range(CHUNKS):
                yield _batch([(t * CHUNKS + c, _numbers(tables[t, c * size : (c + 1) * size]))], "chunk int, counts binary")

    return run


def add_bits(tables: np.ndarray, spelling: Spelling, counts: np.ndarray, sign: int = 1) -> None:
    """Adds the bits of words that occur ``counts[class]`` times (class 0: in all) to the tables."""
    for k, own in enumerate(counts):
        held = np.repeat(own > 0, spelling.count)
        if held.any():
            times, bit = sign * np.repeat(own, spelling.count)[held].astype(np.float32), spelling.bit[held]
            if k == 0:
                np.add.at(tables[0], spelling.slot[held].astype(np.int64) * 2 + bit, times)
            np.add.at(tables[1], recent_slot(spelling.recent[held], k).astype(np.int64) * 2 + bit, times)


def _added(kind):
    def run(table: pa.Table) -> pa.Table:
        total = sum(_read(b.as_py(), kind).astype(np.float64) for b in table.column("counts"))
        return pa.Table.from_batches([_batch([(table.column("chunk")[0].as_py(), _numbers(total.astype(kind)))], "chunk int, counts binary")])

    return run


def _of_split(stored: pa.Table, answers: pa.Table, classes: int):
    """Of a split: words, their counts by class, rows of (id, whether it is null, held out, class), and texts as word numbers."""
    row = stored.slice(0, 1).to_pylist()[0]
    words, order = _unpacked(row["words"]), _read(row["numbers"], np.int32)
    ids, lengths, every = _read(row["ids"], np.int64).reshape(-1, 4), _read(row["lengths"], np.int32), _read(row["tokens"], np.uint32)
    parts = sorted(zip(answers.column("range").to_pylist(), answers.column("numbers").to_pylist()))
    counts = np.zeros((classes + 1, len(words)), np.int64)
    counts[:, order] = np.concatenate([_read(b, np.int64).reshape(classes + 1, -1) for _, b in parts], axis=1)
    return words, counts, ids, lengths, every


def first_start(classes: int) -> tuple[np.ndarray, ...]:
    """Where reading the training texts begins: no corrections, and all ways alike."""
    return start_weights(), np.zeros(BUCKETS, np.float32), np.full((1, classes + 3), 1.0)


def evidence(mixer: Mixer, own: Own, texts: list[np.ndarray], groups: np.ndarray) -> np.ndarray:
    """What the training texts' bits and words teach together."""
    own.tables = mixer.narrowed(own.tables)
    for some in alike(texts):
        held = [texts[i] for i in some]
        own.begin(held, groups[some])
        mixer.group(held, own)
    return np.concatenate([own.sums(), own.named])


def _evidence(model, classes: int):
    def run(key, stored: pa.Table, answers: pa.Table) -> pa.Table:
        """Of a split: what its training texts teach, in chunks."""
        code, tables, totals = model.value
        words, counts, ids, lengths, every = _of_split(stored, answers, classes)
        texts = np.split(every.astype(np.int64), np.cumsum(lengths)[:-1])
        even, learned = (np.zeros(0, np.float32), np.zeros(0, np.int8)), np.flatnonzero(ids[:, 3] >= 0)
        mixer = Mixer(Spelling(words, code), np.zeros((0, classes + 1)), even, even, first_start(classes))
        sums = evidence(mixer, Own(counts, totals, tables), [texts[i] for i in learned], ids[learned, 3])
        return pa.Table.from_batches([_batch([(i, _numbers(x)) for i, x in enumerate(np.array_split(sums, CHUNKS))], "chunk int, counts binary")])

    return run


def starting_point(sums: np.ndarray, classes: int) -> tuple[np.ndarray, ...]:
    """Starting weights, corrections and share of named words from what all training texts teach."""
    if not sums[EVIDENCE:].any():  # no training text
        return first_start(classes)
    weights, fix = stepped(start_weights(), sums[:EVIDENCE])
    named = sums[None, EVIDENCE:].copy()
    if classes:
        named[:, 1:-2] = named[:, 1:-2].mean()  # a text may be of any class
    return weights, fix, (named / max(named.sum(), 1e-9) * PRIOR).round(6) + 1e-3


def _score(model, classes: int):
    def run(key, stored: pa.Table, answers: pa.Table) -> pa.Table:
        """Of a split: its texts' scores."""
        code, one, two, start, totals, distinct = model.value
        words, counts, ids, lengths, every = _of_split(stored, answers, classes)
        spelling = Spelling(words, code)
        share = (counts / np.maximum(totals, 1)[:, None]).T
        mixer = Mixer(spelling, share, (one[0][spelling.slot], one[1][spelling.slot]), two, start)
        mixer.slot = spelling = None  # their memory is needed
        starts = np.cumsum(lengths) - lengths
        texts = np.split(every.astype(np.int64), starts[1:])
        base = np.log10((counts[0] + 0.1) / (totals[0] + 0.1 * (distinct + 1)))
        size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        add = lambda x: np.add.reduceat(x[every], starts)
        absent = ids[:, 1] == 1
        return pa.table({
            "doc_id": pa.array(ids[:, 0], mask=absent), "held_out": pa.array(ids[:, 2] == 1), "n_tokens": pa.array(lengths.astype(np.int64)),
            "n_known": pa.array(add((counts[0] > 0).astype(np.int64))), "base_score": pa.array(add(base)), "score": pa.array(mixer.score(texts) / np.log(10)), "n_bytes": pa.array(add(size)),
        })

    return run


def scores(df: DataFrame, held_out, key: str = "doc_id", text: str = "text", group: str | None = "lang", classes: int = 8) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte of every row.

    ``held_out``: a condition on the rows that teach nothing. ``group``: a column whose ``classes`` most frequent values
    among the training rows get shares of their own; other rows count for the corpus alone. It is never read for a score.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"), (F.col(group).cast("string") if group else F.lit(None).cast("string")).alias("label"))
    named = [r["label"] for r in docs.where(~F.col("held") & F.col("label").isNotNull()).groupBy("label").count().orderBy(F.desc("count"), "label").limit(classes).collect()]
    classes, number = len(named), F.lit(0)
    for i, name in enumerate(named):
        number = F.when(F.col("label") == name, i + 1).otherwise(number)
    docs = docs.select("id", "text", "held", number.alias("class"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    stored = materialise(docs.mapInArrow(_split(ranges, classes), STORED), "mixlm-splits")
    answers = materialise(stored.where(F.col("range").isNotNull()).select("split", "range", "words", "numbers").groupBy("range").applyInArrow(_count(classes), ANSWERS), "mixlm-counts")
    learned = answers.where(F.col("split") == -1)
    totals = [r["x"] or 0 for r in learned.select(F.posexplode("totals")).groupBy("pos").agg(F.sum("col").alias("x")).orderBy("pos").collect()] or [0] * (classes + 2)
    symbols = {r["pos"]: r["x"] for r in learned.select(F.posexplode("symbols")).groupBy("pos").agg(F.sum("col").alias("x")).collect()}
    distinct, totals = totals[0], np.array(totals[1:])
    code = Code(np.array([symbols.get(s, 0) for s in range(TERMINATOR + 1)]))

    tasks = max(1, -(-distinct // WORDS_A_TASK))
    sent = spark.sparkContext.broadcast(code)
    chunks = learned.select("words", "numbers").repartition(tasks).mapInArrow(_bit_counts(sent, classes), "chunk int, counts binary").groupBy("chunk").applyInArrow(_added(np.float32), "chunk int, counts binary").toArrow()
    tables, size = np.zeros((2, 2 * SLOTS), np.float32), 2 * SLOTS // CHUNKS
    for chunk, blob in zip(chunks.column("chunk").to_pylist(), chunks.column("counts")):
        t, c = divmod(chunk, CHUNKS)
        tables[t, c * size : (c + 1) * size] = _read(blob.as_py(), np.float32)
    del chunks

    texts, told = stored.where(F.col("range").isNull()).groupBy("split"), answers.where(F.col("split") >= 0).select(F.col("split").alias("to"), "range", "numbers").groupBy("to")
    bare = spark.sparkContext.broadcast((code, tables, totals))
    sums = texts.cogroup(told).applyInArrow(_evidence(bare, classes), "chunk int, counts binary").groupBy("chunk").applyInArrow(_added(np.float64), "chunk int, counts binary").toArrow()
    taught = sorted(zip(sums.column("chunk").to_pylist(), sums.column("counts")))
    start = starting_point(np.concatenate([_read(b.as_py(), np.float64) for _, b in taught]) if taught else np.zeros(EVIDENCE + classes + 3), classes)
    bare.unpersist()
    model = spark.sparkContext.broadcast((code, odds(tables[0, 0::2], tables[0, 1::2]), odds(tables[1, 0::2], tables[1, 1::2]), start, totals, distinct))
    del tables, bare
    out = texts.cogroup(told).applyInArrow(_score(model, classes), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(totals[0])).cast("long").alias("train_tokens"), "base_score", "score",
                      (-F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes")).alias("bits_per_byte"))
