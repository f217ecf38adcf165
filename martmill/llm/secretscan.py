"""Secret scans by grammar inference.

Rules find the *base* credentials of a text: values assigned to a telling name, access keys, runs of hex digits. They
also label the examples that a grammar is learned from: the distinct credentials of each kind make a prefix tree whose
states are merged where their outgoing frequencies agree (state merging under the Hoeffding bound), which gives a
probabilistic automaton of the kind's format. One more automaton is learned from ordinary runs of the same letters.

Every other run of such letters in a text is a candidate. It is scored by the log likelihood of its format under each
kind against the ordinary automaton, and is a credential if it reaches what all but ``miss`` of the kind's held-out
examples reach. Letters that are capital throughout a run count as small ones, in learning and scoring, so that a key
written in the other case has the same format.

Examples are a bounded sample (``examples`` of each kind and of ordinary runs, ``buckets`` of equal size by hash, none
longer than ``longest``); the scan reads every text as a whole.

Defined cases
* A text that is null or empty has no spans. Offsets count code points; the end is exclusive.
* A base span is the whole match of its rule; spans of different rules may overlap. Candidates lie in what base spans leave,
  without full stops and hyphens at their ends.
* A kind with fewer than ``least`` examples learns nothing and adds no spans; nor does any if there are no ordinary runs.
  Equal likelihoods go to the first kind.
* Null ids and repeated rows are rows like others. An empty table gives no rows. Other columns, whatever their names,
  are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

# --- fixed values: the rules of the base spans --------------------------------------------------------------------------
KINDS = ("assign", "access", "hex")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
# -----------------------------------------------------------------------------------------------------------------------

ORDINARY = "ordinary"
END = len(LETTERS)
_SYMBOL = np.full(256, -1, np.int8)
_SYMBOL[list(LETTERS)] = np.arange(END)
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_SMALL = np.arange(END + 1, dtype=np.int8)
_SMALL[:26] += 26


# --- learning automata --------------------------------------------------------------------------------------------------


class Automaton(NamedTuple):
    """By state and symbol: the next state and the log probability; the last symbol is the end of a run."""

    next: np.ndarray
    log: np.ndarray


def folded(text: bytes) -> bytes:
    return text.lower() if text.upper() == text else text


def learn(examples: list[bytes], alpha: float = 0.05) -> Automaton:
    """Merges the states of the examples' prefix tree, most visited ones first, each into the compatible kept state
    whose frequencies are nearest, and smooths the result by the frequencies of all symbols."""
    kids: list[dict[int, int]] = [{}]
    seen, ends = [0], [0]
    total = np.ones(END + 1)
    for text in examples:
        at = 0
        seen[0] += 1
        for s in _SYMBOL[list(text)].tolist():
            total[s] += 1
            if s not in kids[at]:
                kids[at][s] = len(kids)
                kids.append({})
                seen.append(0)
                ends.append(0)
            at = kids[at][s]
            seen[at] += 1
        ends[at] += 1
        total[END] += 1
    bound = (0.5 * np.log(2 / alpha)) ** 0.5

    def distance(kept: int, new: int) -> float | None:
        """The largest difference of frequencies below both states in units of the bound; None if one is over it."""
        worst, stack = 0.0, [(kept, new)]
        while stack:
            a, b = stack.pop()
            n, m = seen[a], seen[b]
            room = bound * (n**-0.5 + m**-0.5)
            if room < 1:  # states that are seen less can't differ by more than the bound
                own, other = kids[a], kids[b]
                most = abs(ends[a] / n - ends[b] / m)
                for s in own.keys() | other.keys():
                    d = abs((seen[own[s]] if s in own else 0) / n - (seen[other[s]] if s in other else 0) / m)
                    most = d if d > most else most
                if most > room:
                    return None
                worst = max(worst, most / room)
            stack += [(kids[a][s], t) for s, t in kids[b].items() if s in kids[a]]
        return worst

    def fold(kept: int, new: int) -> None:
        stack = [(kept, new)]
        while stack:
            a, b = stack.pop()
            seen[a] += seen[b]
            ends[a] += ends[b]
            for s, t in kids[b].items():
                if s in kids[a]:
                    stack.append((kids[a][s], t))
                else:
                    kids[a][s] = t

    red = [0]
    while True:
        held = set(red)
        blue = [(a, s, t) for a in red for s, t in kids[a].items() if t not in held]
        if not blue:
            break
        a, s, new = min(blue, key=lambda x: (-seen[x[2]], x[0], x[1]))
        near = [(d, r) for r in red if (d := distance(r, new)) is not None]
        if near:
            kept = min(near)[1]
            kids[a][s] = kept
            fold(kept, new)
        else:
            red.append(new)
    number = {r: i for i, r in enumerate(red)}
    escape = len(red)  # symbols that a state has not met lead here
    moves = np.full((escape + 1, END + 1), escape, np.int32)
    for r, i in number.items():
        for s, t in kids[r].items():
            moves[i, s] = number[t]
    prior, taken = total / total.sum(), np.zeros(moves.shape)
    for text in examples:  # what the examples do in the merged automaton
        at = 0
        for s in _SYMBOL[list(text)].tolist():
            taken[at, s] += 1
            at = moves[at, s]
        taken[at, END] += 1
    taken += prior
    return Automaton(moves, np.log(taken / taken.sum(axis=1, keepdims=True)))


class Scanner(NamedTuple):
    """The kinds that have learned, their automata behind the ordinary one, and the likelihood ratios to reach."""

    kinds: list[str]
    automata: list[Automaton]
    least: np.ndarray


def likelihoods(automata: list[Automaton], symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """[automaton, run]: log likelihoods of runs of symbols that follow each other in one array."""
    first = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    out = np.zeros((len(automata), len(sizes)))
    for row, automaton in zip(out, automata):
        state = np.zeros(len(sizes), np.int32)
        for step in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -step))  # runs that still go on: the longest ones
            s = symbols[first[:n] + step]
            row[:n] += automaton.log[state[:n], s]
            state[:n] = automaton.next[state[:n], s]
        row += automaton.log[state, END]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[:, back]


def scanner(examples: dict[str, list[bytes]], miss: float = 0.05, least: int = 20) -> Scanner:
    """Learns from three of four examples of a kind; the rest sets the ratio that candidates must reach."""
    ordinary = sorted({folded(x) for x in examples.get(ORDINARY, [])})
    kinds, automata, bounds = [], [], []
    if ordinary:
        automata.append(learn(ordinary))
    for kind in KINDS:
        own = sorted({folded(x) for x in examples.get(kind, [])}, key=lambda x: xxhash.xxh64_intdigest(x))
        if len(own) < least or not ordinary:
            continue
        held = own[::4]
        automaton = learn(sorted(x for i, x in enumerate(own) if i % 4))
        found = likelihoods([automata[0], automaton], _SYMBOL[list(b"".join(held))].astype(np.int64), np.array([len(x) for x in held]))
        kinds.append(kind)
        automata.append(automaton)
        bounds.append(max(0.0, float(np.quantile(found[1] - found[0], miss))))
    return Scanner(kinds, automata, np.array(bounds))


# --- reading texts ------------------------------------------------------------------------------------------------------


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set flags."""
    edges = np.flatnonzero(np.diff(flags.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def base_spans(data: bytes) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, value's start, its end) in bytes, by kind."""
    out, low, ends = [], data.lower(), 0
    places = set()
    for name in NAMES:
        at = low.find(name)
        while at >= 0:
            places.add(at)
            at = low.find(name, at + 1)
    for at in sorted(places):
        m = ASSIGN.match(data, at) if at >= ends else None
        if m:
            ends = m.end()
            if m.end(1) - m.start(1) >= SHORTEST["assign"]:
                out.append(("assign", m.start(), m.end(), m.start(1), m.end(1)))
    out += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(data) if m.end() - m.start() >= SHORTEST["access"]]
    starts, stops = _runs(_HEX[np.frombuffer(data, np.uint8)])
    long = stops - starts >= SHORTEST["hex"]
    return out + [("hex", a, b, a, b) for a, b in zip(starts[long].tolist(), stops[long].tolist())]


def candidates(data: bytes, taken: list[tuple[str, int, int, int, int]], shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of credential letters that base spans leave."""
    codes = np.frombuffer(data, np.uint8)
    flags = _SYMBOL[codes] >= 0
    for _, a, b, *_ in taken:
        flags[a:b] = False
    starts, stops = _runs(flags)
    long = stops - starts >= shortest
    starts, stops = starts[long], stops[long].copy()
    edge = (codes == 46) | (codes == 45)  # full stops and hyphens
    for at, step in ((starts, 1), (stops, -1)):
        while (off := edge[at - (step < 0)] & (starts < stops)).any():
            at[off] += step
    long = stops - starts >= shortest
    return starts[long], stops[long]


def _symbols(data: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of runs, one after the other, small where a run has no small letter, and the runs' sizes."""
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    symbols = _SYMBOL[np.frombuffer(data, np.uint8)[np.repeat(starts - first, sizes) + np.arange(sizes.sum())]]
    capital = np.repeat(~np.logical_or.reduceat((symbols >= 26) & (symbols < 52), first), sizes)
    return np.where(capital, _SMALL[symbols], symbols).astype(np.int64), sizes


def _texts(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, bytes, np.ndarray]]:
    """Slices of batches with their texts in one piece, apart by a line feed (no rule and no run crosses it), and the
    texts' starts."""
    for whole in batches:
        lengths, a = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in whole.column(column)], np.int64), 0
        while a < whole.num_rows:
            b = a + max(1, int(np.searchsorted(np.cumsum(lengths[a:]), size, side="right")))
            part = whole.slice(a, b - a)
            yield part, b"\n".join(x or b"" for x in part.column(column).to_pylist()), np.cumsum(np.append(0, lengths[a:b] + 1))[:-1]
            a = b


def _sampler(examples: int, buckets: int, longest: int, shortest: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task, the examples with the smallest hashes of each kind and bucket."""
        most = -(-examples // buckets)
        held: dict[tuple[str, int], set[tuple[int, bytes]]] = {}

        def keep(all_of_them: bool) -> None:
            for key, own in held.items():
                if len(own) > most and (all_of_them or len(own) > 20 * most):
                    held[key] = set(sorted(own)[:most])

        for _, data, _ in _texts(batches, 0, size):
            base = base_spans(data)
            starts, stops = candidates(data, base, shortest)
            found = [(kind, a, b) for kind, _, _, a, b in base] + [(ORDINARY, a, b) for a, b in zip(starts.tolist(), stops.tolist())]
            for kind, a, b in found:
                if b - a <= longest:
                    value = data[a:b]
                    h = xxhash.xxh64_intdigest(value)
                    held.setdefault((kind, h % buckets), set()).add((h >> 1, value))
            keep(False)
        keep(True)
        rows = [(kind, bucket, h, value) for (kind, bucket), own in sorted(held.items()) for h, value in sorted(own)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.binary()))], ["kind", "bucket", "hash", "value"])

    return run


def fitted(df: DataFrame, text: str = "text", examples: int = 2000, buckets: int = 50, longest: int = 200, shortest: int = 8, size: int = 4 << 20) -> Scanner:
    """A scanner from the distinct credentials and ordinary runs of all texts. At most ``examples`` of each kind reach the driver."""
    source = df.select(F.col(text).cast("string").cast("binary").alias("text"))
    drawn = source.mapInArrow(_sampler(examples, buckets, longest, shortest, size), "kind string, bucket int, hash long, value binary").distinct()
    first = Window.partitionBy("kind", "bucket").orderBy("hash", "value")
    rows = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= -(-examples // buckets)).select("kind", "value").orderBy("kind", "value").collect()
    by: dict[str, list[bytes]] = {}
    for kind, value in rows:
        by.setdefault(kind, []).append(bytes(value))
    return scanner(by)


SPANS = ArrayType(StructType().add("kind", "string").add("start", "long").add("stop", "long").add("base", "boolean").add("likelihood", "double"))


def scan(df: DataFrame, found_by: Scanner, text: str = "text", shortest: int = 8, size: int = 4 << 20) -> DataFrame:
    """All columns of ``df`` as struct ``row``, and the spans of its text by start and kind. ``likelihood`` is the log
    likelihood ratio of an added span."""
    sent = df.sparkSession.sparkContext.broadcast(found_by)
    source = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).cast("string").cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for part, data, texts in _texts(batches, 1, size):
            base = base_spans(data)
            spans = [(a, b, KINDS.index(kind), True, None) for kind, a, b, *_ in base]
            if known.kinds:
                starts, stops = candidates(data, base, shortest)
                if len(starts):
                    scores = likelihoods(known.automata, *_symbols(data, starts, stops))
                    over = scores[1:] - scores[0] - known.least[:, None]
                    best = over.argmax(axis=0)
                    for i in np.flatnonzero(over.max(axis=0) >= 0).tolist():
                        spans.append((int(starts[i]), int(stops[i]), KINDS.index(known.kinds[best[i]]), False, float(scores[1 + best[i], i] - scores[0, i])))
            spans.sort()
            by: list[list[dict]] = [[] for _ in range(part.num_rows)]
            owner = np.searchsorted(texts, [s[0] for s in spans], side="right") - 1
            ascii_ = data.isascii()
            for (a, b, kind, is_base, ratio), row in zip(spans, owner.tolist()):
                start = int(texts[row])
                before = a - start if ascii_ else len(data[start:a].decode("utf-8", "replace"))
                by[row].append({"kind": KINDS[kind], "start": before, "stop": before + b - a, "base": is_base, "likelihood": ratio})
            for own in by:
                own.sort(key=lambda x: (x["start"], KINDS.index(x["kind"]), x["stop"]))
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_()), ("likelihood", pa.float64())]))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(by, kinds)], ["row", "spans"])

    return source.mapInArrow(run, source.select("row").schema.add("spans", SPANS))


def joined(spans, base_only: bool = False):
    """kind:start:end of an array of spans, comma-joined."""
    own = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))
