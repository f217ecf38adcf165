"""Sets of word shingles as sorted arrays of 64-bit hashes, and their bitmap signatures."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

SIGNATURE_BITS = 1024
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct hashes of the five-word shingles of a text; A-Z count as a-z.

    A text with fewer words is one shingle, its whole sequence; one without words has none. Word hashes are kept up to
    ``keep`` words, then the store starts afresh.
    """

    def __init__(self, width: int = 5, keep: int = 400_000) -> None:
        self.width, self.keep, self.known = width, keep, {}

    def word_hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.keep:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split() if text else []
        if not words:
            return np.zeros(0, np.uint64)
        h = self.word_hashes(words)
        if len(h) < self.width:
            return np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64)
        n = len(h) - self.width + 1
        with np.errstate(over="ignore"):
            sums = sum((h[i : i + n] * f for i, f in enumerate(FACTORS[: self.width])), np.zeros(n, np.uint64))
        return np.unique(mixed(sums))


def set_key(shingles: np.ndarray) -> int:
    """A 64-bit name of the set itself, as a signed number."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes(), seed=len(shingles) & 0xFFFFFFFF) - 2**63


def signature(shingles: np.ndarray, bits: int = SIGNATURE_BITS) -> bytes:
    """A bitmap with the bit of every shingle's hash set."""
    on = np.zeros(bits, bool)
    on[(shingles >> np.uint64(7)) % np.uint64(bits)] = True
    return np.packbits(on).tobytes()


def signatures(blobs: Iterable[bytes]) -> np.ndarray:
    """Rows of 64-bit words of several signatures."""
    data = b"".join(blobs)
    return np.frombuffer(data, np.uint64).reshape(-1, SIGNATURE_BITS // 64)


def overlap_bound(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The most shingles two sets can share: a bit that only one has is at least one shingle that the other lacks."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(size_a - only_a, size_b - only_b)


def reaches(common, size_a, size_b, percent: int = 75):
    """100 * intersection >= percent * union."""
    return 100 * common >= percent * (size_a + size_b - common)
