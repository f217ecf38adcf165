"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, a function of its code point. A trigram is its letters' vectors, each
rotated by its place, multiplied component by component; a text is the sum over its trigrams; a language is the sum
over its training texts. A text gets the language whose prototype, less the mean of all prototypes' directions, has
the largest cosine with it.

Texts are lower-cased; letters are the characters of Unicode's letter categories, every run of others counts as one
blank, and a blank stands before and after the text.

Defined cases
* A null text, or one without letters: ``und`` with score 0. So is every text if nothing was learned.
* Rows without a language teach nothing. Equal texts get equal results. Ties go to the language first in order.
* Texts of any length are counted whole; memory follows the longest text, not the number of texts read together.
* Sums are whole numbers and exact in any order, so reruns agree. An empty table gives no rows.
* Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martmill.llm.stores import release

DIM = 1024
CELLS = 1 << 23  # numbers in a table of counts by group and trigram
BLANK = 32
UNDETERMINED = "und"
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def letter_vectors(codes: np.ndarray, dim: int = DIM) -> np.ndarray:
    """One random row of +1 and -1 per code point (the 64 bit mixing steps of splitmix)."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, dim // 64 + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return np.unpackbits(x.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def letters_of(text: str) -> np.ndarray:
    """The letters of a text as code points, with one blank for every run of other characters and at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_is_letter()[codes], codes, np.uint32(BLANK))
    codes = np.concatenate((np.array([BLANK], np.uint32), codes, np.array([BLANK], np.uint32)))
    return codes[np.concatenate(([True], (codes[1:] != BLANK) | (codes[:-1] != BLANK)))]


def _numbered(values: np.ndarray, limit: int = 4_000_000) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the position of each value among them."""
    if not len(values) or values.max() > limit:
        return np.unique(values, return_inverse=True)
    present = np.zeros(int(values.max()) + 1, bool)
    present[values] = True
    return np.flatnonzero(present), (np.cumsum(present, dtype=np.int32) - 1)[values]


def gram_counts(parts: list[np.ndarray], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct trigrams of texts given as letters, as rows of three code points, and one (group, trigram) per occurrence."""
    kept = [len(p) > 2 for p in parts]
    parts, groups = [p for p, k in zip(parts, kept) if k], groups[kept]
    if not parts:
        return np.zeros((0, 3), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.array([len(p) for p in parts])
    letters, place = _numbered(np.concatenate(parts))
    size = np.int64(len(letters))
    place = place.astype(np.int32 if size**3 < 2**31 else np.int64)
    ids = (place[:-2] * place.dtype.type(size) + place[1:-1]) * place.dtype.type(size) + place[2:]
    inside = np.ones(len(place), bool)  # a trigram does not reach into the next text
    ends = np.cumsum(lengths)
    inside[ends - 1] = inside[ends - 2] = False
    distinct, of = _numbered(ids[inside[:-2]])
    return np.stack([letters[distinct // size**2], letters[distinct // size % size], letters[distinct % size]], axis=1), np.repeat(groups, lengths - 2), of


def bundle(parts: list[np.ndarray], groups: np.ndarray, n: int, dim: int = DIM, block: int = 4096) -> np.ndarray:
    """The sums of trigram vectors by group, of ``n``: whole numbers, as doubles, and exact in any order.

    Groups whose counts by trigram would take more than ``CELLS`` numbers are halved until they do not or one is left.
    """
    grams, owner, of = gram_counts(parts, groups)
    if n > 1 and n * len(grams) > CELLS:
        half, low = n // 2, groups < n // 2
        below, above = [p for p, x in zip(parts, low) if x], [p for p, x in zip(parts, low) if not x]
        del grams, owner, of
        return np.concatenate((bundle(below, groups[low], half, dim, block), bundle(above, groups[~low] - half, n - half, dim, block)))
    out = np.zeros((n, dim))
    counts = np.bincount(owner * np.int64(len(grams)) + of, minlength=n * len(grams)).reshape(n, len(grams))
    kind = np.float32 if counts.sum(axis=1).max(initial=0) < 2**24 else np.float64
    letters, place = _numbered(grams.ravel())
    place, table = place.reshape(grams.shape), letter_vectors(letters, dim)
    once, twice = np.roll(table, 1, axis=1), np.roll(table, 2, axis=1)
    for a in range(0, len(grams), block):
        first, second, third = place[a : a + block].T
        out += counts[:, a : a + block].astype(kind) @ (twice[first] * once[second] * table[third]).astype(kind)
    return out


def runs(texts: list[str | None], rows: int, chars: int = 1 << 21) -> Iterator[slice]:
    """Runs of at most ``rows`` texts, and of at most ``chars`` characters unless a single text has more."""
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and (i - start == rows or held + size > chars):
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


def _parts(texts: list[str | None]) -> list[np.ndarray]:
    return [letters_of(t) if t else np.zeros(0, np.uint32) for t in texts]


def bundles(texts: list[str | None], dim: int = DIM, rows: int = 128) -> Iterator[np.ndarray]:
    """The vectors of runs of texts; zero where a text has no letters."""
    for run in runs(texts, rows):
        parts = _parts(texts[run])
        yield bundle(parts, np.arange(len(parts)), len(parts), dim)


def prototypes(df: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their vectors: one partial sum per task and language, added up by component.

    One row per language reaches the driver.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for run in runs(texts, 512):
                names, of = np.unique(labels[run], return_inverse=True)
                vectors = bundle(_parts(texts[run]), of, len(names), dim)
                for name, vector in zip(names, vectors):
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "vector"])

    parts = df.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).mapInArrow(partial, "lang string, vector array<long>")
    summed = parts.select("lang", F.posexplode("vector")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
    rows = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "x")))["x"].alias("v")).orderBy("lang").collect()
    return [r["lang"] for r in rows], np.array([r["v"] for r in rows], float).reshape(len(rows), dim)


def classifier(vectors: np.ndarray) -> np.ndarray:
    """Directions of the prototypes less their mean; a single language keeps its own."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norms > 0, norms, 1)
    centred = unit - unit.mean(axis=0) if len(unit) > 1 else unit
    norms = np.linalg.norm(centred, axis=1, keepdims=True)
    return centred / np.where(norms > 0, norms, 1)


def predict(df: DataFrame, langs: list[str], vectors: np.ndarray, text: str = "text") -> DataFrame:
    """All columns of ``df`` as struct ``row``, and lang_pred and score (the cosine, at least 0)."""
    spark: SparkSession = df.sparkSession
    sent = spark.sparkContext.broadcast((langs, classifier(vectors) if len(langs) else vectors))
    dim = vectors.shape[1]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        names, directions = sent.value
        for batch in batches:
            best, score = [], []
            for sums in bundles(batch.column("_text").to_pylist(), dim):
                norms = np.linalg.norm(sums, axis=1)
                if not names:
                    best += [UNDETERMINED] * len(sums)
                    score += [0.0] * len(sums)
                    continue
                cosines = (sums / np.where(norms > 0, norms, 1)[:, None]) @ directions.T
                at = cosines.argmax(axis=1)
                best += [names[i] if n > 0 else UNDETERMINED for i, n in zip(at, norms)]
                score += np.where(norms > 0, np.clip(cosines.max(axis=1), 0, 1), 0.0).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"])

    source = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("_text"))
    schema = source.select("row").schema.add("lang_pred", "string").add("score", "double")
    return source.mapInArrow(label, schema)
