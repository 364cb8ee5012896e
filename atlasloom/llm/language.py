"""Language of a text by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram's vector is the product of its letters' vectors, each rotated by
its place; a text's vector is the sum of the vectors of its n-grams; a language's prototype is the sum over all its
training texts. A text gets the language whose prototype has the largest cosine with its own vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import texts

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Held in each worker; n-grams beyond are bound anew when they are met.
KEPT_GRAMS = 60_000
_SPACE = 0x20
_BASE = 1 << 21  # above every code point


def held_out(remainders: int = 4, of: int = 2) -> Column:
    """Documents whose crc32 of the id's text has the remainder ``of``."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % remainders == of, F.lit(False))


def letters_of(text: str) -> np.ndarray:
    """Code points in lower case, each run of anything but letters one space; a space at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype("int64")
    letter = _is_letter(points)
    points = np.where(letter, points, _SPACE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = points[keep] if len(points) else points
    return np.concatenate([[_SPACE], points, [_SPACE]]) if letter.any() else points[:0]


_ASCII_LETTER = np.array([chr(i).isalpha() for i in range(0x800)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    out = _ASCII_LETTER[np.minimum(points, 0x7FF)]
    if (far := points > 0x7FF).any():
        values, where = np.unique(points[far], return_inverse=True)
        out[far] = np.array([chr(v).isalpha() for v in values.tolist()])[where]
    return out


class Profiles:
    """Vectors of n-grams in one worker."""

    def __init__(self, dimensions: int = DIMENSIONS, kept: int = KEPT_GRAMS):
        self.dimensions, self.kept = dimensions, kept
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((1024, dimensions), "int8")

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            self.letters[point] = (np.random.default_rng(point + 1).integers(0, 2, self.dimensions, "int8") * 2 - 1).astype("int8")
        return self.letters[point]

    def bind(self, gram: int) -> np.ndarray:
        out = np.ones(self.dimensions, "int8")
        for place in range(GRAM):
            out *= np.roll(self.letter(gram % _BASE), place)
            gram //= _BASE
        return out

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        codes = grams.tolist()
        missing = [g for g in codes if g not in self.rows]
        if len(self.rows) + len(missing) > self.kept:
            self.rows.clear()
            missing = codes
            if len(missing) > self.kept:
                return np.stack([self.bind(g) for g in codes])
        while len(self.rows) + len(missing) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for g in missing:
            self.table[len(self.rows)] = self.bind(g)
            self.rows[g] = len(self.rows)
        return self.table[[self.rows[g] for g in codes]]

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.dimensions, "float32")
        for at in range(0, len(grams), 4096):
            total += counts[at:at + 4096].astype("float32") @ self.vectors(grams[at:at + 4096]).astype("float32")
        return total


def grams_of(text: str) -> np.ndarray:
    points = letters_of(text)
    if len(points) < GRAM:
        return np.zeros(0, "int64")
    # three code points of 21 bits fill 63 bits
    return sum(points[i:len(points) - GRAM + 1 + i] * _BASE**i for i in range(GRAM))


def learn(training: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """A unit vector for each language of ``training`` (``text``, ``lang``; rows without either are left out).

    Each partition bundles its texts by language; the sums are added up by Spark, a number for each language and dimension.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, totals = Profiles(dimensions), {}
        for batch in batches:
            gathered: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(texts(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                gathered.setdefault(lang, []).append(grams_of(text))
            for lang, parts in gathered.items():
                grams, counts = np.unique(np.concatenate(parts), return_counts=True)
                totals[lang] = totals.get(lang, 0) + profiles.bundle(grams, counts).astype("float64")
        for lang, vector in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype="int32")), pa.array(vector)], names=["lang", "place", "value"])

    rows = training.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(run, "lang string, place int, value double").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for r in sums.collect():  # languages times dimensions
        found.setdefault(r["lang"], np.zeros(dimensions))[r["place"]] = r["value"]
    return {k: (v / np.linalg.norm(v)).astype("float32") for k, v in sorted(found.items()) if np.linalg.norm(v)}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], *more: Column) -> DataFrame:
    """``doc_id, lang_pred, score`` (and the columns ``more``) of every row.

    ``score`` is the cosine, at least 0. Without text, letter or prototype: ``und`` and 0. Ties go to the first name.
    """
    names = list(prototypes)
    matrix = np.stack(list(prototypes.values())) if names else np.zeros((0, DIMENSIONS), "float32")
    picked = docs.select("doc_id", "text", *more)
    extra = picked.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(matrix.shape[1])
        for batch in batches:
            langs, scores = [], []
            for text in texts(batch.column("text")):
                grams, counts = np.unique(grams_of(text), return_counts=True)
                if not len(grams) or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = profiles.bundle(grams, counts)
                cosine = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-9)
                best = int(cosine.argmax())
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosine[best]))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(c) for c in extra], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", *extra, "lang_pred", "score"])

    kinds = dict(picked.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ["doc_id", *extra])
    return picked.mapInArrow(run, f"{schema}, lang_pred string, score double")
