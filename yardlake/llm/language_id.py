"""Language identification with hyperdimensional profiles.

Every letter of Unicode owns a random vector of +1 and -1, made from a hash of its code point. A trigram's vector binds
(multiplies) its letters' vectors, the first rolled twice, the second once; a text bundles (adds) the vectors of its
trigrams; a language's prototype bundles all training texts of it. The prediction is the prototype of highest cosine.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import slices, struct_of, text_column

DIMENSIONS = 2048
SEED = 20
UNKNOWN = "und"
#: Trigram vectors that are held at once.
BLOCK = 4096
#: Texts that are bundled at once, and languages that can be learned (8 MB of prototypes).
ROWS, MAX_LANGUAGES = 256, 512
#: Bits of a code point within a trigram's code.
WIDTH = 21


def scrambled(x: np.ndarray) -> np.ndarray:
    """64 bits of hash of each 64-bit number: multiplications and shifts, as random generators end with."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


def letter_vectors(letters: np.ndarray) -> np.ndarray:
    """The vectors of letters given by code point; 0 stands for whatever is not a letter and has one too."""
    words = letters.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS // 64) + np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = np.unpackbits(scrambled(words).astype("<u8").view(np.uint8).reshape(len(letters), -1), axis=1)
    return (bits.astype(np.int8) << 1) - np.int8(1)


@lru_cache(1)
def letter_numbers() -> np.ndarray:
    """For each code point the lower-case code point where it is a letter, 0 for anything else."""
    out = np.zeros(sys.maxunicode + 1, np.int32)
    for c in filter(str.isalpha, map(chr, range(sys.maxunicode + 1))):
        out[ord(c)] = ord(c.lower()[0])
    return out


def trigram_vectors(codes: np.ndarray) -> np.ndarray:
    """Codes as three code points of WIDTH bits."""
    mask = (1 << WIDTH) - 1
    letters, at = np.unique(np.stack([codes >> 2 * WIDTH, codes >> WIDTH & mask, codes & mask]), return_inverse=True)
    v, (first, second, third) = letter_vectors(letters), at.reshape(3, -1)
    return np.roll(v, 2, axis=1)[first] * np.roll(v, 1, axis=1)[second] * v[third]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The text's number and the code of every trigram that has a letter in its middle, over all texts."""
    parts = [np.frombuffer(f" {x} ".encode("utf-32-le", "replace"), np.uint32) for x in (t or "" for t in texts)]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    at = letter_numbers()[np.concatenate(parts)] if parts else np.zeros(0, np.int32)
    at = at.astype(np.int64)
    codes = (at[:-2] << 2 * WIDTH) | (at[1:-1] << WIDTH) | at[2:]
    inside = at[1:-1] > 0  # each text begins and ends with a space, so no such trigram spans two
    return owner[1:-1][inside], codes[inside]


def bundles(owner: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """n bundled vectors; holds BLOCK trigram vectors and counts at a time."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    if not len(codes):
        return out
    known, column = np.unique(codes, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    cuts = np.searchsorted(column, np.arange(0, len(known) + BLOCK, BLOCK))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        block = known[k * BLOCK : (k + 1) * BLOCK]
        counts = np.bincount(owner[a:b] * len(block) + column[a:b] - k * BLOCK, minlength=n * len(block))
        out += counts.reshape(n, len(block)).astype(np.float32) @ trigram_vectors(block).astype(np.float32)
    return out


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes from the rows with a language. Each task sends DIMENSIONS sums per language it saw, whatever its
    rows; the driver gets DIMENSIONS sums per language. Null texts and null languages teach nothing. More than MAX_LANGUAGES
    languages, as a column of something else may hold, are refused before any text is read."""

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            at = 0
            for texts in slices(batch.column("text"), ROWS):
                names = batch.column("lang").slice(at, len(texts)).to_pylist()
                numbers = {x: i for i, x in enumerate(dict.fromkeys(names))}
                group = np.array([numbers[x] for x in names], np.int64)
                at += len(texts)
                owner, codes = trigrams(texts.to_pylist())
                found = bundles(group[owner], codes, len(numbers))
                for x, i in numbers.items():
                    totals[x] = totals.get(x, 0) + found[i].astype(np.float64)
        for x, v in totals.items():
            yield pa.RecordBatch.from_pydict({"lang": [x] * DIMENSIONS, "i": np.arange(DIMENSIONS, dtype=np.int32), "v": v})

    ship(df.sparkSession)
    slim = df.select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null and text is not null")
    if df.select(lang).where(F.col(lang).isNotNull()).distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"column {lang} has more than {MAX_LANGUAGES} languages")
    sums = slim.mapInArrow(run, "lang string, i int, v double").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r.lang, np.zeros(DIMENSIONS))[r.i] = r.v
    return dict(sorted(out.items()))


def predict(df: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", into: str = "language") -> DataFrame:
    """df with a struct column: lang_pred, score. A column of that name is replaced.

    score is the cosine, at least 0. Null texts, texts without letters and, where nothing was learnt, all texts
    get `und` and 0. Ties go to the first language by name. Equal texts get equal answers; long texts are read whole; an empty df
    gives no rows, and other columns keep their values.
    """
    names = [*prototypes, UNKNOWN]
    matrix = np.array([v / max(np.linalg.norm(v), 1e-9) for v in prototypes.values()]).reshape(len(prototypes), DIMENSIONS)

    def make():
        def work(texts: list) -> pa.Array:
            owner, codes = trigrams(texts)
            v = bundles(owner, codes, len(texts))
            size = np.linalg.norm(v, axis=1)
            cosines = np.c_[v @ matrix.T / np.maximum(size, 1e-9)[:, None], np.full(len(texts), -2.0)]
            best = np.where(size > 0, cosines.argmax(axis=1), len(names) - 1)
            score = np.where(best < len(prototypes), cosines[np.arange(len(best)), best], 0.0)
            return struct_of(lang_pred=pa.array([names[i] for i in best], pa.string()), score=np.clip(score, 0.0, 1.0).astype(float))

        return work

    return df.withColumn(into, text_column("lang_pred string, score double", make, ROWS)(F.col(text)))
