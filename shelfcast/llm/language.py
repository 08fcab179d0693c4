"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram vector binds (multiplies) the letters'
vectors, each permuted by its place; a text bundles (adds) the vectors of its n-grams, and a
language's prototype bundles its training texts. Texts go to the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from shelfcast.llm import words as W

# Dimensions (a multiple of 64); sharpness of the score; distinct languages that a model can hold
# (2 KB each in every task); languages whose sums a task holds before it hands them on.
DIMS, SHARP, MAX_LANGUAGES, HELD = 512, 20.0, 20_000, 1000
# Kinds of n-gram bound at once; ids of n-grams that are numbered by a table, not by sorting.
KINDS, DENSE = 1 << 14, 1 << 21
SEED = 41
# Text bytes and rows worked on at once: each row takes a dense row of the block's trigrams.
BLOCK_BYTES, BLOCK_ROWS = 1 << 19, 256
UNKNOWN = "und"
# One labelled row in so many may lie below a limit; steps of a limit.
RARE, BINS = 1000, 1000


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Lower-case letter of every code point, 0 for those that are no letters."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = ord(c.lower()[0])
    return table


def letter_vectors(points: np.ndarray) -> np.ndarray:
    """A random vector of +1 and -1 for every code point, from a seeded hash of the code point alone."""
    parts = np.arange(DIMS // 64, dtype=np.uint64)
    x = points.astype(np.uint64)[:, None] * np.uint64(DIMS // 64) + parts + np.uint64(SEED << 32)
    # Rounds of a 64-bit mixing function (odd multipliers are fixed values).
    x *= np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(points), -1), axis=1)
    return bits.astype(np.float32) * 2 - 1


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram, text) around every letter, and the block's letters; neighbours outside the word are gaps.

    A trigram is a number in base ``len(letters)`` whose digits are places in the list of the block's
    letters; the first of these is the gap.
    """
    lead = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(lead)])[offsets]
    points = letters()[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    seen = np.zeros(0x110000, bool)
    seen[0] = True
    seen[points] = True
    used = np.flatnonzero(seen)
    place = np.zeros(0x110000, np.int64)
    place[used] = np.arange(len(used))
    # A gap before the first text and after each text.
    s = np.insert(place[points], np.append(at[:-1], len(points)), 0)
    middle = np.flatnonzero(s[1:-1]) + 1 if len(s) > 2 else np.zeros(0, np.int64)
    gram = (s[middle - 1] * len(used) + s[middle]) * len(used) + s[middle + 1]
    starts = at[:-1] + np.arange(len(at) - 1)
    return gram, np.searchsorted(starts, middle, "right") - 1, used


def bundle(gram: np.ndarray, owner: np.ndarray, owners: int, used: np.ndarray) -> np.ndarray:
    """Sum of the n-gram vectors of every owner, as matrix products over slices of the kinds of n-gram."""
    size = len(used)
    if size**3 <= DENSE:
        seen = np.zeros(size**3, bool)
        seen[gram] = True
        kinds = np.flatnonzero(seen)
        table = np.empty(size**3, np.int64)
        table[kinds] = np.arange(len(kinds))
        column = table[gram]
    else:
        kinds, column = np.unique(gram, return_inverse=True)
    base = letter_vectors(used)
    one, two = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    out = np.zeros((owners, DIMS), np.float32)
    for a in range(0, len(kinds), KINDS):
        part = kinds[a : a + KINDS]
        mine = slice(None) if len(kinds) <= KINDS else (column >= a) & (column < a + len(part))
        cell = owner[mine] * len(part) + (column[mine] - a)
        counts = np.bincount(cell, minlength=owners * len(part)).reshape(owners, len(part))
        bound = one[part // size**2] * two[part // size % size] * base[part % size]
        out += counts.astype(np.float32) @ bound
    return out


@dataclass
class Profiles:
    languages: list[str]
    prototypes: np.ndarray

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, largest cosine and number of letters of every text."""
        texts = len(offsets) - 1
        gram, owner, used = trigrams(data, offsets)
        if not len(gram) or not self.languages:
            return [UNKNOWN] * texts, np.zeros(texts), np.zeros(texts), np.bincount(owner, minlength=texts)
        vectors = bundle(gram, owner, texts, used)
        cosine = vectors @ self.prototypes.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        best = cosine.argmax(axis=1)
        share = np.exp(SHARP * (cosine - cosine.max(axis=1, keepdims=True)).astype(np.float64))
        score = 1.0 / share.sum(axis=1)
        sizes = np.bincount(owner, minlength=texts)
        none = sizes == 0
        most = np.where(none, 0.0, cosine.max(axis=1).astype(np.float64))
        return [UNKNOWN if e else self.languages[b] for e, b in zip(none, best)], np.where(none, 0.0, score), most, sizes


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """Prototypes of all languages, from all rows with a text and a language.

    Null texts and languages teach nothing, nor do texts without a letter; repeated rows count each. More
    than ``MAX_LANGUAGES`` distinct values are an error: such a column does not name languages.
    """

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            codes = {n: i for i, n in enumerate(dict.fromkeys(names))}
            code = np.array([codes[n] for n in names])
            data, offsets = W.plain(batch.column(0))
            for a, b in W.ranges(offsets, BLOCK_BYTES, BLOCK_ROWS):
                gram, owner, used = trigrams(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if not len(gram):
                    continue
                kinds, index = np.unique(code[a:b], return_inverse=True)
                found = bundle(gram, index[owner], len(kinds), used).astype(np.float64)
                every = list(codes)
                for k, v in zip(kinds.tolist(), found):
                    sums[every[k]] = sums.get(every[k], 0.0) + v
            if len(sums) > HELD:
                yield from _rows(sums)
                sums = {}
        yield from _rows(sums)

    def _rows(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"]
            )

    known = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = known.filter("text is not null and lang is not null").mapInArrow(W.tidy(bundles), "lang string, v array<double>")
    sums = parts.select("lang", F.posexplode("v").alias("d", "x")).groupBy("lang", "d").agg(F.sum("x").alias("x"))
    total = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v"))
    found = total.select("lang", "v.x").limit(MAX_LANGUAGES + 1).toArrow().combine_chunks().sort_by("lang")
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in {lang_col}")
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in found.column("x").chunks]
    table = np.concatenate([np.zeros(0), *flat]).reshape(len(found), DIMS)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)
    return Profiles(found.column("lang").to_pylist(), table.astype(np.float32))


def predict(
    docs: DataFrame, model: Profiles, lang: str = "lang_pred", score: str = "score", text_col: str = "text", more: tuple[str, str] | None = None
) -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1, and with the largest cosine and the
    number of letters if two columns are named for them (``more``). Columns of these names are replaced.

    The language is ``und`` with score 0 for null texts, texts without a letter, and where nothing
    was learned. Ties go to the language whose name comes first. All other columns stay as they are;
    an empty table stays empty.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LANGUAGES vectors
    new = [lang, score, *(more or ())]
    docs = docs.drop(*new)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.plain(batch.column(names.index(text_col)))
            langs, scores, most, sizes = [], [np.zeros(0)], [np.zeros(0)], [np.zeros(0, np.int64)]
            for a, b in W.ranges(offsets, BLOCK_BYTES, BLOCK_ROWS):
                found, value, near, size = held.value.predict(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                langs += found
                scores.append(value)
                most.append(near)
                sizes.append(size)
            made = [pa.array(langs, pa.string()), *(pa.array(np.concatenate(x)) for x in (scores, most, sizes))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made[: len(new)]], [*names, *new])

    schema = StructType([*docs.schema.fields]).add(lang, StringType()).add(score, DoubleType())
    schema = schema.add(more[0], DoubleType()).add(more[1], LongType()) if more else schema
    return docs.mapInArrow(W.tidy(run), schema)


def _size(letters: str) -> Column:
    return F.floor(F.log2(F.col(letters))).cast("int")


def limits(rows: DataFrame, model: Profiles, text_col: str = "text", lang_col: str = "lang") -> dict[int, tuple[float, float]]:
    """Least cosine and least score of a placed text, per size (binary logarithm of its letters).

    Measured are the values that all labelled rows of a size but one in ``RARE`` reach (the least ones of
    fewer rows). The limits are half that cosine, and the middle of that score and a tie of two languages.
    """
    known = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang is not null")
    found = predict(known, model, "_lang", "_score", more=("_near", "_letters")).filter(F.col("_lang") != UNKNOWN)
    step = lambda c: F.floor(F.col(c) * BINS)
    values = F.array(*(F.struct(F.lit(k).alias("k"), step(c).alias("at")) for k, c in enumerate(("_near", "_score"))))
    pairs = found.select(_size("_letters").alias("size"), F.explode(values).alias("p"))
    # At most some BINS rows for each size.
    counts = pairs.groupBy("size", "p.k", "p.at").agg(F.count(F.lit(1)).alias("n")).collect()
    least: dict[int, list[float]] = {}
    for size in sorted({r["size"] for r in counts}):
        for k in (0, 1):
            table = sorted((r["at"], r["n"]) for r in counts if (r["size"], r["k"]) == (size, k))
            spare = sum(n for _, n in table) // RARE
            below = np.cumsum([n for _, n in table])
            least.setdefault(size, []).append(table[int(np.searchsorted(below, spare, "right"))][0] / BINS)
    return {size: (min(near, near / 2), sure if sure < 0.5 else (sure + 0.5) / 2) for size, (near, sure) in least.items()}


def placed(least: dict[int, tuple[float, float]], lang: str, score: str, cosine: str, letters: str) -> Column:
    """Whether a text reaches the limits of its size, or those of the next smaller size that has any."""
    inside = F.lit(True)
    for size, (near, sure) in sorted(least.items()):
        inside = F.when(_size(letters) >= size, (F.col(cosine) >= near) & (F.col(score) >= sure)).otherwise(inside)
    return (F.col(lang) != UNKNOWN) & inside
