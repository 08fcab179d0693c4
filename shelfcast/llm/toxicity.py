"""Toxicity by class-conditional Kneser-Ney models of words.

As in Kneser-Ney smoothing, a word counts once per context it appears in (here a document), a
discount is taken from every count, and what the discounts free goes to a backoff distribution that
both classes share: the word's documents of either class. The discount is as large as chance: what
is left of a class's count is only what goes beyond the spread that the shared expectation allows. So
words of any rarity are scored, and rare ones fall to the shared backoff, where both classes agree.
The score compares the two log-likelihoods of a text, divided by its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.llm import words as W
from shelfcast.settings import settle, settle_counted

# The discount in standard deviations of a word's count under the shared expectation, its least
# variance, pseudo-documents of every word, the shortest length a text is divided by, rows used for
# calibration, and words that are broadcast at a time.
DISCOUNT, LEAST_VARIANCE, ADD, MIN_LENGTH, CALIBRATE, AT_ONCE = 5.0, 0.25, 0.25, 20, 8000, 1_000_000

# A word here is a run of letters: everything but ASCII other than a-z and A-Z.
STOPS = np.ones(256, bool)
STOPS[65:91] = STOPS[97:123] = STOPS[128:] = False


def log_ratio(c0, c1, n0, n1):
    """Log of the two smoothed probabilities of a word, class 1 over class 0, from the documents of each
    class that hold it (numpy arrays) and all documents of each class; 0 where chance explains the counts."""
    both, share = c0 + c1, n1 / (n0 + n1)
    expected = both * share
    discount = DISCOUNT * np.sqrt(np.maximum(both * share * (1 - share), LEAST_VARIANCE))
    left = np.sign(c1 - expected) * np.maximum(np.abs(c1 - expected) - discount, 0.0)
    one, zero = expected + left + ADD * share, both - expected - left + ADD * (1 - share)
    return np.where(left == 0, 0.0, np.log(one / n1) - np.log(zero / n0))


@dataclass
class ClassModels:
    """The words whose class probabilities differ (hash ``h``, ``ratio``), and the scale of the score."""

    terms: DataFrame | None
    count: int = 0
    slope: float = 1.0
    middle: float = 0.0
    prior: float = 0.0

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sorted hashes and their ratios, at most about ``AT_ONCE`` at a time."""
        parts = -(-self.count // AT_ONCE)
        for k in range(parts):
            table = self.terms.filter(F.pmod("h", F.lit(parts)) == k).toArrow()
            keys, ratio = table.column("h").to_numpy().view(np.uint64), table.column("ratio").to_numpy()
            order = np.argsort(keys)
            yield keys[order], ratio[order]

    def score(self, total: str, length: str) -> Column:
        """Score from the sum of a text's ratios and its number of words."""
        x = F.col(total) / F.greatest(F.col(length), F.lit(MIN_LENGTH)) - F.lit(float(self.middle))
        x = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), F.lit(float(self.slope)) * x))
        return F.when(F.col(length) == 0, F.lit(float(self.prior))).otherwise(1 / (1 + F.exp(-x)))


def _counts(rows: DataFrame) -> DataFrame:
    """(h, c0, c1): documents of each class with a word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy()
            for a, b, block in W.blocks(batch.column(0), stops=STOPS):
                hashed, owner = block.hashes(lower=True), W.owners(block.bounds)
                order = np.lexsort((hashed, owner))
                h, o = hashed[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                keys, code = np.unique(h[new], return_inverse=True)
                toxic = label[a:b][o[new]] == 1
                c1 = np.bincount(code[toxic], minlength=len(keys))
                c0 = np.bincount(code[~toxic], minlength=len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(c0.astype(np.int64)), pa.array(c1.astype(np.int64))], ["h", "c0", "c1"])

    table = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(W.tidy(count), "h long, c0 long, c1 long")
    return table.groupBy("h").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


def _ratios(counts: DataFrame, n0: int, n1: int) -> DataFrame:
    """(h, ratio) of the words whose ratio is not 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratio = log_ratio(batch.column(1).to_numpy().astype(float), batch.column(2).to_numpy().astype(float), n0, n1)
            kept = np.flatnonzero(ratio)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), pa.array(ratio[kept])], ["h", "ratio"])

    return counts.mapInArrow(run, "h long, ratio double")


def fit(rows: DataFrame) -> ClassModels:
    """Fit on all rows (id, text, label 0/1): every word of every text is counted.

    Without rows of both classes the model scores the share of label 1 (0 without any row). Null texts
    and labels are left out; repeated rows count again; whole texts count, however long.
    """
    rows = rows.filter("label in (0, 1) and text is not null")
    docs = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = docs.get(0, 0), docs.get(1, 0)
    prior = n1 / (n0 + n1) if n0 + n1 else 0.0
    if not n0 or not n1:
        return ClassModels(None, prior=prior)
    model = ClassModels(*settle_counted(_ratios(_counts(rows), n0, n1), "ratios"), prior=prior)
    _calibrate(model, rows, n0 + n1)
    return model


def _sums(rows: DataFrame, model: ClassModels, total: str, length: str) -> DataFrame:
    """``rows`` with the sum of the ratios of every text's words and the number of its words."""
    rows = rows.withColumns({total: F.lit(0.0), length: F.lit(0).cast("long")})
    names, kind = rows.columns, StructType(rows.schema.fields)
    text, at, size = names.index("text"), names.index(total), names.index(length)
    # Usually one pass; each further one reads what the one before wrote, so one block is held at a time.
    for number, (keys, ratio) in enumerate(model.blocks() if model.terms is not None else ()):
        held = rows.sparkSession.sparkContext.broadcast((keys, ratio))  # about AT_ONCE words

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            keys, ratio = held.value
            for batch in batches:
                sums, sizes = [np.zeros(0)], [np.zeros(0, np.int64)]
                for _, _, block in W.blocks(batch.column(text), stops=STOPS):
                    hashed = block.hashes(lower=True)
                    place = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
                    value = np.where(keys[place] == hashed, ratio[place], 0.0)
                    sums.append(np.diff(np.concatenate([[0.0], np.cumsum(value)])[block.bounds]))
                    sizes.append(np.diff(block.bounds))
                columns = list(batch.columns)
                columns[at] = pa.array(columns[at].to_numpy() + np.concatenate(sums))
                columns[size] = pa.array(np.concatenate(sizes).astype(np.int64))
                yield pa.RecordBatch.from_arrays(columns, names)

        rows = (settle(rows, "sums") if number else rows).mapInArrow(W.tidy(run), kind)
    return rows


def _calibrate(model: ClassModels, rows: DataFrame, total: int) -> None:
    """Logistic fit of the label on the mean ratio, over at most about ``CALIBRATE`` rows.

    Rows are chosen and ordered by a hash of the whole row, so copies of a text are chosen one by one;
    rows that are equal throughout are one row with their number as weight.
    """
    mark = F.xxhash64(*rows.columns, F.lit(5))
    share = min(1.0, CALIBRATE / total)
    chosen = rows.withColumn("mark", mark).filter(F.pmod("mark", F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    measured = _sums(chosen.select("text", F.col("label").cast("int").alias("y"), "mark"), model, "sum", "n")
    x = F.max(F.col("sum") / F.greatest("n", F.lit(MIN_LENGTH))).alias("x")
    sample = measured.groupBy("mark", "y").agg(x, F.count(F.lit(1)).alias("n")).orderBy("mark", "y").limit(2 * CALIBRATE).collect()
    x, y, n = np.array([r["x"] for r in sample]), np.array([r["y"] for r in sample], float), np.array([r["n"] for r in sample], float)
    if len(np.unique(y)) < 2:
        return
    unit = max(float(np.sqrt(np.average((x - np.average(x, weights=n)) ** 2, weights=n))), 1e-9)
    a = np.stack([x / unit, np.ones(len(x))], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps with a slight pull to zero
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (n * (y - p)) - 0.01 * beta
        hess = (a * (n * p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    if beta[0] > 0:
        model.slope, model.middle = beta[0] / unit, -beta[1] / beta[0] * unit


def score(docs: DataFrame, model: ClassModels, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of the toxic class (0 to 1) in column ``name``; a column of that name is
    replaced.

    All other columns stay as they are. Null, empty and wordless texts score the share of toxic rows
    in the training rows. Whole texts count, however long; repeated rows score alike; an empty table
    stays empty.
    """
    docs = docs.drop(name)
    names = docs.columns
    total, length = (next(c for c in (f"_{k}" + "_" * i for i in range(len(names) + 1)) if c not in names) for k in ("sum", "length"))
    named = docs.withColumnRenamed(text_col, "text") if text_col != "text" else docs
    found = _sums(named, model, total, length)
    if model.terms is None or not model.count:  # nothing to sum: the texts' lengths do not matter
        return docs.withColumn(name, F.lit(float(model.prior)))
    found = found.withColumn(name, model.score(total, length)).drop(total, length)
    return found.withColumnRenamed("text", text_col) if text_col != "text" else found
