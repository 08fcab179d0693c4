"""Quality by nearest-neighbour voting over latent-semantic vectors.

Texts are hashed counts of their words and of the words' shapes. A truncated SVD of the labelled
sample gives the latent directions. The sample's vectors, bounded by ``MAX_ROWS``, are broadcast;
every document takes its exact cosine with all of them, block by block, and the nearest
ones vote with weights that grow with similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import words as W

# Labelled rows that are fitted at most, hashed word features, shape features, latent
# dimensions, neighbours that vote, and the power of the similarity in a vote.
MAX_ROWS, WORD_SLOTS, SHAPES, DIMS, NEAREST, POWER = 6000, 3840, 256, 64, 32, 4.0
# Text bytes and rows worked on at once: each row takes a dense row of all features.
BLOCK_BYTES, BLOCK_ROWS = 1 << 19, 256

_CLASS = np.full(256, 1 << 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 4
_CLASS[[33, 63]], _CLASS[[35, 36, 37, 38, 42]], _CLASS[[60, 62, 124]] = 8, 16, 32
_CLASS[128:] = 128


def features(block: W.Words) -> np.ndarray:
    """Counts of hashed words and word shapes (which kinds of bytes a word holds) per text."""
    texts, slots = len(block.bounds) - 1, WORD_SLOTS + SHAPES
    if not len(block):
        return np.zeros((texts, slots), np.float32)
    owner = W.owners(block.bounds)
    word = (block.hashes(lower=True) % np.uint64(WORD_SLOTS)).astype(np.int64)
    kinds = _CLASS[block.data].copy()
    kinds[W.SPACE[block.data]] = 0
    shape = np.bitwise_or.reduceat(kinds, block.starts).astype(np.int64)
    both = np.concatenate([owner * slots + word, owner * slots + WORD_SLOTS + shape])
    return np.bincount(both, minlength=texts * slots).reshape(texts, slots).astype(np.float32)


@dataclass
class Neighbours:
    """Fitted model: term weights, latent directions, labelled vectors and their labels."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts.copy(), self.weights) @ self.directions)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.project(counts) @ self.vectors.T
        k = min(NEAREST, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** POWER
        votes = (weight * self.labels[near]).sum(axis=1) + 0.1 * self.prior
        score = np.clip(votes / (weight.sum(axis=1) + 0.1), 0.0, 1.0)
        return np.where(counts.any(axis=1), score, self.prior)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Counts to weighted terms, in place and some rows at a time; words and shapes weigh the same."""
    for k in range(0, len(counts), BLOCK_ROWS):
        x = counts[k : k + BLOCK_ROWS]
        np.log1p(x, out=x)
        x *= weights
        for part in (x[:, :WORD_SLOTS], x[:, WORD_SLOTS:]):
            part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return counts


def _latent(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, directions, vectors) of the sample. ``counts`` is used up: the one table of this size."""
    used = np.count_nonzero(counts, axis=0)
    weights = np.log((1 + len(counts)) / (1.0 + used)).astype(np.float32) + np.float32(0.1)
    x = _weighted(counts, weights)
    # Randomised truncated SVD with three power steps.
    rank = min(DIMS, min(x.shape))
    span = x @ np.random.default_rng(7).standard_normal((x.shape[1], rank + 16)).astype(np.float32)
    for _ in range(3):
        span = x @ (x.T @ np.linalg.qr(span)[0])
    base = np.linalg.qr(span)[0]
    directions = np.linalg.svd(base.T @ x, full_matrices=False)[2][:rank].T.copy()
    return weights, directions, _unit(x @ directions)


def fit(rows: DataFrame, text_col: str = "text", label_col: str = "label", max_rows: int = MAX_ROWS) -> Neighbours:
    """Fit on at most ``max_rows`` rows with label 0 or 1, chosen by a hash of the whole row. No row gives
    a model that scores everything 0.5; ties among the hashes are broken by the label.

    So copies of a text under different ids are chosen one by one. Rows that are equal throughout count once.
    """
    counts = {r["label"]: r["n"] for r in rows.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.get(k, 0) for k in (0, 1))
    prior = counts.get(1, 0) / total if total else 0.5
    slots = WORD_SLOTS + SHAPES
    if not total:
        return Neighbours(np.ones(slots, np.float32), np.zeros((slots, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), prior)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in W.blocks(batch.column(0), BLOCK_BYTES, most=BLOCK_ROWS):
                table = features(block)
                packed = [(np.flatnonzero(t).astype(np.int32), t[t > 0]) for t in table]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([i.tobytes() for i, _ in packed], pa.binary()), pa.array([v.tobytes() for _, v in packed], pa.binary())],
                    ["label", "mark", "at", "value"],
                )

    share = min(1.0, max_rows / total)
    chosen = rows.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("label"), F.xxhash64(*rows.columns, F.lit(11)).alias("mark"))
    chosen = chosen.filter(F.pmod("mark", F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    sample = chosen.mapInArrow(W.tidy(count), "label int, mark long, at binary, value binary").dropDuplicates(["mark", "label"]).orderBy("mark", "label").limit(max_rows).collect()
    table = np.zeros((len(sample), slots), np.float32)
    for row, r in zip(table, sample):
        row[np.frombuffer(bytes(r["at"]), np.int32)] = np.frombuffer(bytes(r["value"]), np.float32)
    labels = np.array([r["label"] for r in sample], np.float64)
    del sample
    if not len(labels):
        return Neighbours(np.ones(slots, np.float32), np.zeros((slots, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    weights, directions, vectors = _latent(table)
    return Neighbours(weights, directions, vectors, labels, prior)


def score(docs: DataFrame, model: Neighbours, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the score of label 1 (0 to 1) in column ``name``; a column of that name is replaced.

    All other columns stay as they are. Null, empty and wordless texts score the share of label 1 among
    the labelled rows (0.5 without any). Whole texts count, however long; of equally near neighbours at the
    limit any may vote. Repeated rows score alike; an empty table stays empty.
    """
    docs = docs.drop(name)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MAX_ROWS vectors
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = W.blocks(batch.column(names.index(text_col)), BLOCK_BYTES, most=BLOCK_ROWS)
            scores = [held.value.score(features(block)) for _, _, block in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores or [np.zeros(0)]), pa.float64())], [*names, name])

    return docs.mapInArrow(W.tidy(run), _with(docs, name))


def _with(docs: DataFrame, name: str):
    from pyspark.sql.types import DoubleType, StructType

    return StructType([*docs.schema.fields]).add(name, DoubleType())
