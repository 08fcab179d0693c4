"""Distinct-word tables: texts as word codes per chunk, and each chunk's distinct words.

A chunk is a run of input rows with a bounded number of text bytes. It is made twice from the same
rows: once as its distinct words, which travel to wherever a word is resolved, and once as
compressed codes that wait for the answers. A word travels once per chunk, not once per use.

The two readings must agree. Words are numbered by their hashes, not by their place in the chunk, and
a chunk's number is a hash of its words: another set of words is another chunk, whose codes then find
no answers, and the job fails. Rows that are not read plainly from files are written first (``steady``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shelfcast.llm import words as W
from shelfcast.settings import settle

# Text bytes of a chunk (a longer single text is a chunk of its own).
CHUNK_BYTES = 16 << 20
# Rows per Arrow batch that leave a task.
OUT_ROWS = 20_000

DIFFERENT = "a chunk was read differently the second time; write the documents to a table first"

Splitter = Callable[[np.ndarray, np.ndarray], W.Words]


class Chunk:
    """One chunk while it is read: codes of all its words and the distinct words."""

    def __init__(self, lower: bool):
        self.lower, self.seen = lower, {}
        self.words, self.codes, self.counts, self.columns, self.size = [], [], [], [], 0

    def add(self, block: W.Words, columns: pa.RecordBatch) -> None:
        value, first, code = np.unique(block.hashes(self.lower), return_index=True, return_inverse=True)
        seen, slots, new = self.seen, np.empty(len(value), np.int32), []
        for i, h in enumerate(value.tolist()):
            slot = seen.get(h)
            if slot is None:
                slot = seen[h] = len(seen)
                new.append(i)
            slots[i] = slot
        self.words += block.texts(first[new], self.lower) if new else []
        self.codes.append(slots[code])
        self.counts.append(np.diff(block.bounds))
        self.columns.append(columns)
        self.size += len(block.data)

    def close(self) -> None:
        """Number the words by their hashes."""
        value = np.fromiter(self.seen, np.uint64, len(self.seen))
        order = np.argsort(value)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.values, self.codes = value[order], [rank[c] for c in self.codes]
        self.words = [self.words[k] for k in order.tolist()]

    def number(self, place: int) -> int:
        """A hash of the chunk's place and of its words."""
        mark = np.bitwise_xor.reduce(W.mix(self.values + np.uint64(1)), initial=np.uint64(len(self.values)))
        return int(W.mix(W.mix(np.array([place + 1], np.uint64)) ^ mark).view(np.int64)[0])

    def by_bucket(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every distinct word, and the words' order by bucket (then by hash)."""
        bucket = (self.values % np.uint64(buckets)).astype(np.int64)
        return bucket, np.argsort(bucket, kind="stable")

    def read(self) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """Codes, words per text, and the rows' other columns."""
        return np.concatenate(self.codes), np.concatenate(self.counts), pa.Table.from_batches(self.columns)


def chunks(batches: Iterator[pa.RecordBatch], splitter: Splitter, lower: bool) -> Iterator[tuple[int, Chunk]]:
    """Chunks of a task's rows (the text is the last column), each with its number."""
    base, place, chunk = TaskContext.get().partitionId() << 24, 0, Chunk(lower)

    def ready() -> tuple[int, Chunk]:
        chunk.close()
        return chunk.number(base + place), chunk

    for batch in batches:
        data, offsets = W.plain(batch.column(batch.num_columns - 1))
        others = batch.select(list(range(batch.num_columns - 1)))
        for a, b in W.ranges(offsets):
            if chunk.size and chunk.size + offsets[b] - offsets[a] > CHUNK_BYTES:
                yield ready()
                place, chunk = place + 1, Chunk(lower)
            block = splitter(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            chunk.add(block, others.slice(a, b - a))
    if chunk.columns:
        yield ready()


def steady(rows: DataFrame) -> DataFrame:
    """Rows that every reading gives alike: columns of files as they are, anything else written once."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    return rows if plan.deterministic() and _plain(plan) else settle(rows, "rows")


def _plain(plan) -> bool:
    name, parts = plan.nodeName().split("(")[0].strip(), plan.children()
    if parts.isEmpty():
        return name in ("LogicalRelation", "DataSourceV2ScanRelation", "RelationV2")
    return name in ("Project", "Filter") and all(_plain(parts.apply(k)) for k in range(parts.size()))


def planes(values: np.ndarray) -> bytes:
    """32-bit integers as four byte planes, which compress better."""
    return np.ascontiguousarray(values.astype(np.uint32, copy=False).view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes, count: int, at: int = 0) -> np.ndarray:
    flat = np.frombuffer(data, np.uint8, 4 * count, at)
    return np.ascontiguousarray(flat.reshape(4, count).T).view(np.uint32).ravel() if count else np.zeros(0, np.uint32)


def packed_words(docs: DataFrame, splitter: Splitter, buckets: int, lower: bool = False, train_col: bool = False) -> DataFrame:
    """(bucket, chunk, words): every chunk's distinct words packed per bucket of their hashes. With ``train_col``
    also ``uses``: how often each word is used in the rows marked in the column before the text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for number, chunk in chunks(batches, splitter, lower):
            bucket, order = chunk.by_bucket(buckets)
            cut = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)).tolist()
            if train_col:
                codes, counts, columns = chunk.read()
                mark = columns.column(columns.num_columns - 1).to_numpy().astype(bool)
                uses = np.bincount(codes[np.repeat(mark, counts)], minlength=len(order))[order]
            keys, data, used = [], [], []
            for a, b in zip(cut, cut[1:]):
                words = [chunk.words[k] for k in order[a:b].tolist()]
                lengths = planes(np.array([len(w) for w in words]))
                keys.append(int(bucket[order[a]]))
                data.append(press.compress(b"".join([np.int64(len(words)).tobytes(), lengths, *words])))
                if train_col:
                    used.append(press.compress(planes(uses[a:b])))
            for k in range(0, len(keys), OUT_ROWS):
                part = slice(k, k + OUT_ROWS)
                made = [pa.array(keys[part], pa.int64()), pa.array([number] * len(keys[part]), pa.int64()), pa.array(data[part], pa.binary())]
                if train_col:
                    made.append(pa.array(used[part], pa.binary()))
                yield pa.RecordBatch.from_arrays(made, names)

    names = ["bucket", "chunk", "words", *(["uses"] if train_col else [])]
    return docs.mapInArrow(emit, "bucket long, chunk long, words binary" + (", uses binary" if train_col else ""))


def dealt(packed: DataFrame, buckets: int) -> DataFrame:
    """Packed rows with all rows of a bucket together."""
    return packed.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of a task bucket by bucket (the bucket is the first column; rows are sorted by it)."""
    last, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if bucket != last and held:
                yield last, held
                held = []
            last = bucket
            held.append(tuple(row))
    if held:
        yield last, held


def unpack_words(data: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(data, np.int64, 1)[0])
    ends = (np.cumsum(from_planes(data, count, 8).astype(np.int64)) + 8 + 4 * count).tolist()
    return [data[a:b] for a, b in zip([8 + 4 * count, *ends], ends)]


def code_rows(docs: DataFrame, splitter: Splitter, lower: bool = False, buckets: int = 0) -> DataFrame:
    """(chunk, words, rows, codes): one row per chunk; ``rows`` is an Arrow stream of the other
    columns with the number of words of each row. With ``buckets``, codes follow the words' order
    by bucket, so that packed answers need no codes."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for number, chunk in chunks(batches, splitter, lower):
            codes, counts, columns = chunk.read()
            if buckets:
                _, order = chunk.by_bucket(buckets)
                place = np.empty(len(order), np.int32)
                place[order] = np.arange(len(order))
                codes = place[codes]
            columns = columns.append_column("_words", pa.array(counts.astype(np.int64)))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, columns.schema) as out:
                out.write_table(columns)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(chunk.words)], pa.int64()),
                    pa.array([press.compress(sink.getvalue().to_pybytes())], pa.binary()),
                    pa.array([press.compress(planes(codes))], pa.binary()),
                ],
                ["chunk", "words", "rows", "codes"],
            )

    return docs.mapInArrow(emit, "chunk long, words long, rows binary, codes binary")


def open_codes(left: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table, int]:
    """Codes, words per row, the rows' columns and the number of distinct words of a chunk."""
    if left.num_rows != 1:
        raise RuntimeError(DIFFERENT)
    open_ = zstandard.ZstdDecompressor()
    data = open_.decompress(left.column("codes")[0].as_py())
    codes = from_planes(data, len(data) // 4).view(np.int32)
    columns = pa.ipc.open_stream(open_.decompress(left.column("rows")[0].as_py())).read_all()
    counts = columns.column("_words").to_numpy()
    return codes, counts, columns.drop_columns(["_words"]), left.column("words")[0].as_py()


def join_back(codes: DataFrame, resolved: DataFrame, finish: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Bring the answers of each chunk (chunk, ...) to its codes; ``finish`` makes the rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(left, right)

    return codes.groupBy("chunk").cogroup(resolved.groupBy("chunk")).applyInArrow(run, schema)
