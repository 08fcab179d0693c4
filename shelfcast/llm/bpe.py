"""BPE encoding and decoding over a table of distinct words.

Words are split in Spark, each distinct word is encoded once where its rows meet, and ids return
by position. Decoding joins every id with its piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import chunks as C
from shelfcast.llm import tokens


# Text bytes per bucket of distinct words (a bucket's words of all chunks are in memory at once).
BUCKET_BYTES = 16 << 20


def word_table(rows: DataFrame, path: str, buckets: int) -> DataFrame:
    """(chunk, bucket, ids) for packed words: each distinct word of a bucket is encoded once. There are
    as many partitions as buckets, which follow the size of the texts."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if bucket != last and held:
                    yield from encode_bucket(last, held)
                    held = []
                last = bucket
                held.append((chunk, C.unpack_words(data.as_py())))
        if held:
            yield from encode_bucket(last, held)

    def encode_bucket(bucket: int, held: list[tuple[int, list[bytes]]]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        table = {w: i for i, w in enumerate(dict.fromkeys(w for _, words in held for w in words))}
        ids = tokens.encode_words(path, list(table))
        length = np.array([len(x) for x in ids])
        flat = np.concatenate(ids)
        start = np.cumsum(length) - length
        for chunk, words in held:
            slot = np.array([table[w] for w in words])
            n = length[slot]
            stop = np.cumsum(n)
            take = np.arange(int(stop[-1])) + np.repeat(start[slot] - (stop - n), n)
            data = press.compress(np.int64(len(words)).tobytes() + C.planes(n) + C.planes(flat[take]))
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([bucket]), pa.array([data], pa.binary())], ["chunk", "bucket", "ids"])

    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    return dealt.mapInArrow(encode, "chunk long, bucket long, ids binary")


def _open_ids(right: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all distinct words of a chunk, in the order of their codes, and their bounds."""
    order = np.argsort(right.column("bucket").to_numpy()).tolist()
    column, lengths, ids = right.column("ids"), [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    for k in order:
        data = zstandard.ZstdDecompressor().decompress(column[k].as_py())
        count = int(np.frombuffer(data, np.int64, 1)[0])
        lengths.append(C.from_planes(data, count, 8))
        ids.append(C.from_planes(data, (len(data) - 8) // 4 - count, 8 + 4 * count))
    lengths = np.concatenate(lengths).astype(np.int64)
    if len(lengths) != words:
        raise RuntimeError(C.DIFFERENT)
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(lengths)])


class Pieces:
    """The id-to-piece table as flat bytes (one row per vocabulary entry)."""

    def __init__(self, path: str):
        pieces = tokens.piece_bytes(path)
        self.length = np.array([len(p) for p in pieces])
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The pieces of all ids, and where each id's piece starts."""
        length = self.length[ids]
        stop = np.cumsum(length)
        take = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.start[ids] - (stop - length), length)
        return self.flat[take].tobytes(), np.concatenate([[0], stop])


_pieces: dict[str, Pieces] = {}


def decode_ids(path: str, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Texts of consecutive id ranges; bytes that are no UTF-8 become replacement characters."""
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    whole, at = _pieces[path].join(ids)
    at = at[bounds].tolist()
    return [whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]


def encode(
    docs: DataFrame, path: str, digests: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ids and decoded text of every row: (id, n_tokens, ids, decoded), or with ``digests``
    (id, n_tokens, ids_sha256, decoded_sha256) without carrying the ids and texts further.

    A null text counts as empty and has no ids; null and repeated ids stay as they are, one
    output row per input row; other columns are ignored; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = C.steady(rows)
    splitter = lambda data, offsets: tokens.split(data, offsets, path)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, counts, columns, words = C.open_codes(left)
        flat, bounds = _open_ids(right, words)
        ends = np.concatenate([[0], np.cumsum(counts)])
        outs: list[list] = [[], [], []]
        row = 0
        while row < len(counts):
            # As many rows as hold about a million words.
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + 1_000_000, "right")) - 1)
            part = codes[ends[row] : ends[stop]]
            length = bounds[part + 1] - bounds[part]
            done = np.cumsum(length)
            take = np.arange(int(done[-1]) if len(done) else 0) + np.repeat(bounds[part] - (done - length), length)
            ids = flat[take]
            at = np.concatenate([[0], done])[ends[row : stop + 1] - ends[row]]
            outs[0].append(np.diff(at))
            decoded = decode_ids(path, ids, at)
            cut = at.tolist()
            if digests:
                numbers = _decimal(ids)
                outs[1] += [numbers(a, b) for a, b in zip(cut, cut[1:])]
                outs[2] += [hashlib.sha256(t.encode()).hexdigest() for t in decoded]
            else:
                outs[1] += [ids[a:b].astype(np.int32) for a, b in zip(cut, cut[1:])]
                outs[2] += decoded
            row = stop
        n = pa.array(np.concatenate(outs[0]).astype(np.int64))
        return pa.Table.from_arrays(
            [columns.column("id").combine_chunks(), n, pa.array(outs[1], pa.string() if digests else pa.list_(pa.int32())), pa.array(outs[2], pa.string())],
            names=names,
        )

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["id", "n_tokens", "ids", "decoded"]
    kinds = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "id long, n_tokens long, ids array<int>, decoded string"
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    table = word_table(C.packed_words(rows, splitter, buckets), path, buckets)
    return C.join_back(C.code_rows(rows, splitter, buckets=buckets), table, finish, kinds)


def _decimal(ids: np.ndarray):
    """Function of a range of ids: SHA-256 of their decimal forms joined by commas."""
    shown = ids.astype(str).tolist()

    def digest(a: int, b: int) -> str:
        return hashlib.sha256(",".join(shown[a:b]).encode()).hexdigest()

    return digest


def decode(rows: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) from an array of ids; null arrays give null, ids outside the vocabulary fail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()])]).astype(np.int64)
            texts = pa.array(decode_ids(path, ids.astype(np.int64), bounds), pa.string())
            texts = pa.compute.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "decoded"])

    import pyarrow.compute  # noqa: F401

    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(run, "id long, decoded string")
