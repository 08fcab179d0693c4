"""Tokens of two tokenizers side by side: which overlap, and where both end.

Both sides cut a text only where their vocabularies allow, so a chunk's distinct words are encoded
once and documents get their tokens by position. Overlaps come from two as-of merges per batch: each
token start finds the other side's covering token. How many documents hold an id pair is counted
over the whole corpus in Spark, with each chunk's distinct pairs packed per bucket.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import tokens
from shelfcast.llm import words as W
from shelfcast.settings import settle

# Text bytes of a chunk and of a batch (a longer single text is one of its own).
CHUNK_BYTES, BATCH_BYTES = 16 << 20, 2 << 20
# Pairs of all chunks in one bucket, about.
BUCKET_PAIRS = 2_000_000
# How byte-level vocabularies of this family split a text before merging (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# The stand-in for a space in pieces (a fixed value).
MARK = "▁"


class Pieces:
    """Bytes of every id, flat."""

    def __init__(self, pieces: list[bytes]):
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.start[ids], self.length[ids])]


def spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of consecutive ranges, one after the other."""
    stop = np.cumsum(length)
    return np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(start - (stop - length), length)


class ByteSide:
    """A byte-level BPE file; strings of its special tokens inside texts are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        special = set(tokens.load(path).get_added_tokens_decoder())
        pieces = tokens.piece_bytes(path)
        self.pieces = Pieces(pieces)
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self.coder = None
        if made == sorted(made):  # merges in the order of their ids: ids are ranks
            import tiktoken

            ranks = {p: i for i, p in enumerate(pieces) if i not in special}
            self.coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_file(path)
            self.plain.no_truncation()
            self.plain.no_padding()
            self.plain.encode_special_tokens = True

    def encode(self, words: list[str]) -> list[list[int]]:
        if self.coder:
            return [self.coder.encode_ordinary(w) for w in words]
        return [x.ids for x in self.plain.encode_batch_fast(words, add_special_tokens=False)]


class PieceSide:
    """A SentencePiece model that puts a space before every text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        shown = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        byte = [self.model.is_byte(i) for i in range(len(shown))]
        self.pieces = Pieces([bytes([int(p[3:5], 16)]) if b else p.replace(MARK, " ").encode() for p, b in zip(shown, byte)])
        self.space = self.model.piece_to_id(MARK)
        # Words can be encoded one by one if no piece holds a space after another character, nor a line end.
        self.cuts = not any(MARK in p.lstrip(MARK) or "\n" in p for p, b in zip(shown, byte) if not b)
        self.cuts &= self.model.encode(" a") != self.model.encode("a") and self.model.id_to_piece(self.space) == MARK

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of words that begin with a space or a line end."""
        found = self.model.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        for k, word in enumerate(words):
            if word == " ":
                found[k] = [self.space]
            elif word[0] != " ":
                if found[k][0] != self.space:
                    raise RuntimeError("the model joins its leading space with a line end")
                found[k] = found[k][1:]
        return found


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[ByteSide, PieceSide]:
    """Both tokenizers, once per Python worker."""
    return ByteSide(path_a), PieceSide(path_b)


_WIDE = re.compile("|".join(re.escape(c) for c in tokens.WIDE_SPACE).encode())


def pieces_of(data: np.ndarray, offsets: np.ndarray, cuts: bool) -> W.Words:
    """Words that tile every text (each begins with a space): cut where a space or line end follows
    another character. Texts with white space beyond ASCII, or all texts if ``cuts`` is off, stay whole."""
    space = W.SPACE[data]
    mark = np.zeros(len(data), bool)
    if cuts and len(data):
        mark[1:] = ((data[1:] == 32) | (data[1:] == 10)) & ~space[:-1]
        whole = data.tobytes() if (data >= 0xC2).any() else b""
        for found in _WIDE.finditer(whole):
            i = int(np.searchsorted(offsets, found.start(), "right")) - 1
            mark[offsets[i] : offsets[i + 1]] = False
    mark[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(mark)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return W.Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


class Coded:
    """Ids of a chunk's distinct words on one side."""

    def __init__(self, side: ByteSide | PieceSide, words: list[str], raw: np.ndarray, bounds: np.ndarray):
        ids = side.encode(words)
        self.count = np.array([len(x) for x in ids], np.int64)
        self.ids = np.fromiter((i for x in ids for i in x), np.int64, int(self.count.sum()))
        self.at = np.cumsum(self.count) - self.count
        self.pieces = side.pieces
        # Whether the pieces' bytes are the word.
        done = np.concatenate([[0], np.cumsum(self.pieces.length[self.ids])])[np.concatenate([self.at, [len(self.ids)]])]
        self.same = np.diff(done) == np.diff(bounds)
        if self.same.all():
            wrong = np.flatnonzero(self.pieces.join(self.ids) != raw)
            self.same[np.searchsorted(bounds, wrong, "right") - 1] = False
        else:
            for k in np.flatnonzero(self.same).tolist():
                part = self.ids[self.at[k] : self.at[k] + self.count[k]]
                self.same[k] = np.array_equal(self.pieces.join(part), raw[bounds[k] : bounds[k + 1]])

    def tokens(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive words and the byte at which each token ends."""
        ids = self.ids[spread(self.at[slots], self.count[slots])]
        return ids, np.cumsum(self.pieces.length[ids])


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (A token, B token) whose byte ranges overlap.

    Positions run through a batch's documents end to end, and both sides tile every document: the
    one number is the key (document, byte). Each start on one side finds the last start at or before
    it on the other, which is the token that covers it; of two overlapping tokens the later one
    starts inside the other, so both directions together give every pair. Equal starts come twice.
    """
    start_a, start_b = np.concatenate([[0], end_a[:-1]]), np.concatenate([[0], end_b[:-1]])
    a = pd.DataFrame({"at": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"at": start_b, "b": np.arange(len(start_b))})
    cover_b = pd.merge_asof(a, b, on="at")["b"].to_numpy()
    cover_a = pd.merge_asof(b, a, on="at")["a"].to_numpy()
    new = start_a[cover_a] != start_b
    return np.concatenate([a["a"].to_numpy(), cover_a[new]]), np.concatenate([cover_b, b["b"].to_numpy()[new]])


@lru_cache(maxsize=4)
def _shown(size: int, ends: str) -> list[str]:
    """Decimal id followed by each of the given ends, at id * len(ends) + end."""
    return [f"{i}{e}" for i in range(size) for e in ends]


class Batch:
    """Links, groups and texts of groups of some documents' tokens."""

    def __init__(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], bounds: np.ndarray, sizes: tuple[int, int]):
        """``bounds``: the bytes at which documents begin, and the end."""
        (id_a, end_a), (id_b, end_b) = a, b
        self.docs = len(bounds) - 1
        in_a, in_b = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
        shut_a = end_b[np.minimum(in_a, len(end_b) - 1)] == end_a if len(end_b) else np.zeros(len(end_a), bool)
        shut_b = end_a[np.minimum(in_b, len(end_a) - 1)] == end_b if len(end_a) else np.zeros(len(end_b), bool)
        at_a, at_b = np.searchsorted(end_a, bounds, "right"), np.searchsorted(end_b, bounds, "right")
        at_a[0] = at_b[0] = 0
        self.n_a, self.n_b = np.diff(at_a), np.diff(at_b)
        groups = np.concatenate([[0], np.cumsum(shut_a)])
        self.n_groups = np.diff(groups[at_a])
        self._hash(id_a, id_b, shut_a, shut_b, groups, at_a + at_b, sizes)
        one, two = overlaps(end_a, end_b) if len(end_a) else (np.zeros(0, np.int64),) * 2
        doc = np.searchsorted(at_a[1:], one, "right")
        self.n_links = np.bincount(doc, minlength=self.docs)
        # Distinct (document, pair) with the number of links, by document and pair.
        key = np.sort(doc * (sizes[0] * sizes[1]) + id_a[one] * sizes[1] + id_b[two])
        first = np.flatnonzero(np.diff(key, prepend=-1))
        self.uses = np.diff(np.append(first, len(key)))
        doc, self.pairs = np.divmod(key[first], sizes[0] * sizes[1])
        self.entries = np.bincount(doc, minlength=self.docs)

    def _hash(self, id_a, id_b, shut_a, shut_b, groups, at, sizes) -> None:
        """SHA-256 of every document's groups: A's ids, then B's, group by group."""
        before_b = np.concatenate([[0], np.flatnonzero(shut_b) + 1])  # B tokens before each group
        group_b = np.cumsum(shut_b) - shut_b
        code = np.empty(len(id_a) + len(id_b), np.int64)
        code[np.arange(len(id_a)) + before_b[groups[:-1]]] = id_a * 2 + shut_a
        after_a = np.concatenate([np.flatnonzero(shut_a) + 1, [0]])[group_b]  # A tokens up to the group's end
        code[np.arange(len(id_b)) + after_a] = sizes[0] * 2 + id_b * 2 + shut_b
        shown = _shown(sizes[0], ",|") + _shown(sizes[1], ",;")
        text = [shown[c] for c in code.tolist()]
        cut = at.tolist()
        self.sha = [hashlib.sha256("".join(text[a:b])[:-1].encode()).hexdigest() if b > a else "" for a, b in zip(cut, cut[1:])]


def press(values: np.ndarray) -> bytes:
    """64-bit integers as byte planes, compressed."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpress(data: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(np.int64).ravel() if len(flat) else np.zeros(0, np.int64)


# What a chunk says of each of its documents, in order.
DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "entries"]
CHUNK_KIND = (
    "chunk long, n_pairs long, pairs binary, holders binary, codes binary, uses binary, ids binary, "
    + ", ".join(f"{c} binary" for c in DOC_COLUMNS)
    + ", sha array<string>"
)


def _chunk_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per chunk: its documents' numbers, its distinct pairs with the number of documents
    that hold each, and per document the pairs it holds (codes) with their links (uses)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, place = TaskContext.get().partitionId() << 24, 0
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            _, offsets = W.plain(batch.column(1))
            for a, b in W.ranges(offsets, BATCH_BYTES):
                more = int(offsets[b] - offsets[a])
                if held and size + more > CHUNK_BYTES:
                    yield solve(base + place, held)
                    place, held, size = place + 1, [], 0
                held.append(batch.slice(a, b - a))
                size += more
        if held:
            yield solve(base + place, held)

    def solve(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        side_a, side_b = sides(path_a, path_b)
        sizes = len(side_a.pieces.length), len(side_b.pieces.length)
        table = pa.Table.from_batches(parts)
        data, offsets = W.plain(table.column(1))
        # A space before every text that has one; empty texts have no words.
        full = np.flatnonzero(np.diff(offsets) > 0)
        begin = offsets[:-1] + np.searchsorted(full, np.arange(len(offsets) - 1))
        data = np.insert(data, offsets[full], 32)
        offsets = np.append(begin, len(data))
        block = pieces_of(data, offsets, side_b.cuts)
        _, first, slots = np.unique(block.hashes(), return_index=True, return_inverse=True)
        words = block.texts(first)
        raw = np.frombuffer(b"".join(words), np.uint8)
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        words = [w.decode() for w in words]
        a, b = (Coded(side, words, raw, bounds) for side in (side_a, side_b))
        # A document with a word that either side changes has no tokens.
        bad = np.concatenate([[0], np.cumsum(~(a.same & b.same)[slots])])[block.bounds]
        keep = np.diff(bad) == 0
        out: dict[str, list] = {c: [] for c in (*DOC_COLUMNS, "sha", "pairs", "uses")}
        for k, stop in W.ranges(offsets, BATCH_BYTES):
            use = np.repeat(keep[k:stop], np.diff(block.bounds[k : stop + 1]))
            part = slots[block.bounds[k] : block.bounds[stop]][use]
            length = np.where(keep[k:stop], np.diff(offsets[k : stop + 1]), 0)
            found = Batch(a.tokens(part), b.tokens(part), np.concatenate([[0], np.cumsum(length)]), sizes)
            out["sha"] += found.sha
            for c in (*DOC_COLUMNS, "pairs", "uses"):
                out[c].append(getattr(found, c))
        flat = {c: np.concatenate(v) for c, v in out.items() if c != "sha"}
        pairs, code, holders = np.unique(flat.pop("pairs"), return_inverse=True, return_counts=True)
        steps = np.diff(code, prepend=0)
        ids = table.column(0).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", pa.int64())])) as stream:
            stream.write_batch(pa.RecordBatch.from_arrays([ids], ["id"]))
        ready = [press(pairs), press(holders), press(steps), press(flat["uses"]), sink.getvalue().to_pybytes()]
        ready += [press(flat[c]) for c in DOC_COLUMNS]
        names = [part.split()[0] for part in CHUNK_KIND.split(", ")]
        columns = [pa.array([number]), pa.array([len(pairs)]), *(pa.array([x], pa.binary()) for x in ready), pa.array([out["sha"]], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(W.tidy(emit), CHUNK_KIND)


def _bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return (W.mix(pairs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _pair_rows(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, pairs, holders): every chunk's distinct pairs, packed per bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, holders in zip(*(batch.column(k).to_pylist() for k in range(3))):
                pairs, holders = unpress(pairs), unpress(holders)
                bucket = _bucket_of(pairs, buckets)
                order = np.argsort(bucket, kind="stable")
                cut = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order)).tolist()
                for a, b in zip(cut, cut[1:]):
                    some = order[a:b]
                    row = [pa.array([int(bucket[some[0]])]), pa.array([chunk]), pa.array([press(pairs[some])], pa.binary()), pa.array([press(holders[some])], pa.binary())]
                    yield pa.RecordBatch.from_arrays(row, ["bucket", "chunk", "pairs", "holders"])

    return chunks.select("chunk", "pairs", "holders").mapInArrow(deal, "bucket long, chunk long, pairs binary, holders binary")


def _count_rows(rows: DataFrame, size_b: int, buckets: int) -> DataFrame:
    """(chunk, bucket, counts, best_a, best): each pair's documents in the whole corpus, back to every
    chunk that holds it; one row per bucket (without a chunk) has the largest count of each A id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for bucket, *row in zip(batch.column(0).to_pylist(), *(batch.column(k).to_pylist() for k in (1, 2, 3))):
                if bucket != last and held:
                    yield from solve(last, held)
                    held = []
                last = bucket
                held.append(row)
        if held:
            yield from solve(last, held)

    def solve(bucket: int, held: list) -> Iterator[pa.RecordBatch]:
        pairs = [unpress(row[1]) for row in held]
        value, code = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(value), np.int64)
        np.add.at(total, code, np.concatenate([unpress(row[2]) for row in held]))
        at = 0
        for (chunk, _, _), own in zip(held, pairs):
            yield row_of(chunk, bucket, press(total[code[at : at + len(own)]]), None, None)
            at += len(own)
        id_a = value // size_b
        first = np.flatnonzero(np.diff(id_a, prepend=-1))
        yield row_of(None, bucket, None, id_a[first], np.maximum.reduceat(total, first))

    def row_of(chunk, bucket, counts, best_a, best) -> pa.RecordBatch:
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (best_a, best)]
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bucket]), pa.array([counts], pa.binary()), *lists], names)

    names = ["chunk", "bucket", "counts", "best_a", "best"]
    dealt = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket", "chunk")
    return dealt.mapInArrow(W.tidy(count), "chunk long, bucket long, counts binary, best_a array<long>, best array<long>")


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per input row.

    A is a byte-level BPE file and encodes a space and the text, B a SentencePiece model that puts
    the space itself. Groups end where tokens of both sides end; links are the pairs of tokens whose
    byte ranges overlap; a pair of ids counts the rows that hold it linked. ``n_best`` counts links
    whose pair has the largest count of all pairs with its A id, ``count_sum`` adds the counts of all links.

    Null and empty texts, and texts whose bytes either side does not give back, have no tokens: all
    numbers are 0 and the hash is ''. Whole texts are read, however long; null and repeated ids stay,
    and repeated rows count again; ties for the largest count all count as best; other columns are
    ignored; an empty table gives an empty table. Words are told apart by 64-bit hashes in a chunk.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # Written once: chunks are read again below, and must be the same then.
    chunks = settle(_chunk_rows(rows, path_a, path_b), "aligned")
    side_a, side_b = sides(path_a, path_b)
    size_a, size_b = len(side_a.pieces.length), len(side_b.pieces.length)
    total = chunks.agg(F.sum("n_pairs")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_PAIRS))
    counted = settle(_count_rows(_pair_rows(chunks, buckets), size_b, buckets), "pair-counts")
    tops = counted.filter("chunk is null").select(F.explode(F.arrays_zip("best_a", "best")).alias("t"))
    # At most one row per entry of A's vocabulary.
    tops = tops.groupBy(F.col("t.best_a").alias("a")).agg(F.max("t.best").alias("best")).toPandas()
    best = np.zeros(size_a, np.int64)
    best[tops["a"].to_numpy(np.int64)] = tops["best"].to_numpy(np.int64)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = {c: left.column(c)[0].as_py() for c in left.column_names}
        pairs = unpress(row["pairs"])
        order = np.argsort(_bucket_of(pairs, buckets), kind="stable")
        parts = [unpress(x.as_py()) for x in right.column("counts").take(pa.array(np.argsort(right.column("bucket").to_numpy())))] if right.num_rows else []
        count = np.zeros(len(pairs), np.int64)
        count[order] = np.concatenate([np.zeros(0, np.int64), *parts])
        is_best = count == best[pairs // size_b]
        code, uses = np.cumsum(unpress(row["codes"])), unpress(row["uses"])
        docs = {c: unpress(row[c]) for c in DOC_COLUMNS}
        bounds = np.concatenate([[0], np.cumsum(docs.pop("entries"))])
        sums = [np.diff(np.concatenate([[0], np.cumsum(v)])[bounds]) for v in (uses * is_best[code], uses * count[code])]
        with pa.ipc.open_stream(row["ids"]) as stream:
            ids = stream.read_all().column("id").combine_chunks()
        numbers = [docs["n_a"], docs["n_b"], docs["n_groups"], docs["n_links"], *sums]
        return pa.Table.from_arrays([ids, *(pa.array(x) for x in numbers), pa.array(row["sha"], pa.string())], names=names)

    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kinds = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names)
    answers = counted.filter("chunk is not null").select("chunk", "bucket", "counts")
    left = chunks.drop("holders", "n_pairs")
    return left.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, kinds)
