"""Repeated passages by super-k-mer partitioning.

The minimiser of a window is the least hash among its runs of ``MINIMISER`` words.
Consecutive windows with the same minimiser travel together as one packed string of words to the
bucket of that minimiser; equal windows always meet there, and sorting the bucket's windows
counts them. A minimiser with very many strings is hot: its windows travel one by one, dealt by
their own hash, so that no bucket holds more than equal windows of it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.llm import words as W

# Words of a minimiser.
MINIMISER = 5
BASE_M, BASE_W = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
# Strings of one minimiser from which it is hot, and how many minimisers can be (the most
# frequent ones; what is left has at most a millionth of all strings per minimiser).
HOT, MAX_HOT = 5_000, 1_000_000
LOCAL_HOT = 4
# Words parted by anything but one space: then equal words need not be equal bytes.
_ODD_SPACE = re.compile(rb"[\t-\r]|  ")
# Text bytes packed together before they are dealt to buckets.
PACK_BYTES = 16 << 20
# Words of strings aimed at per bucket.
BUCKET_WORDS = 1_000_000


def super_kmers(block: W.Words, hashed: np.ndarray, size: int, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, windows, route) of all super-k-mers of a block of texts."""
    at = W.inside(block.bounds, size)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    least = W.windows(hashed, MINIMISER, BASE_M)
    span, width = size - MINIMISER + 1, 1
    while width * 2 <= span:  # minimum of `span` neighbours by doubling
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :]) if span > width else least
    least = least[at]
    cut = np.ones(len(at), bool)
    cut[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    route = least
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, least), len(hot) - 1)] == least
        if is_hot.any():
            route = np.where(is_hot, W.windows(hashed, size, BASE_W)[at], least)
            cut |= is_hot
    first = np.flatnonzero(cut)
    return at[first], np.diff(np.append(first, len(at))), route[first]


def _hot_minimisers(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Minimisers with many strings, and the number of words of all strings."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, total = [np.zeros(0, np.uint64)], 0
            for _, _, block in W.blocks(batch.column(0)):
                first, number, route = super_kmers(block, block.hashes(), size, np.zeros(0, np.uint64))
                found.append(route)
                total += int(number.sum()) + len(first) * (size - 1)
            value, times = np.unique(np.concatenate(found), return_counts=True)
            many = times >= LOCAL_HOT
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *value[many].view(np.int64).tolist()], pa.int64()), pa.array([total, *times[many].tolist()], pa.int64())], ["h", "c"]
            )

    counts = docs.select("text").mapInArrow(W.tidy(count), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    rows = counts.filter(F.col("h").isNull() | (F.col("c") >= HOT)).orderBy(F.col("h").isNull().desc(), F.desc("c"), "h").limit(MAX_HOT + 1).collect()
    total = sum(r["c"] for r in rows if r["h"] is None)
    return np.sort(np.array([r["h"] for r in rows if r["h"] is not None], np.int64).view(np.uint64)), total


def _packed(docs: DataFrame, size: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, data): compressed strings for one bucket from one stretch of the input."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, held, weight = zstandard.ZstdCompressor(level=3), [], 0
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b, block in W.blocks(batch.column(2)):
                hashed = block.hashes()
                first, number, route = super_kmers(block, hashed, size, hot)
                if not len(first):
                    continue
                doc = np.searchsorted(block.bounds, first, "right") - 1
                bucket = (route % np.uint64(buckets)).astype(np.int64)
                place = first - block.bounds[doc]
                begin, stop = block.starts[first], block.ends[first + number + size - 2]
                held.append((bucket, route, ids[a:b][doc], tags[a:b][doc], place, number, block.data, begin, stop))
                weight += len(block.data)
                if weight >= PACK_BYTES:
                    yield from _deal(held, press)
                    held, weight = [], 0
        if held:
            yield from _deal(held, press)

    return docs.select("row", "tag", "text").mapInArrow(W.tidy(emit), "bucket long, data binary")


def _deal(held: list[tuple], press: zstandard.ZstdCompressor) -> Iterator[pa.RecordBatch]:
    """One row per bucket: its strings and their places, with rows and places as differences."""
    bucket, route, row, tag, place, number = (np.concatenate([h[k] for h in held]) for k in range(6))
    part = np.repeat(np.arange(len(held)), [len(h[0]) for h in held])
    begin, stop = np.concatenate([h[7] for h in held]), np.concatenate([h[8] for h in held])
    whole = [memoryview(h[6]) for h in held]
    order = np.argsort(bucket, kind="stable")
    cut = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    keys, datas, size = [], [], 0
    for a, b in zip(cut, cut[1:]):
        mine = order[a:b]
        texts = [bytes(whole[p][x:y]) for p, x, y in zip(part[mine].tolist(), begin[mine].tolist(), stop[mine].tolist())]
        # Equal strings of one stretch travel once.
        code: dict[bytes, int] = {}
        index = np.array([code.setdefault(t, len(code)) for t in texts], np.int32)
        strings = list(code)
        lengths = np.array([len(t) for t in strings], np.int32)
        head = np.array([len(strings), len(mine)], np.int64)
        count = np.empty(len(strings), np.int32)
        count[index] = number[mine]
        data = b"".join(
            [head.tobytes(), lengths.tobytes(), count.tobytes(), index.tobytes(), np.diff(row[mine].astype(np.int64), prepend=np.int64(0)).tobytes(), tag[mine].astype(np.int32).tobytes(), np.diff(place[mine].astype(np.int32), prepend=np.int32(0)).tobytes(), *strings]
        )
        keys.append(int(bucket[mine[0]]))
        datas.append(press.compress(data))
        size += len(datas[-1])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(datas, pa.binary())], ["bucket", "data"])
            keys, datas, size = [], [], 0
    if keys:
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(datas, pa.binary())], ["bucket", "data"])


def _open(data: bytes, press: zstandard.ZstdDecompressor) -> tuple:
    data = press.decompress(data)
    strings, uses = np.frombuffer(data, np.int64, 2).tolist()
    at = 16
    fields = []
    for kind, count in ((np.int32, strings), (np.int32, strings), (np.int32, uses), (np.int64, uses), (np.int32, uses), (np.int32, uses)):
        fields.append(np.frombuffer(data, kind, count, at))
        at += count * np.dtype(kind).itemsize
    lengths, number, index, row, tag, place = fields
    ends = (np.cumsum(lengths) + at).tolist()
    return [data[e - n : e] for e, n in zip(ends, lengths.tolist())], number, index, np.cumsum(row), tag, np.cumsum(place, dtype=np.int32)


def repeated_windows(parts: list[tuple], size: int) -> tuple[np.ndarray, ...]:
    """(row, tag, first word, end word) of every run of repeated windows of one bucket."""
    code: dict[bytes, int] = {}
    number, index, row, tag, place = [], [], [], [], []
    for strings, count, use, rows, tags, places in parts:
        slot = np.array([code.setdefault(s, len(code)) for s in strings], np.int64)
        number.append((slot, count))
        index.append(slot[use])
        row.append(rows)
        tag.append(tags)
        place.append(places)
    index, row, tag, place = (np.concatenate(x) for x in (index, row, tag, place))
    windows = np.zeros(len(code), np.int64)
    for slot, count in number:
        windows[slot] = count
    strings = list(code)
    del code
    uses = np.bincount(index, minlength=len(strings))
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
    block = W.split(np.frombuffer(b"".join(strings), np.uint8), offsets)
    first = np.concatenate([[0], np.cumsum(windows)])
    # All windows of the bucket: their string, their first word.
    owner = np.repeat(np.arange(len(strings)), windows)
    word = block.bounds[owner] + np.arange(len(owner)) - first[owner]
    hashed = W.windows(block.hashes(), size, BASE_W)[word] if len(word) else np.zeros(0, np.uint64)
    order = np.argsort(hashed, kind="stable")
    same = np.zeros(len(order), bool)
    same[1:] = hashed[order[1:]] == hashed[order[:-1]]
    repeated = uses[owner] > 1
    heads = np.flatnonzero(~same)
    if len(heads):
        tails = np.append(heads[1:], len(order))
        open_ = np.logical_or.reduceat(~repeated[order], heads) & (tails - heads > 1)
        for a, b in zip(heads[open_].tolist(), tails[open_].tolist()):
            _mark_equal(block, word[order[a:b]], order[a:b], size, repeated)
    # Runs of repeated windows within a string, then for each of its uses.
    edge = np.diff(np.concatenate([[0], repeated.view(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = np.unique(np.concatenate([starts, first[:-1][(windows > 0)]]))
    cuts = cuts[(cuts < len(repeated))]
    cuts = cuts[repeated[cuts]] if len(cuts) else cuts
    ends = np.minimum(stops[np.searchsorted(stops, cuts, "right")], first[owner[cuts] + 1]) if len(cuts) else cuts
    run_owner, run_from, run_to = owner[cuts], cuts - first[owner[cuts]], ends - first[owner[cuts]]
    by_string = np.argsort(index, kind="stable")
    use_first = np.concatenate([[0], np.cumsum(uses)])
    times = uses[run_owner]
    run = np.repeat(np.arange(len(cuts)), times)
    offset = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    use = by_string[use_first[run_owner[run]] + offset]
    return row[use], tag[use], place[use] + run_from[run], place[use] + run_to[run] + size - 1


def _mark_equal(block: W.Words, words: np.ndarray, at: np.ndarray, size: int, repeated: np.ndarray) -> None:
    """Mark windows with equal hashes that are truly equal, word for word."""
    seen: dict[tuple, int] = {}
    data = block.data
    for w, i in zip(words.tolist(), at.tolist()):
        a, b = block.starts[w], block.ends[w + size - 1]
        text = data[a:b].tobytes()
        if _ODD_SPACE.search(text):
            text = b" ".join(text.split())
        if text in seen:
            repeated[i] = True
            repeated[seen[text]] = True
        else:
            seen[text] = i


def repeats(docs: DataFrame, size: int) -> DataFrame:
    """(row, tag, spans): word spans [from, to) covered by windows that start more than once."""
    hot, total = _hot_minimisers(docs, size)
    buckets = max(1, -(-total // BUCKET_WORDS))
    packed = _packed(docs, size, hot, buckets)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, parts, last = zstandard.ZstdDecompressor(), [], None
        for batch in batches:
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if bucket != last and parts:
                    yield from _span_rows(parts, size)
                    parts = []
                    W.give_back()
                last = bucket
                parts.append(_open(data.as_py(), press))
        if parts:
            yield from _span_rows(parts, size)

    # One partition takes many buckets one after another, in order.
    spans = (
        packed.repartition(max(1, min(buckets, 20_000)), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(W.tidy(find), "row long, tag int, from int, to int")
    )
    return spans.groupBy("row", "tag").agg(F.collect_list(F.struct("from", "to")).alias("spans"))


def _span_rows(parts: list[tuple], size: int) -> Iterator[pa.RecordBatch]:
    row, tag, begin, end = repeated_windows(parts, size)
    for k in range(0, len(row), 50_000):
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[k : k + 50_000].astype(t)) for x, t in ((row, np.int64), (tag, np.int32), (begin, np.int32), (end, np.int32))], ["row", "tag", "from", "to"]
        )


def remove_repeats(
    docs: DataFrame, size: int = 50, digests: bool = False, as_is: bool = False, carry: tuple[str, ...] = (),
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Cut every word that a repeated window of ``size`` words covers.

    Gives (id, n_words, n_removed, kept) with the kept words joined by one space, or
    ``kept_sha256`` with ``digests``; with ``as_is`` a text that loses nothing stays as it was. The
    columns named in ``carry`` come first, unchanged. Windows are judged on the input: where
    the same words start anywhere else, in the same text or another one, both places go. Words are
    runs of characters other than ASCII white space. Null and empty texts have no words and give an
    empty text; null and repeated ids and repeated rows are rows like any others (a repeated row repeats
    all its windows). Other columns are ignored. An empty table gives an empty table.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.struct(*carry, F.lit(0).alias("_")).alias("rest")
    )
    # A row is known by its id and a tag of its text, which tells repeated ids apart. Rows equal
    # in both share their spans, as they should.
    rows = rows.withColumns({
        "row": F.coalesce("id", F.xxhash64("text")),
        "tag": F.xxhash64("text", F.col("id").isNull()).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"),
    })
    spans = repeats(rows, size)
    name = "kept_sha256" if digests else "kept"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in W.blocks(batch.column(1)):
                n = np.diff(block.bounds)
                gone = np.zeros(len(block) + 1, np.int32)
                lists = batch.column(2).slice(a, b - a)
                flat = lists.flatten()
                if len(flat):
                    base = np.repeat(block.bounds[:-1], np.diff(lists.offsets.to_numpy()))
                    np.add.at(gone, flat.field(0).to_numpy() + base, 1)
                    np.add.at(gone, flat.field(1).to_numpy() + base, -1)
                gone = np.cumsum(gone[:-1]) > 0
                whole = block.data.tobytes()
                starts, ends = block.starts.tolist(), block.ends.tolist()
                kept = np.flatnonzero(~gone).tolist()
                bounds = np.concatenate([[0], np.cumsum(~gone)])[block.bounds]
                lost = n - np.diff(bounds)
                texts = []
                for i, (x, y) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    if as_is and not lost[i]:
                        texts.append(whole[block.offsets[i] : block.offsets[i + 1]])
                    else:
                        texts.append(b" ".join([whole[starts[k] : ends[k]] for k in kept[x:y]]))
                out = [hashlib.sha256(t).hexdigest() for t in texts] if digests else [t.decode() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(n.astype(np.int64)),
                        pa.array(lost.astype(np.int64)),
                        pa.array(out, pa.string()),
                        batch.column(3).slice(a, b - a),
                    ],
                    ["id", "n_words", "n_removed", name, "rest"],
                )

    joined = rows.join(spans, ["row", "tag"], "left").select("id", "text", "spans", "rest")
    schema = StructType().add("id", "long").add("n_words", "long").add("n_removed", "long").add(name, "string").add(joined.schema["rest"])
    found = joined.mapInArrow(W.tidy(cut), schema)
    return found.select(*(F.col("rest")[c].alias(c) for c in carry), "id", "n_words", "n_removed", name)
