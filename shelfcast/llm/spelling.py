"""Spelling variants: words one edit apart, each tied to its most frequent near word.

Letter counts are points; one edit moves a point by a squared distance of at most two, between
blocks of equal or adjacent length. NumPy products of count blocks (Gram matrices) give all squared
distances of a block pair, and pairs at most two apart are checked letter by letter.

Which words share a block is decided exactly: one edit lies in one part of a word and leaves the
rest as it is. Words are dealt by "all but one half"; blocks that come out large are dealt again by
all but one quarter, eighth and so on, so no block is ever large and no pair is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.llm import words as W
from shelfcast.settings import settle, settle_counted

# Bytes of text whose words are counted at once before they are sent on.
COUNT_BYTES = 8 << 20
# Members from which a block is dealt again in smaller parts, and rows of one matrix product.
LARGE, TILE = 4096, 512
# Runs of more bytes than this take the plain checksum, one by one.
LONG = 64
# Doubling steps of the way to a root; each form is at least twice as frequent, so 64 are never needed.
ROOT_ROUNDS = 8

# Letters: A-Z, a-z, and the two bytes of U+00C0 to U+00FF.
_ASCII = np.zeros(256, bool)
_ASCII[65:91] = _ASCII[97:123] = True
# Column of a letter's count: a-z, then U+00C0 to U+00FF.
LETTERS = 26 + 64


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> W.Words:
    """Longest runs of A-Z, a-z and U+00C0 to U+00FF in every text."""
    first = np.zeros(len(data), bool)
    if len(data) > 1:
        first[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0xBF)
    solid = _ASCII[data] | first
    solid[1:] |= first[:-1]
    # ``split`` looks bytes up in a table of stops: give it 0 for letters and 1 for others.
    found = W.split((~solid).view(np.uint8), offsets, np.arange(256) == 1)
    return W.Words(data, offsets, found.starts, found.ends, found.bounds)


def run_checksums(block: W.Words, which: np.ndarray, prefixes: np.ndarray) -> np.ndarray:
    """CRC-32 of some words' bytes, A-Z lower-cased, each after a prefix with the given CRC-32."""
    starts, length = block.starts[which], (block.ends - block.starts)[which]
    order = np.argsort(-length, kind="stable")
    crc = (prefixes[order] ^ np.uint32(0xFFFFFFFF)).astype(np.uint32)
    start, length = starts[order], length[order]
    short = int(np.searchsorted(-length, -LONG, "left"))  # before it: longer runs
    for k in range(short):
        whole = W.LOWER_BYTES[block.data[start[k] : start[k] + length[k]]].tobytes()
        crc[k] = zlib.crc32(whole, int(crc[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for at in range(int(length[short]) if short < len(length) else 0):
        stop = int(np.searchsorted(-length, -at, "left"))
        part = slice(short, stop)
        byte = W.LOWER_BYTES[block.data[start[part] + at]]
        crc[part] = _CRC[(crc[part] ^ byte) & np.uint32(255)] ^ (crc[part] >> np.uint32(8))
    out = np.empty(len(which), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def word_counts(
    docs: DataFrame, least_letters: int = 5, least_uses: int = 3, noise: int = 97, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, n): lower-cased letter runs of at least ``least_letters``, used ``least_uses`` times or more.

    A run whose checksum (CRC-32 of ``<id>:<run>``) is divisible by ``noise`` loses one letter, so
    that every corpus holds known misspellings; 0 turns that off. A null id is written as nothing.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t"))
    return _counted(rows, least_letters, noise).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_uses)


def _counted(rows: DataFrame, least_letters: int, noise: int) -> DataFrame:
    """(word, n) per block of text; equal words of a block are one row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = W.plain(batch.column(1))
            for a, b in W.ranges(offsets, COUNT_BYTES):
                block = letter_runs(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield from count_block(block, ids[a:b])

    def count_block(block: W.Words, ids: list[str]) -> Iterator[pa.RecordBatch]:
        two = np.concatenate([[0], np.cumsum(block.data == 0xC3)])
        letters = (block.ends - block.starts) - (two[block.ends] - two[block.starts])
        keep = np.flatnonzero(letters >= least_letters)
        if not len(keep):
            return
        gone = np.zeros(0, np.int64)
        changed: dict[bytes, int] = {}
        if noise:
            prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
            crc = run_checksums(block, keep, prefix[W.owners(block.bounds)[keep]])
            gone = np.flatnonzero(crc % np.uint32(noise) == 0)
            for k, h, word in zip(gone.tolist(), crc[gone].tolist(), block.texts(keep[gone], True)):
                text = word.decode()
                if len(text) > least_letters:
                    at = h % len(text)
                    word = (text[:at] + text[at + 1 :]).encode()
                    changed[word] = changed.get(word, 0) + 1
        whole = np.delete(keep, gone)
        chosen = W.Words(block.data, block.offsets, block.starts[whole], block.ends[whole], block.bounds)
        _, first, n = np.unique(chosen.hashes(True), return_index=True, return_counts=True)
        found = chosen.texts(first, True) + list(changed)
        uses = np.concatenate([n, np.fromiter(changed.values(), np.int64, len(changed))])
        for k in range(0, len(found), 20_000):
            words = pa.array(found[k : k + 20_000], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([words, pa.array(uses[k : k + 20_000].astype(np.int64))], ["word", "n"])

    return rows.mapInArrow(W.tidy(count), "word string, n long")


def _dealt(members: DataFrame, parts: int) -> DataFrame:
    """Members of every block when words are cut into ``parts``: all but one part stays.

    ``members`` (word, n, len, part, of): a word of ``len`` letters in the role of the shorter word
    of a pair, or of the longer one if it has one letter more, for part ``part`` of ``of``.
    """
    finer = members.withColumn("part", F.explode(F.sequence(F.expr(f"part * {parts} div of"), F.expr(f"(part + 1) * {parts} div of - 1"))))
    begin, end = F.expr(f"part * len div {parts}"), F.expr(f"(part + 1) * len div {parts}")
    finer = finer.select("word", "n", "len", "part", F.lit(parts).alias("of"), begin.alias("begin"), end.alias("end"))
    more = F.length("word") - F.col("len")
    head, tail = F.expr("substr(word, 1, begin)"), F.substr("word", F.col("end") + more + 1)
    key = F.xxhash64("len", "part", "of", head, F.lit("\n"), tail)
    return finer.filter("end > begin").withColumn("key", key)


def _blocks(words: DataFrame) -> list[DataFrame]:
    """Tables (word, n, len, begin, end, key) of blocks: each pair one edit apart meets in one."""
    letters = F.length("word")
    members = words.select(
        "word", "n", F.explode(F.array(letters, letters - 1)).alias("len"), F.lit(0).alias("part"), F.lit(1).alias("of")
    )
    out, parts = [], 2
    while True:
        dealt = _dealt(members, parts)
        crowded = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max(F.col("end") - F.col("begin")).alias("room"))
        large, count = settle_counted(crowded.filter((F.col("size") > LARGE) & (F.col("room") > 1)).select("key"), "large")
        small = dealt.join(large, "key", "left_anti") if count else dealt
        out.append(small.select("word", "n", "len", "begin", "end", "key"))
        if not count:
            return out
        members = settle(dealt.join(large, "key", "left_semi").select("word", "n", "len", "part", "of"), "members")
        parts *= 2


def letter_counts(words: list[str], dtype: type) -> np.ndarray:
    """One row of letter counts per word."""
    flat = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).astype(np.int64)
    column = np.where(flat < 0x80, flat - 97, flat - 0xC0 + 26)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * LETTERS + column, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(dtype)


def edit_place(short: str, long: str) -> int:
    """Where the two words, of equal length or ``long`` one letter longer, differ by one edit; -1 if not."""
    at, more = 0, len(long) - len(short)
    for x, y in zip(short, long):
        if x != y:
            break
        at += 1
    if at == len(short):
        return at - 1 if more else -1
    return at if short[at + 1 - more :] == long[at + 1 :] else -1


class _Rows:
    """Sorted members of consecutive blocks as arrays."""

    def __init__(self, table: pa.Table):
        self.word = table.column("word").to_pylist()
        self.n, self.key, self.begin, self.end = (table.column(c).to_numpy() for c in ("n", "key", "begin", "end"))
        self.size = np.array([len(w) for w in self.word])
        self.long = self.size > table.column("len").to_numpy()

    def near(self, a: slice, b: slice) -> Iterator[tuple[int, int]]:
        """Pairs (shorter, longer) one edit apart between two tiles (or inside one), once each."""
        dtype = np.float32 if max(self.size[a].max(), self.size[b].max()) < 2000 else np.float64
        x = letter_counts(self.word[a], dtype)
        y = x if a == b else letter_counts(self.word[b], dtype)
        square = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
        i, j = np.nonzero(square <= 2)
        i, j = i + a.start, j + b.start
        # Of two words of equal length the earlier row is the first; a longer word is the second.
        fits = (self.key[i] == self.key[j]) & ~self.long[i] & (self.long[j] | (i < j))
        if a != b:
            back = (self.key[i] == self.key[j]) & ~self.long[j] & self.long[i]
            i, j = np.concatenate([i[fits], j[back]]), np.concatenate([j[fits], i[back]])
        else:
            i, j = i[fits], j[fits]
        for p, q in zip(i.tolist(), j.tolist()):
            place = edit_place(self.word[p], self.word[q])
            if self.begin[p] <= place < self.end[p]:
                yield p, q

    def pairs(self) -> Iterator[tuple[int, int]]:
        """All near pairs; small blocks share a tile, a block of several tiles meets in every two of them."""
        begin = end = 0
        for stop in [*_cuts(self.key)[1:].tolist(), None]:
            if end > begin and (stop is None or stop - begin > TILE):
                spans = [slice(k, min(k + TILE, end)) for k in range(begin, end, TILE)]
                for k, a in enumerate(spans):
                    for b in spans[k:]:
                        yield from self.near(a, b)
                begin = end
            end = stop


def _cuts(key: np.ndarray) -> np.ndarray:
    """Where blocks of equal keys begin, and the end."""
    return np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)


def _near_rows(blocks: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair one edit apart, in both directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # Blocks end where the key changes; the last one of a batch may go on.
            key = batch.column(5).to_numpy()
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            if last:
                yield from solve([*held, batch.slice(0, last)])
                held = [batch.slice(last)]
            else:
                if held and held[-1].column(5)[0].as_py() != key[0]:
                    yield from solve(held)
                    held = []
                held.append(batch)
        if held:
            yield from solve(held)

    def solve(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        size = np.diff(_cuts(table.column("key").to_numpy()))
        table = table.filter(pa.array(np.repeat(size > 1, size)))
        rows = _Rows(table)
        pairs = np.array(list(rows.pairs()), np.int64).reshape(-1, 2)
        word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
        for k in range(0, len(pairs), 20_000):
            p = pairs[k : k + 20_000]
            one, two = pa.array(np.concatenate([p[:, 0], p[:, 1]])), pa.array(np.concatenate([p[:, 1], p[:, 0]]))
            yield pa.RecordBatch.from_arrays([word.take(one), n.take(one), word.take(two), n.take(two)], ["word", "n", "near", "near_n"])

    dealt = blocks.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(W.tidy(run), "word string, n long, near string, near_n long")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for all pairs of distinct ``words`` (word, n) one edit apart."""
    tables = _blocks(words)
    found = _near_rows(tables[0])
    for more in tables[1:]:
        found = found.unionByName(_near_rows(more))
    return found


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of the way that follows forms, by doubling.

    Every form must be at least twice as frequent as its word, so ways end and are short.
    """
    way = settle(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROOT_ROUNDS):
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        seen = Observation()
        step = way.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        way = settle(step.observe(seen, F.count_if("moved").alias("moved")).select("word", "root"), "roots")
        if not seen.get.get("moved"):
            return way
    raise RuntimeError(f"ways to the roots did not end in {ROOT_ROUNDS} rounds")


def variants(
    docs: DataFrame,
    least_letters: int = 5,
    least_uses: int = 3,
    noise: int = 0,
    factor: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the corpus.

    ``form`` is the near word of largest ``n`` (ties: the smallest in code-point order), if it is
    at least ``factor`` (2 or more) times as frequent as the word; ``root`` follows forms to the end.

    Null and empty texts have no words; whole texts count, however long, and repeated rows count
    again; other columns are ignored; an empty table gives an empty table. Words are told apart by
    64-bit hashes inside one block of text, and by themselves everywhere else.
    """
    words = settle(word_counts(docs, least_letters, least_uses, noise, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.m") >= factor * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n"),
    )
    found = settle(found, "forms")
    ends = roots(found.filter("form is not null").select("word", "form"))
    joined = found.join(ends, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
