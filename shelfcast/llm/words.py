"""Words of whole texts as numpy arrays, straight from Arrow buffers.

Texts stay UTF-8 bytes. A batch is cut into blocks of bounded size (a longer single text
is a block of its own), and every step is a pass over the block's arrays.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes worked on at once.
BLOCK_BYTES = 1 << 20
# ASCII white space: the characters that end a word, \x09-\x0D and \x20.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# Multipliers of the 64-bit mixing step (fixed values).
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(int(_rng.integers(1, 2**62)) * 2 + 1)
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32
_powers = np.ones(1, np.uint64)


def powers(count: int, base: np.uint64 = _STEP) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; kept between calls for the usual base."""
    global _powers
    if base != _STEP:
        return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(count - 1, base, np.uint64)]))
    if len(_powers) < count:
        wanted = max(count, 4096)
        _powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(wanted - 1, base, np.uint64)]))
    return _powers[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> np.uint64(30))) * MIX_A
    values = (values ^ (values >> np.uint64(27))) * MIX_B
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``data`` and, per text, its range of words."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of every word's bytes, with A-Z lower-cased if asked."""
        return span_hashes(self.data, self.starts, self.ends, lower)

    def texts(self, which: np.ndarray, lower: bool = False) -> list[bytes]:
        whole = self.data.tobytes()
        found = [whole[a:b] for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist())]
        return [w.lower() for w in found] if lower else found


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of byte ranges, worked out over about ``BLOCK_BYTES`` at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    table = _BYTE[LOWER_BYTES] if lower else _BYTE
    lengths = ends - starts
    done = np.cumsum(lengths)
    cut = np.unique(np.searchsorted(done, np.arange(0, int(done[-1]), BLOCK_BYTES)))
    out = np.empty(len(starts), np.uint64)
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(starts)]):
        n = lengths[a:b]
        first = np.cumsum(n) - n
        rank = np.arange(int(n.sum())) - np.repeat(first, n)
        values = table[data[rank + np.repeat(starts[a:b], n)]] * powers(int(n.max()))[rank]
        out[a:b] = mix(np.add.reduceat(values, first) + n.astype(np.uint64))
    return out


def plain(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray = SPACE) -> Words:
    """Words: longest runs of bytes that ``stops`` does not mark (ASCII white space)."""
    solid = ~stops[data]
    begin, stop = solid.copy(), solid.copy()
    if len(data):
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        full = offsets[1:] > offsets[:-1]
        head, tail = offsets[:-1][full], offsets[1:][full] - 1
        begin[head], stop[tail] = solid[head], solid[tail]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def ranges(offsets: np.ndarray, limit: int = BLOCK_BYTES, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges with at most ``limit`` bytes and ``most`` rows each (one row at least)."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(rows, row + (most or rows), max(row + 1, stop))
        yield row, stop
        row = stop


def blocks(
    column: pa.Array, limit: int = BLOCK_BYTES, stops: np.ndarray = SPACE, most: int | None = None
) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of a text column, in blocks."""
    data, offsets = plain(column)
    for a, b in ranges(offsets, limit, most):
        yield a, b, split(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], stops)


def windows(values: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of ``size`` consecutive values at every start, by doubling; shorter tails are left out."""
    count = len(values) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    part, width, done = values, 1, 0
    while True:
        if size & width:
            scale = np.uint64(pow(int(base), done, 1 << 64))
            out += part[done : done + count] * scale
            done += width
        if width * 2 > size:
            return mix(out)
        part = part[: len(part) - width] + part[width:] * np.uint64(pow(int(base), width, 1 << 64))
        width *= 2


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of every word."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def inside(bounds: np.ndarray, size: int) -> np.ndarray:
    """Word positions at which a window of ``size`` words lies within its text."""
    room = np.maximum(np.diff(bounds) - size + 1, 0)
    first = np.concatenate([[0], np.cumsum(room)[:-1]])
    return np.arange(int(room.sum())) + np.repeat(bounds[:-1] - first, room)


def give_back() -> None:
    """Return the memory this Python worker has freed to the system, so that tasks and stages of a
    long job do not add up. Does nothing where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The step for ``mapInArrow`` with ``give_back`` at the end of every task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run
