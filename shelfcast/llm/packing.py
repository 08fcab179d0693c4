"""Packing by power-of-two decomposition.

A document's ids are cut into full sequences and then into pieces whose lengths are the
binary digits of the rest, longest first. Pieces of equal length form a bucket, and each piece
is a sequence of its own: no sequence holds two documents and nothing is padded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import tokens
from shelfcast.llm import words as W

END_ID = 0


def binary_pieces(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of every piece; ``limit`` is a power of two."""
    full, rest = lengths // limit, lengths % limit
    bits = 1 << np.arange(limit.bit_length() - 2, -1, -1)
    digits = (rest[:, None] & bits) > 0
    count = full + digits.sum(axis=1)
    doc = np.repeat(np.arange(len(lengths)), count)
    size = np.full(len(doc), limit, np.int64)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    row, col = np.nonzero(digits)
    place = first[row] + full[row] + (np.cumsum(digits, axis=1)[row, col] - 1)
    size[place] = bits[col]
    run = np.cumsum(size) - size
    return doc, run - np.repeat(run[first] if len(first) else first, count), size


def pack(
    docs: DataFrame, path: str, limit: int = 1024, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces (id, start, length, doc_tokens, sequence_id, offset, ids), one per sequence.

    ``length`` is also the bucket. A null or empty text is one piece holding only the end id;
    null and repeated ids are kept as they are, one set of pieces per input row. Other columns
    are ignored. An empty table gives an empty table. ``sequence_id`` is unique within the
    result; written results keep it.
    """
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.cache(path)
        for batch in batches:
            data, offsets = W.plain(batch.column(1))
            for a, b in W.ranges(offsets):
                block = tokens.split(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], path)
                ids, bounds = known.ids(block)
                lengths = np.diff(bounds) + 1
                # The end id goes behind every document.
                ids = np.insert(ids, bounds[1:], np.uint32(end_id))
                doc, start, size = binary_pieces(lengths, limit)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(doc)),
                        pa.array(start),
                        pa.array(size),
                        pa.array(lengths[doc]),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(ids.view(np.int32))
                        ),
                    ],
                    ["id", "start", "length", "doc_tokens", "ids"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(W.tidy(cut), "id long, start long, length long, doc_tokens long, ids array<int>").select(
        "id", "start", "length", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"
    )
