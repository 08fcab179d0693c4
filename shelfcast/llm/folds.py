"""Folds by CRC-32 of the id's decimal text, and labels by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.settings import settle_counted

# Labelled ids that learning uses at most; they are broadcast. Of more, those with the least hashes stay.
MAX_LABELLED = 1_000_000


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether the id falls into the given fold; a null id never does."""
    crc = F.crc32(F.col(id_col).cast("long").cast("string").cast("binary"))
    return F.coalesce(crc % parts == part, F.lit(False))


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, id_col: str = "doc_id", most: int = MAX_LABELLED
) -> DataFrame:
    """(id, text, label 0/1) of the training fold. Null ids, labels and texts are left out.

    An id with several labels takes the largest. At most ``most`` labelled ids are used, chosen by a
    hash of id and label; they are broadcast, so the texts are filtered where they are read.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col, parts, part))
    known = known.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    known, count = settle_counted(known, "known")
    if count > most:
        known = known.orderBy(F.xxhash64("id", "label"), "id").limit(most)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("id is not null and text is not null").filter(~held_out("id", parts, part))
    return texts.join(F.broadcast(known), "id")
