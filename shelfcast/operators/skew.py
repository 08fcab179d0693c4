"""Group work that stays balanced when one key holds a large part of all rows.

* ``attach``     - group statistics back onto rows: aggregate first, then join.
* ``ordered``    - ordered row windows; a hot group is cut into consecutive
                   pieces, each given the rows just before it.
* ``running_sum``- prefix sums over the same pieces.
* ``quantiles``  - exact interpolated quantiles from value counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.settings import (
    HOT_ROWS,
    MAX_BROADCAST_ROWS,
    MAX_HOT_GROUPS,
    NARROW_ROWS,
    settle,
    settle_counted,
    tuning,
)

# Sampled cut points per piece, and cut points per block of the two-step lookup.
OVERSAMPLE = 16
BLOCK = 64


def lookup(table: DataFrame, name: str = "lookup") -> DataFrame:
    """Write a lookup table; mark it for broadcast only if its counted size allows."""
    written, rows = settle_counted(table, name)
    limit = tuning(table.sparkSession, MAX_BROADCAST_ROWS)
    return F.broadcast(written) if rows <= limit else written


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join per-key values onto rows.

    Small tables are broadcast, so the rows are not shuffled at all. Others are
    joined by shuffle with the rows on the left, where adaptive execution can
    split a skewed partition. NULL keys match nothing, as a group-by would skip them.
    """
    return df.join(lookup(stats), list(keys), "left")


def with_stats(
    df: DataFrame, keys: Sequence[str], source: DataFrame | None = None, **aggs: Column
) -> DataFrame:
    """Add per-group aggregates as columns (partial sums before the shuffle).

    ``source`` is where the aggregates are computed: an earlier, cheaper form of the
    same rows when ``df`` has been joined many times since.
    """
    stats = (source or df).groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach(df, stats, keys)


def packed(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``table`` with all columns but the keys as one struct column ``name``.

    Spark copies a row's columns one by one at every join, a struct in one piece.
    """
    return table.select(*keys, F.struct(*[c for c in table.columns if c not in keys]).alias(name))


def _threshold(df: DataFrame, total: int) -> int:
    return max(tuning(df.sparkSession, HOT_ROWS), total // MAX_HOT_GROUPS)


def _cut_points(
    df: DataFrame, keys: list[str], order: list[str], source: DataFrame | None = None
) -> DataFrame | None:
    """Positions at which hot groups are cut: one row per hot group, or None."""
    df = source or df
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, biggest = sizes.agg(F.sum("_n"), F.max("_n")).first()
    limit = _threshold(df, total or 0)
    if (biggest or 0) <= limit:
        return None
    hot = F.broadcast(settle(sizes.where(F.col("_n") > limit).select(*keys), "hot"))
    every = max(1, limit // OVERSAMPLE)
    sample = (
        df.join(hot, keys, "left_semi")
        .where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0)
        .select(*keys, F.struct(*order).alias("_cut"))
        .distinct()
    )
    by_place = Window.partitionBy(*keys).orderBy("_cut")
    kept = sample.withColumn("_i", F.row_number().over(by_place)).where(
        F.col("_i") % OVERSAMPLE == 0
    )
    cuts = kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))
    return settle(
        cuts.withColumn("_blocks", F.filter("_cuts", lambda _, i: i % BLOCK == 0)), "cuts"
    )


def _piece_number(order: list[str]) -> Column:
    """How many cut points lie at or before the row: block first, then inside the block."""
    place = F.struct(*order)
    block = F.size(F.filter("_blocks", lambda c: c <= place))
    start = (block - 1) * BLOCK
    inside = F.size(
        F.filter(F.slice("_cuts", start + 1, F.lit(BLOCK)), lambda c: c <= place)
    )
    return F.when(F.col("_cuts").isNull() | (block == 0), F.lit(0)).otherwise(start + inside)


def _pieces(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    size_known: int | None = None,
    source: DataFrame | None = None,
) -> DataFrame | None:
    """Rows with ``_piece`` and ``_hot``; None when every group is small enough."""
    if size_known is not None and size_known <= tuning(df.sparkSession, HOT_ROWS):
        return None
    cuts = _cut_points(df, keys, order, source)
    if cuts is None:
        return None
    marked = df.join(F.broadcast(cuts), keys, "left")
    return (
        marked.withColumn("_hot", F.col("_cuts").isNotNull())
        .withColumn("_piece", _piece_number(order))
        .drop("_cuts", "_blocks")
    )


def ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    apply: Callable[[DataFrame, Window], DataFrame],
    halo: int,
    carry: dict[str, str] | None = None,
    source: DataFrame | None = None,
    spread: bool = False,
) -> DataFrame:
    """Run ``apply(rows, window)`` for windows that look back at most ``halo`` rows.

    ``carry`` maps a new column to a source column: the last non-null source value
    of earlier pieces of the group, for look-back without a row limit. Group sizes
    are taken from ``source`` when given (same rows, cheaper to read). ``spread`` deals the rows
    by all keys where they already lie together by fewer, as after a window over larger groups.
    """
    keys, order, carry = list(keys), list(order), carry or {}
    parts = _pieces(df, keys, order, source=source)
    if parts is None:
        for name, source in carry.items():
            df = df.withColumn(name, F.lit(None).cast(df.schema[source].dataType))
        df = df.repartition(*keys) if spread else df
        return apply(df, Window.partitionBy(*keys).orderBy(*order)).drop(*carry)

    place = F.struct(*order)
    lasts = [F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(n) for n, c in carry.items()]
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    sizes = settle(
        parts.where("_hot").groupBy(*keys, "_piece").agg(F.count(F.lit(1)).alias("_n"), *lasts),
        "pieces",
    )
    sizes = sizes.withColumn("_end", F.sum("_n").over(by_piece))
    # The rows closing a piece are needed by every later piece that starts within ``halo`` rows.
    near = Window.partitionBy(*keys).orderBy("_end").rangeBetween(0, halo - 1)
    sizes = sizes.select(
        *keys,
        "_piece",
        F.count(F.lit(1)).over(near).alias("_reach"),
        *[F.last(n, ignorenulls=True).over(before).alias(n) for n in carry],
    )
    reach = sizes.select(*keys, "_piece", "_reach")
    closing = Window.partitionBy(*keys, "_piece").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        parts.where("_hot")
        .withColumn("_back", F.row_number().over(closing))
        .where(F.col("_back") <= halo)
        .join(F.broadcast(reach), [*keys, "_piece"])
        .withColumn(
            "_piece",
            F.explode(F.sequence(F.col("_piece") + 1, (F.col("_piece") + F.col("_reach")).cast("int"))),
        )
        .drop("_back", "_reach")
    )
    rows = parts.withColumn("_lead", F.lit(False)).unionByName(
        tails.withColumn("_lead", F.lit(True))
    )
    if carry:
        rows = rows.join(F.broadcast(sizes.drop("_reach")), [*keys, "_piece"], "left")
    window = Window.partitionBy(*keys, "_piece").orderBy(*order)
    return apply(rows, window).where(~F.col("_lead")).drop("_hot", "_piece", "_lead", *carry)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    size_known: int | None = None,
) -> DataFrame:
    """Inclusive prefix sum of ``value`` in ``order`` inside each group."""
    keys, order = list(keys), list(order)
    parts = _pieces(df, keys, order, size_known)
    up_to = (Window.unboundedPreceding, 0)
    if parts is None:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*up_to)
        return df.withColumn(out, F.sum(value).over(window))
    sums = settle(parts.where("_hot").groupBy(*keys, "_piece").agg(F.sum(value).alias("_s")))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_piece", F.sum("_s").over(before).alias("_base"))
    window = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(*up_to)
    return (
        parts.join(F.broadcast(offsets), [*keys, "_piece"], "left")
        .withColumn(out, F.sum(value).over(window) + F.coalesce("_base", F.lit(0)))
        .drop("_hot", "_piece", "_base")
    )


def quantiles(
    df: DataFrame, keys: Sequence[str], value: str | Column, probs: dict[str, float]
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group (one output column per entry).

    Small tables are counted per distinct value. Tables of more than ``NARROW_ROWS`` known values are
    read a few times instead: each pass counts the rows in ``BINS`` bins of every wanted rank's
    bracket and keeps the bin that holds the rank, until few rows are left between the brackets'
    ends. So what is shuffled follows groups and ranks, not distinct values. Pass a written table.
    """
    value = F.col(value) if isinstance(value, str) else value
    by = list(keys) or ["_all"]
    if not keys:
        df = df.withColumn("_all", F.lit(0))
    limit = tuning(df.sparkSession, NARROW_ROWS)
    known = df.select(*by, value.alias("_v")).where(F.col("_v").isNotNull())
    # Rows are counted only where Spark's estimate has a byte for each of so many.
    large = known._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > limit
    if large and known.agg(F.count(F.lit(1))).first()[0] > limit:
        result = _by_narrowing(known, by, probs, limit)
    else:
        result = quantiles_of_counts(*settle_counted(value_counts(df, by, value), "values"), by, probs)
    return result if keys else result.drop("_all")


# Bins of a bracket in one pass, and passes before the values left are counted, however many.
BINS, PASSES = 256, 8


def _by_narrowing(known: DataFrame, by: list[str], probs: dict[str, float], limit: int) -> DataFrame:
    """``quantiles`` of (by, ``_v``) by brackets around the wanted ranks."""
    spot = lambda q: (F.col("_n") - 1) * F.lit(float(q))
    ranks = F.array_distinct(F.array(*[f(spot(q)) for q in probs.values() for f in (F.floor, F.ceil)]))
    sizes = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    # A bracket: the rank, the least and largest value it can be, rows before it, rows inside.
    brackets = settle(
        sizes.withColumn("_rank", F.explode(ranks))
        .withColumns({"_below": F.lit(0).cast("long"), "_in": F.col("_n")}), "brackets",
    )
    is_open = F.col("_lo") < F.col("_hi")
    for _ in range(PASSES):
        left = brackets.where(is_open).select(*by, "_lo", "_hi", "_in").distinct().agg(F.sum("_in")).first()[0]
        if (left or 0) <= limit:
            break
        brackets = settle(_narrower(known, brackets, by), "brackets")
    inside = _in_brackets(known, brackets.where(is_open).select(*by, "_lo", "_hi", "_below").distinct(), by)
    spans = [*by, "_lo", "_hi", "_below"]
    counts, size = settle_counted(inside.groupBy(*spans, "_v").agg(F.count(F.lit(1)).alias("_c")), "values")
    upto = running_sum(counts, spans, ["_v"], "_c", "_upto", size).select(
        *spans, "_v", (F.col("_below") + F.col("_upto")).alias("_last"), "_c"
    )
    spread = _match(brackets.where(is_open), upto, spans)
    hit = (F.col("_rank") < F.col("_last")) & (F.col("_rank") >= F.col("_last") - F.col("_c"))
    found = spread.where(hit).select(*by, "_n", "_rank", "_v").unionByName(
        brackets.where(~is_open).select(*by, "_n", "_rank", F.col("_lo").alias("_v"))
    )

    def pick(q: float) -> Column:
        at = lambda rank: F.max(F.when(F.col("_rank") == rank, F.col("_v")))
        low, part = at(F.floor(spot(q))), F.max(spot(q) - F.floor(spot(q)))
        return low + (at(F.ceil(spot(q))) - low) * part

    return found.groupBy(*by).agg(*[pick(q).alias(name) for name, q in probs.items()])


def _match(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which NULL keys meet; the keys come from the left."""
    other = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(other, same).drop(*[f"_r_{k}" for k in keys])


def _in_brackets(known: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """The rows inside each bracket of their group; a few brackets per group, broadcast if counted small."""
    return _match(known, lookup(brackets, "open"), by).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))


def _narrower(known: DataFrame, brackets: DataFrame, by: list[str]) -> DataFrame:
    """Each open bracket cut down to the bin that holds its rank; its ends become values that are there."""
    is_open = F.col("_lo") < F.col("_hi")
    spans = [*by, "_lo", "_hi", "_below"]
    inside = _in_brackets(known, brackets.where(is_open).select(*spans).distinct(), by)
    lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
    # Halves first, so that the width of a bracket cannot overflow.
    share = (F.col("_v").cast("double") / 2 - lo / 2) / (hi / 2 - lo / 2)
    bin_ = F.least(F.lit(BINS - 1), F.floor(share * BINS).cast("int"))
    bins = inside.groupBy(*spans, bin_.alias("_bin")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_first"), F.max("_v").alias("_end")
    )
    in_order = Window.partitionBy(*spans).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = bins.withColumn("_last", F.col("_below") + F.sum("_c").over(in_order))
    hit = (F.col("_rank") < F.col("_last")) & (F.col("_rank") >= F.col("_last") - F.col("_c"))
    cut = _match(brackets.where(is_open), bins, spans).where(hit).select(
        *by, "_n", F.col("_first").alias("_lo"), F.col("_end").alias("_hi"), "_rank",
        (F.col("_last") - F.col("_c")).alias("_below"), F.col("_c").alias("_in"),
    )
    return cut.unionByName(brackets.where(~is_open))


def value_counts(df: DataFrame, keys: Sequence[str], value: str | Column) -> DataFrame:
    """(keys, ``_v``, ``_c``): how often each known value stands in each group."""
    value = F.col(value) if isinstance(value, str) else value
    known = df.select(*keys, value.alias("_v")).where(F.col("_v").isNotNull())
    return known.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))


def quantiles_of_counts(
    counts: DataFrame, size: int, by: list[str], probs: dict[str, float]
) -> DataFrame:
    """``quantiles`` from a written table of ``value_counts`` with ``size`` rows."""
    placed = running_sum(counts, by, ["_v"], "_c", "_upto", size)
    if size <= tuning(counts.sparkSession, HOT_ROWS):
        placed = placed.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    else:
        placed = with_stats(placed, by, counts, _n=F.sum("_c"))
    first = F.col("_upto") - F.col("_c")

    def pick(q: float) -> Column:
        spot = (F.col("_n") - 1) * F.lit(float(q))
        at = lambda rank: F.max(
            F.when((first <= rank) & (rank < F.col("_upto")), F.col("_v"))
        )
        low, part = at(F.floor(spot)), F.max(spot - F.floor(spot))
        return low + (at(F.ceil(spot)) - low) * part

    return placed.groupBy(*by).agg(*[pick(q).alias(name) for name, q in probs.items()])


def average_rank(value: str, keys: Sequence[str] = ()) -> Column:
    """Rank over n with ties sharing their average rank.

    Use it on summary tables (one row per store, say): without keys it is one task.
    """
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, value))
    rows = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return (F.rank().over(Window.partitionBy(*keys).orderBy(value)) + (ties - 1) / 2) / rows
