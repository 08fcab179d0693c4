"""Row selection, future grids, case history and time-ordered folds."""

from __future__ import annotations

from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.skew import attach, lookup, running_sum, with_stats
from shelfcast.operators.target import last_date
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle

HISTORY_DAYS = 90
BLOCK_DAYS = 30


def point_filter(df: DataFrame, sku: str, store_id: str) -> DataFrame:
    return df.where((F.col("sku") == sku) & (F.col("store_id") == store_id))


def history_tail(
    df: DataFrame, sku: str, store_id: str, day: date, days: int = HISTORY_DAYS
) -> DataFrame:
    """Rows of one group in the ``days`` before ``day``."""
    until = F.to_date(F.lit(str(day)))
    return point_filter(df, sku, store_id).where(
        (F.col("sale_date") < until) & (F.col("sale_date") >= F.date_sub(until, days))
    )


def distinct_pairs(df: DataFrame) -> DataFrame:
    return df.select(*GROUP).distinct()


def future_grid(df: DataFrame, days: int = 30) -> DataFrame:
    """Every (SKU, store) pair on each of the ``days`` days after the last date."""
    last = F.lit(last_date(df))
    return distinct_pairs(df).withColumn(
        "sale_date", F.explode(F.sequence(F.date_add(last, 1), F.date_add(last, days)))
    )


def future_rows(df: DataFrame, last: date) -> DataFrame:
    return df.where(F.col("sale_date") > F.lit(last))


def union_history_future(history: DataFrame, future: DataFrame) -> DataFrame:
    return history.unionByName(future, allowMissingColumns=True)


def last_attributes(df: DataFrame, columns: list[str]) -> DataFrame:
    """The last known attributes of each SKU (latest row in sales order).

    The last date is found first: rows of that date only, not all rows, go through
    the comparison of whole row positions.
    """
    df = with_stats(df, ["sku"], _last=F.max("sale_date")).where(F.col("sale_date") == F.col("_last"))
    latest = F.max_by(F.struct(*columns), F.struct(*ORDER))
    return df.groupBy("sku").agg(latest.alias("a")).select("sku", "a.*")


def batch_history(
    cases: DataFrame, sales: DataFrame, days: int = HISTORY_DAYS
) -> DataFrame:
    """For every case, the rows of its group in the ``days`` days before it.

    Dates are cut into blocks and a case is listed under the few blocks it needs, so
    the join is an equality on (group, block) and a case never meets its group's
    whole history.
    """
    block = lambda day: F.floor(F.unix_date(day) / BLOCK_DAYS)
    day = F.col("sale_date")
    wanted = cases.select(
        *GROUP, "case_id", F.col("sale_date").alias("_case_date"),
        F.explode(
            F.sequence(block(F.date_sub(day, days)), block(F.date_sub(day, 1)))
        ).alias("_block"),
    )
    joined = sales.withColumn("_block", block(day)).join(lookup(wanted), [*GROUP, "_block"])
    return joined.where(
        (day < F.col("_case_date")) & (day >= F.date_sub("_case_date", days))
    ).drop("_block", "_case_date")


def row_number_by_time(df: DataFrame, out: str = "row_index") -> DataFrame:
    """0-based position of every row in time order, without one global sort.

    Rows per day give each day's offset (a table of days); inside a day rows are
    numbered on their own.
    """
    daily = df.groupBy("sale_date").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("sale_date").rowsBetween(Window.unboundedPreceding, -1)
    offsets = daily.select("sale_date", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = running_sum(
        df.withColumn("_one", F.lit(1)), ["sale_date"], ORDER[1:], "_one", "_place"
    )
    numbered = attach(numbered, offsets, ["sale_date"])
    return numbered.withColumn(out, F.col("_offset") + F.col("_place") - 1).drop(
        "_one", "_place", "_offset"
    )


def fold_bounds(rows: int, folds: int) -> list[tuple[int, int, int]]:
    """(fold, first validation row, end) of an expanding-window split."""
    size = rows // (folds + 1)
    start = rows - folds * size
    return [(k + 1, start + k * size, start + (k + 1) * size) for k in range(folds)]


def ts_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Add ``row_index`` and ``fold``: the fold a row validates (0: training only).

    Fold k trains on all rows of smaller folds.
    """
    bounds = fold_bounds(df.count(), folds)
    indexed = row_number_by_time(df)
    fold = F.lit(0)
    for k, start, _ in bounds:
        fold = F.when(F.col("row_index") >= start, k).otherwise(fold)
    return indexed.withColumn("fold", fold)


def mark_folds(df: DataFrame, folds: int = 5) -> DataFrame:
    """Add ``fold`` as ``ts_folds`` does, without moving the rows (they may be as wide as a feature matrix).

    Rows per day tell the day on which each fold begins, and only the order columns of these days are
    sorted to find the row; all others are compared with it. Copies of such a row are numbered on
    their own. Pass a written table.
    """
    daily = settle(df.groupBy("sale_date").agg(F.count(F.lit(1)).alias("_rows")), "days")
    before = Window.orderBy("sale_date").rowsBetween(Window.unboundedPreceding, -1)
    daily = daily.withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    starts = {k: start for k, start, _ in fold_bounds(daily.agg(F.sum("_rows")).first()[0] or 0, folds)}
    begins = lambda start: (F.col("_offset") <= start) & (F.lit(start) < F.col("_offset") + F.col("_rows"))
    days = {k: daily.where(begins(start)).first() for k, start in starts.items()}
    wanted = [day["sale_date"] for day in days.values() if day and day["sale_date"]]
    rows = df.where(F.col("sale_date").isin(wanted)).select(*ORDER, F.lit(1).alias("_one"))
    numbered = settle(running_sum(rows, ["sale_date"], ORDER[1:], "_one", "_place"), "places")

    kinds, place = dict(df.dtypes), F.struct(*ORDER)
    found = {}
    for k, day in days.items():
        if day and day["sale_date"]:
            at = starts[k] - day["_offset"]
            row = numbered.where((F.col("sale_date") == F.lit(day["sale_date"])) & (F.col("_place") == at + 1)).first()
            key = F.struct(*[F.lit(row[c]).cast(kinds[c]).alias(c) for c in ORDER])
            first = numbered.where(place == key).agg(F.min("_place")).first()[0]
            found[k] = key, at + 1 - first  # copies of the row that belong to the fold before
    df = df.withColumn("_copy", F.lit(0))
    split = [key for key, ahead in found.values() if ahead]
    if split:
        of_these = reduce(or_, [place == key for key in split])
        copies = df.where(of_these).withColumn("_copy", F.row_number().over(Window.partitionBy(*ORDER).orderBy(*ORDER)))
        df = df.where(~of_these).unionByName(settle(copies, "copies"))
    fold = F.lit(0)
    for k, day in days.items():
        if k in found:
            key, ahead = found[k]
            reached = (place > key) | ((place == key) & (F.col("_copy") > ahead)) if ahead else place >= key
            fold = F.when(reached, k).otherwise(fold)
        elif day:  # it begins among the rows without a date, which come first and train only
            fold = F.when(F.col("sale_date").isNotNull(), k).otherwise(fold)
    return df.withColumn("fold", fold).drop("_copy")
