"""Lags, rolling statistics and trends over the row order of a (SKU, store) group."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from shelfcast.functions.columns import ratio
from shelfcast.operators.skew import attach, ordered, quantiles
from shelfcast.schema import GROUP, ORDER

LAGS_WIDE = (1, 2, 3, 7, 14, 21, 30, 60, 90)
LAGS_LEAN = (1, 7, 14, 30, 90)
WINDOWS_WIDE = (3, 7, 14, 30, 90)
WINDOWS_LEAN = (7, 30, 90)
WINDOWS_SUMS = (3, 7, 30)


def _frame(w, rows: int, exclude_current: bool):
    return w.rowsBetween(-rows, -1) if exclude_current else w.rowsBetween(1 - rows, 0)


def lag_columns(d: DataFrame, w, lags: Sequence[int], target: str, fill: str) -> DataFrame:
    return d.withColumns(
        {f"lag_{n}": F.coalesce(F.lag(target, n).over(w), F.col(fill)) for n in lags}
    )


def with_median(
    df: DataFrame, keys: Sequence[str], target: str, out: str, source: DataFrame | None = None
) -> DataFrame:
    return attach(df, quantiles(source or df, keys, target, {out: 0.5}), keys)


def lags(
    df: DataFrame,
    lags: Sequence[int] = LAGS_WIDE,
    target: str = "net_sales",
    fill_by: Sequence[str] = ("sku",),
    scope=(),
) -> DataFrame:
    """Row lags; where there is no such row, the median of ``fill_by``."""
    rows = with_median(df, [*scope, *fill_by], target, "_median")
    return ordered(
        rows, [*scope, *GROUP], ORDER,
        lambda d, w: lag_columns(d, w, lags, target, "_median"), max(lags), source=df,
    ).drop("_median")


def rolling_columns(
    d: DataFrame,
    w,
    windows: Sequence[int],
    stats: Sequence[str],
    target: str,
    names: dict[str, str] | None = None,
    exclude_current: bool = False,
) -> DataFrame:
    """Statistics over the last n rows, skipping NULLs; all share one sort.

    A sliding frame of Spark adds up all its rows again for every row. So where medians are wanted,
    ``recent_statistics`` takes everything from the sorted rows themselves, sorted once per width.
    """
    names = {"mean": "ma", **(names or {})}
    name = lambda stat, n: f"{names.get(stat, stat)}_{n}"
    if "median" in stats:
        return recent_statistics(d, w, windows, stats, target, names, exclude_current)
    plain = {
        "sum": F.sum, "mean": F.avg, "max": F.max, "min": F.min, "count": F.count,
        "std": lambda c: F.stddev_samp(c),
    }
    out: dict[str, Column] = {}
    for n in windows:
        for stat in stats:
            value = plain[stat](target).over(_frame(w, n, exclude_current))
            out[name(stat, n)] = F.coalesce(value, F.lit(0.0)) if stat == "std" else value
    return d.withColumns(out)


def recent_names(windows: Sequence[int], stats: Sequence[str], names: dict[str, str] | None = None) -> list[str]:
    names = {"mean": "ma", **(names or {})}
    return [f"{names.get(s, s)}_{n}" for n in windows for s in stats]


def recent_statistics(
    d: DataFrame,
    w,
    windows: Sequence[int],
    stats: Sequence[str],
    target: str,
    names: dict[str, str] | None = None,
    exclude_current: bool = False,
) -> DataFrame:
    """Statistics over the last n rows. Rows leave a window sorted, and an Arrow function reads them in that order,
    one value and one position each. Spark sorts and shuffles again for a window after an Arrow function, so take
    this step after all windows."""
    value = F.coalesce(F.col(target).cast("double"), F.lit(float("nan")))
    found = window_statistics(windows, stats, exclude_current)(value, F.col("_at"))
    d = d.withColumn("_at", F.row_number().over(w)).withColumn("_found", found)
    made = [f"{s}_{n}" for n in windows for s in stats]
    columns = {name: F.col(f"_found.{m}") for name, m in zip(recent_names(windows, stats, names), made)}
    return d.withColumns(columns).drop("_at", "_found")


def _statistic(stat: str, ordered_: np.ndarray, known: np.ndarray, total: np.ndarray) -> pa.Array:
    """One statistic per row of sorted values (missing ones last), of which ``known`` are there."""
    at = lambda k: np.take_along_axis(ordered_, np.maximum(k, 0)[:, None], axis=1)[:, 0]
    if stat == "count":
        return pa.array(known)
    if stat == "std":
        mean = total / np.maximum(known, 1)
        square = np.nansum((ordered_ - mean[:, None]) ** 2, axis=1)
        return pa.array(np.where(known > 1, np.sqrt(square / np.maximum(known - 1, 1)), 0.0))
    value = {
        "sum": lambda: total,
        "mean": lambda: total / np.maximum(known, 1),
        "max": lambda: at(known - 1),
        "min": lambda: at(0 * known),
        "median": lambda: (at((known - 1) // 2) + at(known // 2)) / 2,
    }[stat]()
    return pa.array(value, mask=known == 0)


def window_statistics(windows: Sequence[int], stats: Sequence[str], exclude_current: bool = False):
    """Arrow function from the values of sorted groups (NaN for missing) and the rows' positions in their group, from
    1, to a struct with ``<stat>_<n>`` over the last n rows; null (a deviation or count: 0) without any value.

    It reads a task's batches one after another and keeps the last values of each for the next. It is marked as not
    deterministic, so that Spark filters no rows before it; rows that do not follow each other are an error.
    """
    names = [f"{s}_{n}" for n in windows for s in stats]
    kinds = [LongType() if s == "count" else DoubleType() for _ in windows for s in stats]
    width, block, skip = max(windows), 4096, int(exclude_current)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        before, last = np.full(width, np.nan), 0
        for value, place in batches:
            place = place.to_numpy(zero_copy_only=False)
            follows = np.concatenate([[last], place[:-1]]) + 1 if len(place) else place
            if not np.all((place == follows) | (place == 1)):
                raise RuntimeError("rows are not in the order of their window")
            values = np.concatenate([before, value.to_numpy(zero_copy_only=False)])
            # Row i is at i + width; its lists end there, or one before.
            lists = np.lib.stride_tricks.sliding_window_view(values, width)[1 - skip :]
            parts = [solve(lists[k : k + block], place[k : k + block] - skip) for k in range(0, len(place), block)]
            before, last = values[-width:], place[-1] if len(place) else last
            yield pa.concat_arrays(parts) if parts else solve(lists[:0], place)

    def solve(lists: np.ndarray, inside: np.ndarray) -> pa.Array:
        lists = lists[: len(inside)]
        table = np.where(np.arange(width, 0, -1) <= inside[:, None], lists, np.nan)
        columns = []
        for n in windows:
            part = np.sort(table[:, width - n :], axis=1)
            known = n - np.isnan(part).sum(axis=1)
            total = np.nansum(part, axis=1)
            columns += [_statistic(stat, part, known, total) for stat in stats]
        return pa.StructArray.from_arrays(columns, names)

    return arrow_udf(run, StructType([StructField(n, kind) for n, kind in zip(names, kinds)])).asNondeterministic()


def rolling(
    df: DataFrame,
    windows: Sequence[int],
    stats: Sequence[str],
    target: str = "net_sales",
    names: dict[str, str] | None = None,
    exclude_current: bool = False,
    scope=(),
) -> DataFrame:
    return ordered(
        df, [*scope, *GROUP], ORDER,
        lambda d, w: rolling_columns(d, w, windows, stats, target, names, exclude_current),
        max(windows),
    )


def rolling_stats(df: DataFrame, target: str = "net_sales", scope=()) -> DataFrame:
    return rolling(df, WINDOWS_WIDE, ["mean", "median", "max", "min", "std"], target, scope=scope)


def rolling_mean(df: DataFrame, target: str = "net_sales", scope=()) -> DataFrame:
    return rolling(df, WINDOWS_LEAN, ["mean"], target, scope=scope)


SUM_NAMES = {s: f"rolling_{s}" for s in ("sum", "mean", "median", "count")}


def rolling_sum_count(df: DataFrame, target: str = "net_sales", scope=()) -> DataFrame:
    return rolling(df, WINDOWS_SUMS, list(SUM_NAMES), target, SUM_NAMES, scope=scope)


def slope_columns(d: DataFrame, w, target: str, exclude_current: bool = False) -> DataFrame:
    """Least-squares slope over the last 7 rows (3 values at least), and its change."""
    frame = _frame(w, 7, exclude_current)
    d = d.withColumn("_row", F.row_number().over(w))
    slope = F.when(F.count(target).over(frame) >= 3, F.regr_slope(target, "_row").over(frame))
    d = d.withColumn("trend_slope_7", F.coalesce(slope, F.lit(0.0)))
    change = F.col("trend_slope_7") - F.lag("trend_slope_7").over(w)
    return d.withColumn("acceleration_7", F.coalesce(change, F.lit(0.0))).drop("_row")


def trend_slope(df: DataFrame, target: str = "net_sales", scope=()) -> DataFrame:
    return ordered(
        df, [*scope, *GROUP], ORDER, lambda d, w: slope_columns(d, w, target), 8
    )


def trend_diff(df: DataFrame) -> DataFrame:
    """Short and long trend from lag 1 and the moving averages already on the row."""
    out = {"trend_1_7": F.col("lag_1") - F.col("ma_7")}
    if "ma_30" in df.columns:
        out["trend_7_30"] = F.col("ma_7") - F.col("ma_30")
    return df.withColumns(out)


def yoy_change(
    df: DataFrame, target: str = "net_sales", scope=(), source: DataFrame | None = None
) -> DataFrame:
    """Value over the previous value of the group on the same day of the year."""
    doy = F.dayofyear("sale_date")
    df, source = df.withColumn("_doy", doy), (source or df).withColumn("_doy", doy)
    return ordered(
        df, [*scope, *GROUP, "_doy"], ORDER,
        lambda d, w: d.withColumn(
            "yoy_change", ratio(F.col(target), F.lag(target).over(w), 1)
        ),
        1,
        source=source,
    ).drop("_doy")


def numbered(df: DataFrame, scope=()) -> DataFrame:
    """Position of the row in its group, from 1."""
    from shelfcast.operators.skew import running_sum

    df = df.withColumn("_one", F.lit(1))
    return running_sum(df, [*scope, *GROUP], ORDER, "_one", "position").drop("_one")


def previous_mean(df: DataFrame, rows: int = 7, target: str = "net_sales") -> DataFrame:
    """A simple predictor: mean of the group's previous rows, 0 when there are none."""
    return ordered(
        df, GROUP, ORDER,
        lambda d, w: d.withColumn(
            "predicted", F.coalesce(F.avg(target).over(w.rowsBetween(-rows, -1)), F.lit(0.0))
        ),
        rows,
    )


