"""The two feature sets, composed so that each kind of shuffle happens once.

Everything that depends on the same key is computed together: one aggregate per
key, one sort per window order. ``scope`` adds leading keys (``case_id`` when
scoring cases), so that every case sees only its own history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import cyclic, ratio
from shelfcast.operators import dates, history, pricing, promo, stores, target
from shelfcast.operators.skew import attach, ordered, packed, quantiles, with_stats
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle

# Columns computed from the row's own target: reports only, never model input.
OWN_TARGET = [
    "weighed_group_ratio", "sales_scale_weighed", "sales_scale_unit", "store_day_sales",
    "store_day_share", "sku_day_relative", "yoy_change",
]


# Windows come first, while rows are narrow: only they move and sort the rows. What depends on the row alone or
# is looked up in small tables is added afterwards, where nothing moves any more.

def _ahead(df: DataFrame, given: Sequence[str], last: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """``df`` with the ``given`` columns first, and the names of the others, those of ``last`` at their end."""
    made = [c for c in df.columns if c not in given and c not in last]
    return df.select(*given, *made, *last), [*made, *last]


def _row_features(df: DataFrame, holidays: DataFrame, promotions: DataFrame, scope, source: DataFrame) -> DataFrame:
    df = dates.days_since_start(dates.calendar(pricing.discount(df)), scope, source)
    df = promo.promo_lookup(df, promotions)
    return dates.holiday_distance(df, holidays)


def wide_features(
    df: DataFrame,
    holidays: DataFrame,
    promotions: DataFrame,
    scope=(),
    exclude_current: bool = False,
    y: str = "net_sales",
) -> DataFrame:
    """About a hundred columns. ``exclude_current`` keeps the row's own target out of windows.

    Group statistics are read from ``df`` as given, so pass a written table.
    """
    scope, source = list(scope), pricing.discount(df)
    given, keys = df.columns, [*scope, *GROUP]
    # What no window and no lookup reads goes through them in one piece.
    read = dict.fromkeys([*keys, *ORDER, "price", "promo_id", "promo_active", "weighed", y])
    unread = [c for c in given if c not in read]
    df = df.select(*read, F.struct(*unread).alias("_given")) if unread else df
    df = history.with_median(df, [*scope, "sku"], y, "_median", source)
    df = history.yoy_change(promo.promo_share_30(df, scope, source), y, scope, source)

    def by_group(d: DataFrame, w) -> DataFrame:
        d = history.lag_columns(d, w, history.LAGS_WIDE, y, "_median")
        d = d.withColumn("_lags", F.struct(*lagged)).drop("_median", *lagged)
        d = history.slope_columns(d, w, y, exclude_current)
        d = promo.recent_promo_columns(pricing.price_change_columns(d, w), w)
        return history.recent_statistics(d, w, history.WINDOWS_WIDE, stats, y, exclude_current=exclude_current)

    stats = ["mean", "median", "max", "min", "std"]
    carry = {"_price_before": "price"}
    lagged = [f"lag_{n}" for n in history.LAGS_WIDE]
    sloped = ["trend_slope_7", "acceleration_7", "price_change", "recent_promo_7"]
    df = ordered(df, keys, ORDER, by_group, 91, carry, source, spread=True)

    recent = [*history.recent_names(history.WINDOWS_WIDE, stats), *sloped, "promo_share_30", "yoy_change"]
    df = df.select(*[c for c in df.columns if c not in recent], F.struct(*recent).alias("_recent"))
    df = dates.days_since_start(promo.promo_lookup(df, promotions), scope, source)
    df, made = _with_lookups(df, _wide_lookups(source, holidays, scope, y))
    days = {c: F.col(f"_day.{c}") for c in made["_day"]}
    days |= {c: F.coalesce(v, F.lit(dates.FAR)) for c, v in days.items() if c.startswith("days_")}
    by_kind = ratio(F.col("price"), F.col("_kind._price"), 0)

    df = pricing.discount(df).withColumns(days)
    df = df.withColumns(
        {
            "sku_mean_discount": F.col("_sku.sku_mean_discount"),
            "price_vs_sku_mean": ratio(F.col("price"), F.col("_sku._price"), 1),
            "promos_in_store_day": F.col("_store_day.promos_in_store_day"),
            "store_day_sales": F.col("_store_day.store_day_sales"),
            "price_dev_store_day": F.col("price") - F.col("_store_day._price"),
            "store_day_share": ratio(F.col(y), F.col("_store_day.store_day_sales"), 0),
            **promo.effectiveness_columns(F.col("_group._on"), F.col("_group._off")),
            "weighed_group_mean": F.col("_kind.weighed_group_mean"),
            "weighed_group_ratio": ratio(F.col("net_sales"), F.col("_kind.weighed_group_mean"), 1),
        }
    )
    df = stores.per_kind(df, "price_ratio", by_kind)
    df = stores.per_kind(df, "sales_scale", stores.between_quartiles(F.col("_kind._q25"), F.col("_kind._q75")))
    df = df.withColumns(
        {
            "store_rank": F.col("_store.store_rank"),
            "sku_day_relative": ratio(F.col("net_sales"), F.col("_sku_day._mean"), 1),
        }
    )
    # Model features are taken in the order of the columns.
    first = [*scope, "sku", "sale_date", "store_id", "weighed", "promo_id"]
    own = [F.col(f"_given.{c}") if c in unread else F.col(c) for c in given if c not in first]
    row = ["discount_real", "had_discount", *CALENDAR, "days_since_start", "promo_type_ext", "clearance_ext"]
    used = {*given, *row, "_given", "_lags", "_recent", *made}
    df = df.select(*first, *own, *row, *[c for c in df.columns if c not in used], "_lags.*", "_recent.*")
    return target.cross_features(history.trend_diff(df))


def category_columns(df: DataFrame, promotions: DataFrame) -> DataFrame:
    """``df`` with the text columns of ``wide_features`` and what they are made of, without windows or shuffles."""
    return target.cross_features(dates.calendar(promo.promo_lookup(df, promotions)))


CALENDAR = ["weekday", "month", "year", "is_weekend", "day_of_year", "week_of_year", "quarter", "day_of_month"]


def _wide_lookups(source: DataFrame, holidays: DataFrame, scope: list[str], y: str) -> dict[str, tuple[list[str], DataFrame]]:
    """(keys, table) by name: what rows of equal keys share."""
    means = lambda keys, **aggs: (keys, source.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()]))
    days = source.select("sale_date").where(F.col("sale_date").isNotNull()).distinct()
    days = dates.holiday_distance(dates.calendar(settle(days, "days")), holidays)
    days = dates.sale_season(dates.month_edges(dates.cyclic_time(days)))
    kind = [*scope, "weighed", "store_id"]
    _, kinds = means(kind, weighed_group_mean=F.avg("net_sales"), _price=F.avg("price"))
    return {
        "_day": (["sale_date"], dates.holiday_distance_by_type(days, holidays)),
        "_sku": means([*scope, "sku"], _price=F.avg("price"), sku_mean_discount=F.avg("discount_real")),
        "_store_day": means(
            [*scope, "store_id", "sale_date"],
            _price=F.avg("price"), promos_in_store_day=F.sum("promo_active"), store_day_sales=F.sum(y),
        ),
        "_group": means([*scope, *GROUP], **promo.state_means()),
        "_kind": (kind, attach(kinds, quantiles(source, kind, "net_sales", {"_q25": 0.25, "_q75": 0.75}), kind)),
        "_store": ([*scope, "store_id"], stores.store_ranks(source, scope)),
        "_sku_day": means([*scope, "sku", "sale_date"], _mean=F.avg("net_sales")),
    }


def _with_lookups(df: DataFrame, tables: dict[str, tuple[list[str], DataFrame]]) -> tuple[DataFrame, dict[str, list[str]]]:
    """``df`` with one struct column per table, and the structs' columns."""
    made = {}
    for name, (keys, table) in tables.items():
        made[name] = [c for c in table.columns if c not in keys]
        df = attach(df, packed(table, keys, name), keys)
    return df, made


def lean_features(
    df: DataFrame,
    holidays: DataFrame,
    promotions: DataFrame,
    scope=(),
    exclude_current: bool = False,
    y: str = "net_sales",
) -> DataFrame:
    """The smaller feature set used for scoring cases with their history."""
    scope, source = list(scope), df
    given, keys = df.columns, [*scope, *GROUP]
    df = promo.distinct_promos_30d(df, scope, source)
    df = history.with_median(df, keys, y, "_median", source)

    def by_group(d: DataFrame, w) -> DataFrame:
        d = history.lag_columns(d, w, history.LAGS_LEAN, y, "_median")
        d = history.rolling_columns(
            d, w, history.WINDOWS_LEAN, ["mean"], y, exclude_current=exclude_current
        )
        return history.rolling_columns(
            d, w, history.WINDOWS_SUMS, list(history.SUM_NAMES), y, history.SUM_NAMES,
            exclude_current,
        )

    df = ordered(df, keys, ORDER, by_group, 91, source=source).drop("_median")
    df, windowed = _ahead(df, given, last=["promos_30d"])

    df = _row_features(df, holidays, promotions, scope, source)
    sin, cos = cyclic(F.col("day_of_year"), 365)
    df = df.withColumns({"sin_day": sin, "cos_day": cos})
    df = with_stats(df, [*scope, "sku"], source, sku_mean=F.avg(y), _price=F.avg("price"))
    df = df.withColumn("price_dev_sku", F.col("price") - F.col("_price")).drop("_price")
    first = [*keys, "sale_date"]
    df = df.select(*first, *[c for c in df.columns if c not in [*first, *windowed]], *windowed)
    return history.trend_diff(df)


LEAN_FEATURES = [
    "days_since_start", "year", "weekday", "month", "is_weekend", "is_holiday", "holiday_type",
    "day_off", "day_of_year", "sin_day", "cos_day",
    *[f"lag_{n}" for n in history.LAGS_LEAN], *[f"ma_{n}" for n in history.WINDOWS_LEAN],
    "trend_1_7", "sku_mean",
    "price", "price_dev_sku", "discount_pct", "certificate_total", "receipt_total",
    "discount_real", "had_discount",
    "promo_active", "promo_type", "promo_type_ext", "clearance_ext", "promo_code_used",
    *[f"rolling_{s}_{n}" for n in history.WINDOWS_SUMS for s in ("sum", "mean", "median", "count")],
    "promos_30d", "days_to_holiday", "days_since_holiday",
    "store_id", "sku", "weighed", "customer_card",
]
