"""Store, product, promotion and season reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio
from shelfcast.operators.skew import average_rank, quantiles

# Names printed in the season reports.
WEEKDAY_NAMES = [
    "Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье",
]
MONTH_NAMES = [
    "Январь", "Февраль", "Март", "Апрель", "Май", "Июнь",
    "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь",
]
HOLIDAY_PERIODS = {
    "before": "За 1-7 дней до праздника",
    "on": "В день праздника",
    "after": "В течение 1-7 дней после праздника",
    "normal": "Обычные дни",
}


def per_day(df: DataFrame, *keys: str, target: str = "net_sales") -> DataFrame:
    """Sums and counts per key set, so that distinct counts run on far fewer rows."""
    return df.groupBy(*keys).agg(
        F.sum(target).alias("_sum"),
        F.count(target).alias("_known"),
        F.count("sale_date").alias("_rows"),
    )


def _mean(condition: Column | None = None) -> Column:
    total, known = F.col("_sum"), F.col("_known")
    if condition is not None:
        total, known = F.when(condition, total), F.when(condition, known)
    return F.try_divide(F.sum(total), F.sum(known))


def store_summary(df: DataFrame, target: str = "net_sales") -> DataFrame:
    """Mean, sum, SKUs and rows per store with the percentile rank of the sum."""
    return (
        per_day(df, "store_id", "sku", target=target).groupBy("store_id").agg(
            _mean().alias("mean_sales"),
            F.sum("_sum").alias("total_sales"),
            F.count_distinct("sku").alias("sku_count"),
            F.sum("_rows").alias("row_count"),
        )
        .withColumn("rating", F.bround(average_rank("total_sales"), 3))
        .orderBy(F.col("total_sales").desc(), "store_id")
    )


def product_summary(df: DataFrame, target: str = "net_sales") -> DataFrame:
    """Mean, sum, stores and days per SKU, with its weighed flag."""
    flag = [F.max("weighed").alias("weighed")] if "weighed" in df.columns else []
    parts = per_day(df, "sku", "store_id", "sale_date", *(["weighed"] if flag else []), target=target)
    return (
        parts.groupBy("sku").agg(
            _mean().alias("mean_sales"),
            F.sum("_sum").alias("total_sales"),
            F.count_distinct("store_id").alias("store_count"),
            F.count_distinct("sale_date").alias("day_count"),
            *flag,
        )
        .orderBy(F.col("total_sales").desc(), "sku")
    )


def promo_effect_by_sku(
    df: DataFrame, min_days: int = 5, target: str = "net_sales"
) -> DataFrame:
    """Mean sales and days with and without promotion per SKU, and their ratio."""
    on, off = F.col("promo_active") == 1, F.col("promo_active") == 0
    table = per_day(df, "sku", "promo_active", "sale_date", target=target).groupBy("sku").agg(
        F.coalesce(_mean(off), F.lit(0.0)).alias("sales_without_promo"),
        F.coalesce(_mean(on), F.lit(0.0)).alias("sales_with_promo"),
        F.count(F.when(off, F.col("sale_date"))).alias("days_without_promo"),
        F.count(F.when(on, F.col("sale_date"))).alias("days_with_promo"),
    )
    base = F.when(F.col("sales_without_promo") == 0, 1.0).otherwise(F.col("sales_without_promo"))
    return (
        table.withColumn("promo_effect", F.col("sales_with_promo") / base)
        .where(F.col("days_with_promo") >= min_days)
        .orderBy(F.col("promo_effect").desc(), "sku")
    )


def promo_effect_by_type(df: DataFrame, target: str = "net_sales") -> DataFrame:
    """Mean sales, SKUs and days per promotion type, against the mean without promotion."""
    parts = per_day(df, "promo_type", "promo_active", "sku", "sale_date", target=target)
    off = F.col("promo_active") == 0
    types = parts.groupBy("promo_type").agg(
        _mean().alias("mean_sales"),
        F.count_distinct("sku").alias("sku_count"),
        F.count_distinct("sale_date").alias("day_count"),
        F.sum(F.when(off, F.col("_sum"))).alias("_off_sum"),
        F.sum(F.when(off, F.col("_known"))).alias("_off_known"),
    )
    # One row per promotion type here, so the window over all of them is tiny.
    every = Window.partitionBy()
    plain = F.try_divide(F.sum("_off_sum").over(every), F.sum("_off_known").over(every))
    return (
        types.withColumn("type_effect", F.try_divide(F.col("mean_sales"), plain))
        .drop("_off_sum", "_off_known")
        .orderBy(F.col("type_effect").desc_nulls_last(), "promo_type")
    )


def _season(df: DataFrame, part: str, value: Column, names: list[str], first: int, target: str):
    dated = df.select(value.alias(part), F.col(target))
    table = dated.groupBy(part).agg(
        F.avg(target).alias("mean_sales"), F.stddev_samp(target).alias("std_sales")
    )
    middles = quantiles(dated, [part], target, {"median_sales": 0.5})
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col(part) + (1 - first))
    # 7 or 12 rows.
    overall = F.avg("mean_sales").over(Window.partitionBy())
    return (
        table.join(middles, part, "left")
        .withColumns({f"{part}_name": label, "ratio": F.try_divide("mean_sales", overall)})
        .orderBy(part)
    )


def season_weekday(df: DataFrame, target: str = "net_sales") -> DataFrame:
    return _season(df, "weekday", F.weekday("sale_date"), WEEKDAY_NAMES, 0, target)


def season_month(df: DataFrame, target: str = "net_sales") -> DataFrame:
    return _season(df, "month", F.month("sale_date"), MONTH_NAMES, 1, target)


def season_holiday(df: DataFrame, target: str = "net_sales") -> DataFrame:
    """Mean sales before, on, after and away from holidays; the periods may overlap."""
    to, since = F.col("days_to_holiday"), F.col("days_since_holiday")
    tests = {
        "before": to.between(1, 7),
        "on": F.col("is_holiday") == 1,
        "after": since.between(1, 7),
        "normal": (to > 7) & (since > 7),
    }
    one = df.agg(
        F.avg(target).alias("_all"),
        *[F.avg(F.when(test, F.col(target))).alias(name) for name, test in tests.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(HOLIDAY_PERIODS[name]).alias("period"), F.col(name).alias("mean_sales")
            )
            for name in tests
        ]
    )
    return (
        one.select("_all", F.inline(rows)).where(F.col("mean_sales").isNotNull())
        .select("period", "mean_sales", ratio(F.col("mean_sales"), F.col("_all"), 1).alias("ratio"))
    )
