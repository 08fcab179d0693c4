"""Promotion features."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio
from shelfcast.operators.skew import attach, ordered, with_stats
from shelfcast.schema import GROUP, NO_PROMO, ORDER
from shelfcast.sources.load import unique_promotions


def promo_lookup(df: DataFrame, promotions: DataFrame) -> DataFrame:
    """Type and clearance flag of the promotion id, whether or not it runs that day."""
    names = unique_promotions(promotions).select(
        "promo_id",
        F.col("promo_type").alias("promo_type_ext"),
        F.col("is_clearance").alias("clearance_ext"),
    )
    return attach(df, names, ["promo_id"]).fillna(
        {"promo_type_ext": NO_PROMO, "clearance_ext": 0}
    )


def promos_in_store_day(df: DataFrame, scope=()) -> DataFrame:
    return with_stats(
        df, [*scope, "store_id", "sale_date"], promos_in_store_day=F.sum("promo_active")
    )


def promo_share_30(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Share of promotion rows among the SKU's last 30 rows, all stores in store order."""
    return ordered(
        df,
        [*scope, "sku"],
        ["store_id", *ORDER],
        lambda d, w: d.withColumn(
            "promo_share_30", F.avg("promo_active").over(w.rowsBetween(-29, 0))
        ),
        29,
        source=source,
    )


def sku_mean_discount(df: DataFrame, scope=()) -> DataFrame:
    return with_stats(df, [*scope, "sku"], sku_mean_discount=F.avg("discount_real"))


def recent_promo_columns(d: DataFrame, w) -> DataFrame:
    recent = F.max("promo_active").over(w.rowsBetween(-7, -1))
    return d.withColumn("recent_promo_7", F.coalesce(recent, F.lit(0)))


def recent_promo_7(df: DataFrame, scope=()) -> DataFrame:
    return ordered(df, [*scope, *GROUP], ORDER, recent_promo_columns, 7)


def state_means() -> dict[str, Column]:
    """Aggregates of a group: mean net sales on and off promotion."""
    return {
        f"_{name}": F.avg(F.when(F.col("promo_active") == flag, F.col("net_sales")))
        for name, flag in (("on", 1), ("off", 0))
    }


def effectiveness_columns(on: Column, off: Column) -> dict[str, Column]:
    active = F.col("promo_active")
    return {
        "promo_sales_mean": F.when(active == 1, on).when(active == 0, off),
        "promo_effectiveness": ratio(on, off, 1),
    }


def promo_effectiveness(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Mean net sales of the row's own promotion state, and the ratio on / off promotion."""
    df = with_stats(df, [*scope, *GROUP], source, **state_means())
    return df.withColumns(effectiveness_columns(F.col("_on"), F.col("_off"))).drop("_on", "_off")


def distinct_promos_30d(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Distinct promotion ids of the group in the last 30 calendar days.

    Works on the distinct (group, day, promotion) rows. A promotion seen on a day
    counts until 29 days later, so each run of sightings is an interval and the
    answer is the number of intervals open on the day.
    """
    keys = [*scope, *GROUP]
    day = F.unix_date("sale_date")
    seen = (
        (source or df).where(F.col("promo_id").isNotNull() & F.col("sale_date").isNotNull())
        .select(*keys, "promo_id", day.alias("_day")).distinct()
    )
    by_promo = Window.partitionBy(*keys, "promo_id").orderBy("_day")
    runs = seen.withColumns(
        {"_prev": F.lag("_day").over(by_promo), "_next": F.lead("_day").over(by_promo)}
    )
    steps = runs.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.col("_day").alias("_day"),
                    F.when(F.col("_day") - F.col("_prev") < 30, 0).otherwise(1).alias("_step"),
                ),
                F.struct(
                    (F.col("_day") + 30).alias("_day"),
                    F.when(F.col("_next") - F.col("_day") < 30, 0).otherwise(-1).alias("_step"),
                ),
            )
        ),
    )
    # A group has at most one row per day and promotion here, so it is bounded by the
    # calendar; one shuffle by group serves the daily sums and the window.
    daily = steps.repartition(*keys).groupBy(*keys, "_day").agg(F.sum("_step").alias("_step"))
    so_far = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, 0)
    open_runs = daily.select(
        *keys,
        F.date_from_unix_date("_day").alias("sale_date"),
        F.sum("_step").over(so_far).cast("int").alias("promos_30d"),
    )
    return df.join(open_runs, [*keys, "sale_date"], "left").fillna({"promos_30d": 0})
