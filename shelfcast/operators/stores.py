"""Features by weighed/unit goods and by store."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio
from shelfcast.operators.skew import attach, average_rank, quantiles, with_stats

KINDS = {"unit": 0, "weighed": 1}


def weighed_group_mean(df: DataFrame, scope=(), source=None) -> DataFrame:
    df = with_stats(df, [*scope, "weighed", "store_id"], source, weighed_group_mean=F.avg("net_sales"))
    return df.withColumn(
        "weighed_group_ratio", ratio(F.col("net_sales"), F.col("weighed_group_mean"), 1)
    )


def weighed_price_ratio(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Price over the mean price of the store's weighed (unit) goods; 0 for the other kind."""
    df = with_stats(df, [*scope, "weighed", "store_id"], source, _mean=F.avg("price"))
    share = ratio(F.col("price"), F.col("_mean"), 0)
    return per_kind(df, "price_ratio", share).drop("_mean")


def weighed_quantile_scale(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Net sales scaled between the quartiles of the store's weighed (unit) goods."""
    keys = [*scope, "weighed", "store_id"]
    df = attach(df, quantiles(source or df, keys, "net_sales", {"_q25": 0.25, "_q75": 0.75}), keys)
    return per_kind(df, "sales_scale", between_quartiles(F.col("_q25"), F.col("_q75"))).drop("_q25", "_q75")


def between_quartiles(low: Column, high: Column) -> Column:
    width = high - low
    scaled = (F.col("net_sales") - low) / F.when(width == 0, 1.0).otherwise(width)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(scaled, F.lit(0.5))))


def per_kind(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumns(
        {
            f"{name}_{kind}": F.when(F.col("weighed") == flag, value).otherwise(0.0)
            for kind, flag in KINDS.items()
        }
    )


def store_day_activity(df: DataFrame, scope=(), source=None) -> DataFrame:
    df = with_stats(df, [*scope, "store_id", "sale_date"], source, store_day_sales=F.sum("net_sales"))
    return df.withColumn(
        "store_day_share", ratio(F.col("net_sales"), F.col("store_day_sales"), 0)
    )


def store_rank(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Percentile rank of the store's mean net sales among the stores."""
    return attach(df, store_ranks(source or df, scope), [*scope, "store_id"])


def store_ranks(df: DataFrame, scope=()) -> DataFrame:
    means = df.groupBy(*scope, "store_id").agg(F.avg("net_sales").alias("_mean"))
    return means.where(F.col("_mean").isNotNull()).withColumn("store_rank", average_rank("_mean", scope)).drop("_mean")


def sku_day_relative(df: DataFrame, scope=(), source=None) -> DataFrame:
    df = with_stats(df, [*scope, "sku", "sale_date"], source, _mean=F.avg("net_sales"))
    return df.withColumn(
        "sku_day_relative", ratio(F.col("net_sales"), F.col("_mean"), 1)
    ).drop("_mean")


def sku_mean(df: DataFrame, scope=(), source=None) -> DataFrame:
    return with_stats(df, [*scope, "sku"], source, sku_mean=F.avg("net_sales"))
