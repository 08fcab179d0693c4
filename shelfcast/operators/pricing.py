"""Price features."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio, real_discount
from shelfcast.operators.skew import ordered, with_stats
from shelfcast.schema import GROUP, ORDER


def discount(df: DataFrame) -> DataFrame:
    price, base = F.col("price"), F.col("base_price")
    return df.withColumns(
        {
            "discount_real": real_discount(price, base),
            "had_discount": F.coalesce((price < base).cast("int"), F.lit(0)),
        }
    )


def price_vs_sku_mean(df: DataFrame, scope=()) -> DataFrame:
    df = with_stats(df, [*scope, "sku"], _mean=F.avg("price"))
    return df.withColumn("price_vs_sku_mean", ratio(F.col("price"), F.col("_mean"), 1)).drop("_mean")


def price_dev_sku(df: DataFrame, scope=()) -> DataFrame:
    df = with_stats(df, [*scope, "sku"], _mean=F.avg("price"))
    return df.withColumn("price_dev_sku", F.col("price") - F.col("_mean")).drop("_mean")


def price_dev_store_day(df: DataFrame, scope=()) -> DataFrame:
    df = with_stats(df, [*scope, "store_id", "sale_date"], _mean=F.avg("price"))
    return df.withColumn("price_dev_store_day", F.col("price") - F.col("_mean")).drop("_mean")


def price_change_columns(d: DataFrame, w) -> DataFrame:
    """Relative change to the price one row before; gaps take the last known price."""
    known = F.last("price", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("_price", F.coalesce(known, F.col("_price_before")))
    change = F.try_divide(F.col("_price"), F.lag("_price").over(w)) - 1
    return d.withColumn("price_change", F.coalesce(change, F.lit(0.0))).drop("_price")


def price_change(df: DataFrame, scope=()) -> DataFrame:
    return ordered(
        df, [*scope, *GROUP], ORDER, price_change_columns, 1, {"_price_before": "price"}
    )
