"""Target encodings, target transforms, cross features."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.columns import log_target, not_negative
from shelfcast.operators.skew import quantiles
from shelfcast.settings import MAX_BROADCAST_ROWS, settle, settle_counted, tuning

ENCODED = ("sku", "store_id", "promo_type", "weekday", "month", "weighed")


def cross_features(df: DataFrame) -> DataFrame:
    pairs = {
        "sku_store": ("sku", "store_id"),
        "weekday_weighed": ("weekday", "weighed"),
        "promo_weighed": ("promo_active", "weighed"),
        "weekend_promo": ("is_weekend", "promo_active"),
    }
    return df.withColumns({n: F.concat_ws("_", F.col(a), F.col(b)) for n, (a, b) in pairs.items()})


def last_date(df: DataFrame) -> date:
    return df.agg(F.max("sale_date")).first()[0]


def split_date(df: DataFrame, days: int = 30) -> date:
    return last_date(df) - timedelta(days=days)


def train_test_split(
    df: DataFrame, days: int = 30, inclusive: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows up to the last date minus ``days``, and the rows after it.

    ``inclusive`` puts the split day itself into the training part. The split date is
    a literal, so both filters reach the scan.
    """
    at = F.lit(split_date(df, days))
    day = F.col("sale_date")
    return (df.where(day <= at), df.where(day > at)) if inclusive else (
        df.where(day < at), df.where(day >= at)
    )


def encoding_tables(
    train: DataFrame, features: Sequence[str], target: str
) -> tuple[dict[str, DataFrame], float | None]:
    """Mean target per value of each feature from one pass (grouping sets), and overall."""
    sets = [[f] for f in features] + [[]]
    # The value columns come out of the grouping sets as NULL where they take no part.
    means = train.groupingSets(sets, *features).agg(
        F.avg(target).alias("_mean"), F.grouping_id(*features).alias("_set")
    )
    means, rows = settle_counted(means, "encodings")
    small = rows <= tuning(train.sparkSession, MAX_BROADCAST_ROWS)
    codes = {f: 2 ** len(features) - 1 - 2 ** (len(features) - 1 - i) for i, f in enumerate(features)}
    tables = {
        f: means.where((F.col("_set") == codes[f]) & F.col(f).isNotNull()).select(
            f, F.col("_mean").alias(f"{f}_target_mean")
        )
        for f in features
    }
    overall = means.where(F.col("_set") == 2 ** len(features) - 1).first()
    tables = {f: F.broadcast(t) if small else t for f, t in tables.items()}
    return tables, overall["_mean"] if overall else None


def target_encoding(
    df: DataFrame,
    target: str = "net_sales",
    features: Sequence[str] = ENCODED,
    days: int = 30,
) -> DataFrame:
    """Category means learnt before the last ``days`` days; new categories get the overall mean."""
    features = [f for f in features if f in df.columns]
    train = df.where(F.col("sale_date") < F.lit(split_date(df, days)))
    return apply_encoding(df, *encoding_tables(train, features, target))


def apply_encoding(df: DataFrame, tables: dict[str, DataFrame], overall: float | None) -> DataFrame:
    for feature, table in tables.items():
        name = f"{feature}_target_mean"
        df = df.join(table, feature, "left")
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit(overall).cast("double")))
    return df


def upper_limit(df: DataFrame, target: str, q: float) -> float:
    return quantiles(df, [], target, {"q": q}).first()["q"]


def clip_target(c: Column, limit: float | None) -> Column:
    limit = F.lit(limit).cast("double")
    return F.when(c > limit, limit).otherwise(not_negative(c))


def winsorize_target(
    df: DataFrame, target: str = "net_sales", q: float = 0.995, source: DataFrame | None = None
) -> DataFrame:
    """Clip the target to [0, q-quantile]."""
    limit = upper_limit(source or df, target, q)
    return df.withColumn(target, clip_target(F.col(target), limit))


def add_log_target(df: DataFrame, target: str = "net_sales") -> DataFrame:
    return df.withColumn(f"log_{target}", log_target(F.col(target)))


# ---- Box-Cox -----------------------------------------------------------------

MIN_BOXCOX_ROWS = 100
# Exponents tried: step 0.1 over [-2, 2], then step 0.001 around the best.
COARSE = [i / 10 for i in range(-20, 21)]


def boxcox(x: Column, power: Column) -> Column:
    return F.when(power == 0, F.log(x)).otherwise((F.pow(x, power) - 1) / power)


def boxcox_fits(counts: DataFrame, powers: Sequence[float]) -> DataFrame:
    """Log-likelihood, mean and variance per exponent from (value, count) rows."""
    tried = counts.withColumn("power", F.explode(F.array(*[F.lit(p) for p in powers])))
    y, c = boxcox(F.col("v"), F.col("power")), F.col("c")
    sums = tried.groupBy("power").agg(
        F.sum("c").alias("n"),
        (F.sum(c * y) / F.sum("c")).alias("mean"),
        (F.sum(c * y * y) / F.sum("c")).alias("square"),
        F.sum(c * F.log("v")).alias("logs"),
    )
    variance = F.col("square") - F.col("mean") * F.col("mean")
    fit = -F.col("n") / 2 * F.log(variance) + (F.col("power") - 1) * F.col("logs")
    return sums.withColumns({"variance": variance, "fit": fit}).where("variance > 0")


def boxcox_power(df: DataFrame, target: str) -> tuple[float, float, float] | None:
    """Best exponent with the mean and deviation of the result; None with too few rows."""
    counts = settle(
        df.where((F.col(target) > 0) & (F.col("weighed") == 0))
        .groupBy(F.col(target).alias("v")).agg(F.count(F.lit(1)).alias("c")),
        "target",
    )
    rows = counts.agg(F.sum("c")).first()[0] or 0
    if rows <= MIN_BOXCOX_ROWS:
        return None
    powers = COARSE
    best = None
    for _ in range(2):
        best = boxcox_fits(counts, powers).orderBy(F.col("fit").desc(), "power").first()
        if best is None:
            return None
        centre = round(best["power"] * 1000)
        powers = [i / 1000 for i in range(centre - 100, centre + 101)]
    return best["power"], best["mean"], best["variance"] ** 0.5


def boxcox_target(df: DataFrame, target: str = "net_sales") -> DataFrame:
    """Standardised Box-Cox value of positive unit-goods targets; 0 for other rows."""
    found = boxcox_power(df, target)
    name = f"boxcox_{target}"
    if found is None:
        return df.withColumn(name, F.lit(0.0))
    power, mean, deviation = (F.lit(v) for v in found)
    value = (boxcox(F.col(target), power) - mean) / deviation
    chosen = (F.col(target) > 0) & (F.col("weighed") == 0)
    return df.withColumn(name, F.when(chosen, value).otherwise(0.0))
