"""Calendar and holiday features."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions import columns as C
from shelfcast.operators.skew import attach

FAR = 999


def calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(C.calendar_parts(F.col("sale_date")))


def cyclic_time(df: DataFrame) -> DataFrame:
    return df.withColumns(C.cyclic_parts(F.col("sale_date")))


def month_edges(df: DataFrame) -> DataFrame:
    return df.withColumns(C.month_edges(F.col("sale_date")))


def sale_season(df: DataFrame) -> DataFrame:
    return df.withColumn("sale_season", C.sale_season(F.col("sale_date")))


def days_since_start(df: DataFrame, scope=(), source=None) -> DataFrame:
    """Days since the first date of the table (of the case, when scoring cases)."""
    if scope:
        starts = (source or df).groupBy(*scope).agg(F.min("sale_date").alias("_start"))
        df = attach(df, starts, scope)
    else:
        df = df.withColumn("_start", F.lit((source or df).agg(F.min("sale_date")).first()[0]))
    return df.withColumn("days_since_start", F.date_diff("sale_date", "_start")).drop("_start")


def _distance_table(days: DataFrame, keys: list[str]) -> DataFrame:
    """Per calendar day: days to the next and since the last holiday.

    Built from the holiday calendar alone: every holiday covers the days up to the
    next one, so no row of the sales is compared with any holiday.
    """
    w = Window.partitionBy(*keys).orderBy("h")
    spans = days.withColumn("next", F.lead("h").over(w))
    last_day = F.coalesce(F.date_sub("next", 1), F.col("h"))
    spread = spans.select(*keys, "h", "next", F.explode(F.sequence("h", last_day)).alias("sale_date"))
    return spread.select(
        *keys,
        "sale_date",
        F.when(F.col("sale_date") == F.col("h"), 0)
        .otherwise(F.date_diff("next", "sale_date")).alias("_to"),
        F.date_diff("sale_date", "h").alias("_since"),
    )


def holiday_distance(df: DataFrame, holidays: DataFrame) -> DataFrame:
    """Days to the next and since the previous holiday; 0 on the day, at most 999."""
    days = holidays.where(F.col("holiday_date").isNotNull()).select(
        F.col("holiday_date").alias("h")
    ).distinct()
    first, last = days.agg(F.min("h"), F.max("h")).first()
    df = attach(df, _distance_table(days, []), ["sale_date"])
    before = F.date_diff(F.lit(first), "sale_date")
    after = F.date_diff("sale_date", F.lit(last))
    return df.withColumns(
        {
            "days_to_holiday": _capped(F.coalesce("_to", F.when(before > 0, before))),
            "days_since_holiday": _capped(F.coalesce("_since", F.when(after > 0, after))),
        }
    ).drop("_to", "_since")


def holiday_distance_by_type(
    df: DataFrame, holidays: DataFrame, types: list[str] | None = None
) -> DataFrame:
    """Days to the next holiday of each type, one column per type."""
    days = holidays.where(
        F.col("holiday_date").isNotNull() & F.col("holiday_type").isNotNull()
    ).select(F.col("holiday_type").alias("type"), F.col("holiday_date").alias("h")).distinct()
    # One row per holiday type: a list of column names, not data.
    firsts = {r["type"]: r["h"] for r in days.groupBy("type").agg(F.min("h").alias("h")).collect()}
    types = sorted(firsts) if types is None else types
    table = _distance_table(days, ["type"]).groupBy("sale_date").pivot("type", types or [""])
    df = attach(df, table.agg(F.min("_to")), ["sale_date"])
    for name in types:
        before = F.date_diff(F.lit(firsts.get(name)).cast("date"), "sale_date")
        found = F.coalesce(F.col(f"`{name}`"), F.when(before > 0, before))
        df = df.withColumn(f"days_to_{name}", _capped(found)).drop(name)
    return df if types else df.drop("")


def _capped(c):
    return F.least(F.coalesce(c, F.lit(FAR)), F.lit(FAR))
