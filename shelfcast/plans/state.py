"""Feature state: what a forecast needs of the history, in three tables that can be merged.

* ``tail``   - the last rows of every (SKU, store) group; windows look back no further.
* ``sums``   - sums and counts per (SKU, store, weighed); all means come from them.
* ``values`` - how often each target value stands in a SKU; medians come from it.

``merge(build(a), build(b))`` equals ``build(a + b)`` for any two sets of rows, so a day's new rows
update the state without reading the history again, and forecasting reads the state alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.functions.columns import ratio
from shelfcast.operators import dates, history, pricing, promo, stores, target
from shelfcast.operators.frames import union_history_future
from shelfcast.operators.skew import attach, average_rank, quantiles_of_counts, value_counts, with_stats
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle, settle_counted
from shelfcast.sources import versions
from shelfcast.sources.load import join_holidays, join_promotions

# The longest look-back: 90 rows, and one more for the change of a trend.
TAIL_ROWS = 91
KEYS = [*GROUP, "weighed"]
TARGET = "net_sales"


def _last_rows(df: DataFrame) -> DataFrame:
    """The last rows of each group, and the last known price if none of them has an earlier one.

    Spark keeps only the last rows of a group in every task before the shuffle (a rank with a
    limit), so a hot group costs no more than its tail per task.
    """
    backwards = Window.partitionBy(*GROUP).orderBy(*[F.col(c).desc() for c in ORDER])
    tail = df.withColumn("_back", F.row_number().over(backwards)).where(F.col("_back") <= TAIL_ROWS)
    tail = settle(tail.drop("_back"), "tail")
    place = F.struct(*ORDER)
    starts = tail.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"), F.min_by("price", place).alias("_price")
    )
    open_start = starts.where((F.col("_n") == TAIL_ROWS) & F.col("_price").isNull())
    unknown, count = settle_counted(open_start.select(*GROUP, "_first"), "unknown")
    if not count:
        return tail
    earlier = attach(df, unknown, GROUP).where((place < F.col("_first")) & F.col("price").isNotNull())
    spare = earlier.groupBy(*GROUP).agg(F.max_by(F.struct(*df.columns), place).alias("_row")).select("_row.*")
    return settle(tail.unionByName(spare), "tail")


def _mean_parts(name: str, value: Column) -> list[Column]:
    return [F.coalesce(F.sum(value), F.lit(0.0)).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]


MEANS = ("price", "discount", "sales", "on", "off")


def _sums(df: DataFrame) -> DataFrame:
    df, sales = pricing.discount(df), F.col(TARGET)
    state = lambda flag: F.when(F.col("promo_active") == flag, sales)
    parts = {
        "price": F.col("price"), "discount": F.col("discount_real"), "sales": sales,
        "on": state(1), "off": state(0),
    }
    return df.groupBy(*KEYS).agg(
        F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date"),
        *[c for name, value in parts.items() for c in _mean_parts(name, value)],
    )


def _add(sums: DataFrame, keys: list[str]) -> DataFrame:
    added = [F.sum(f"{m}_{part}").alias(f"{m}_{part}") for m in MEANS for part in ("sum", "n")]
    return sums.groupBy(*keys).agg(
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), *added
    )


def _mean(name: str) -> Column:
    return F.try_divide(F.col(f"{name}_sum"), F.col(f"{name}_n"))


@dataclass
class FeatureState:
    tail: DataFrame
    sums: DataFrame
    values: DataFrame

    @staticmethod
    def build(loaded: DataFrame) -> FeatureState:
        """State of loaded sales rows (any number; none gives an empty state)."""
        return FeatureState(
            _last_rows(loaded), settle(_sums(loaded), "sums"),
            settle(value_counts(loaded, ["sku"], TARGET), "values"),
        )

    def merge(self, other: FeatureState) -> FeatureState:
        """State of both sets of rows together; they must not share rows."""
        values = self.values.unionByName(other.values).groupBy("sku", "_v").agg(F.sum("_c").alias("_c"))
        return FeatureState(
            _last_rows(self.tail.unionByName(other.tail, allowMissingColumns=True)),
            settle(_add(self.sums.unionByName(other.sums), KEYS), "sums"),
            settle(values, "values"),
        )

    def save(self, spark: SparkSession, root: str) -> str:
        """Write a new version below ``root``; the one before stays current until it is whole."""

        def write(folder: str) -> None:
            for name in ("tail", "sums", "values"):
                getattr(self, name).write.parquet(f"{folder}/{name}")

        return versions.commit(spark, root, write)

    @staticmethod
    def load(spark: SparkSession, root: str) -> FeatureState:
        folder = versions.current(spark, root)
        return FeatureState(*[spark.read.parquet(f"{folder}/{n}") for n in ("tail", "sums", "values")])

    def last_date(self) -> date | None:
        return self.sums.agg(F.max("last_date")).first()[0]

    def grid(self, holidays: DataFrame, promotions: DataFrame, days: int = 30) -> DataFrame:
        """Every (SKU, store) pair on each of the ``days`` days after the last date, with the SKU's
        last attributes, no promotion, and the calendar."""
        last = F.lit(self.last_date()).cast("date")
        latest = F.max_by(F.struct("price", "base_price", "weighed"), F.struct(*ORDER))
        attributes = self.tail.groupBy("sku").agg(latest.alias("a")).select("sku", "a.*")
        span = F.sequence(F.date_add(last, 1), F.date_add(last, days))
        pairs = self.sums.select(*GROUP).distinct().withColumn("sale_date", F.explode(span))
        grid = pairs.join(attributes, "sku", "left").withColumn("promo_id", F.lit(0))
        return join_promotions(join_holidays(grid, holidays), promotions)


def update(spark: SparkSession, root: str, new_rows: DataFrame) -> FeatureState:
    """Merge new sales rows into the stored state and make the result the current version."""
    FeatureState.load(spark, root).merge(FeatureState.build(new_rows)).save(spark, root)
    return FeatureState.load(spark, root)


def grid_features(
    state: FeatureState, grid: DataFrame, holidays: DataFrame, promotions: DataFrame
) -> DataFrame:
    """Wide features of grid rows (after the state's last date, without a target).

    The same values as ``wide_features`` over the whole history and the grid, with the row's own
    target kept out, but for the report columns that need the row's own target.
    """
    grid = settle(grid, "grid")
    rows = union_history_future(
        state.tail.withColumn("_future", F.lit(False)), grid.withColumn("_future", F.lit(True))
    ).withColumn("_price_before", F.lit(None).cast("double"))
    values, size = settle_counted(state.values, "values")
    rows = settle(attach(rows, quantiles_of_counts(values, size, ["sku"], {"_median": 0.5}), ["sku"]), "rows")

    # A group has its tail and the grid's days, so one task holds any of them.
    w = Window.partitionBy(*GROUP).orderBy(*ORDER)
    df = history.lag_columns(rows, w, history.LAGS_WIDE, TARGET, "_median")
    stats = ["mean", "median", "max", "min", "std"]
    df = history.rolling_columns(df, w, history.WINDOWS_WIDE, stats, TARGET, exclude_current=True)
    df = history.slope_columns(df, w, TARGET, True)
    df = promo.recent_promo_columns(pricing.price_change_columns(df, w), w)
    df = promo.promo_share_30(df, source=rows).where("_future").drop("_future", "_median", "_price_before")

    # The grid's prices count in the means, as its rows would.
    own = _sums(grid.withColumn(TARGET, F.lit(None).cast("double")))
    sums = settle(_add(state.sums.unionByName(own), KEYS), "sums")
    df = _row_columns(df, sums, holidays, promotions)
    df = _mean_columns(df, sums, grid)
    return target.cross_features(history.trend_diff(df))


def _row_columns(df: DataFrame, sums: DataFrame, holidays: DataFrame, promotions: DataFrame) -> DataFrame:
    start = F.lit(sums.agg(F.min("first_date")).first()[0]).cast("date")
    df = dates.calendar(pricing.discount(df)).withColumn("days_since_start", F.date_diff("sale_date", start))
    df = dates.holiday_distance(promo.promo_lookup(df, promotions), holidays)
    df = dates.sale_season(dates.month_edges(dates.cyclic_time(df)))
    return dates.holiday_distance_by_type(df, holidays)


def _mean_columns(df: DataFrame, sums: DataFrame, grid: DataFrame) -> DataFrame:
    by_sku = _add(sums, ["sku"]).select("sku", _mean("price").alias("_price"), _mean("discount").alias("sku_mean_discount"))
    df = attach(df, by_sku, ["sku"])
    df = df.withColumn("price_vs_sku_mean", ratio(F.col("price"), F.col("_price"), 1)).drop("_price")
    # No row of the history lies on a day of the grid.
    df = with_stats(
        df, ["store_id", "sale_date"], grid, _price=F.avg("price"), promos_in_store_day=F.sum("promo_active")
    )
    df = df.withColumn("price_dev_store_day", F.col("price") - F.col("_price")).drop("_price")

    by_group = _add(sums, GROUP).select(*GROUP, _mean("on").alias("_on"), _mean("off").alias("_off"))
    df = attach(df, by_group, GROUP)
    active = F.col("promo_active")
    df = df.withColumns(
        {
            "promo_sales_mean": F.when(active == 1, F.col("_on")).when(active == 0, F.col("_off")),
            "promo_effectiveness": ratio(F.col("_on"), F.col("_off"), 1),
        }
    ).drop("_on", "_off")

    kind = ["weighed", "store_id"]
    by_kind = _add(sums, kind).select(*kind, _mean("sales").alias("weighed_group_mean"), _mean("price").alias("_price"))
    df = attach(df, by_kind, kind)
    df = stores.per_kind(df, "price_ratio", ratio(F.col("price"), F.col("_price"), 0)).drop("_price")
    means = _add(sums, ["store_id"]).select("store_id", _mean("sales").alias("_mean")).where("_mean is not null")
    ranks = means.withColumn("store_rank", average_rank("_mean")).drop("_mean")
    return attach(df, ranks, ["store_id"])
