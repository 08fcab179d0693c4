"""Forecast quality, anomalies, point lookups and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.skew import ordered, quantiles
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle

TINY = 1e-7
PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
TOLERANCES = (0.1, 0.2, 0.3)


def _pair(truth: str, predicted: str) -> tuple[Column, Column, Column]:
    t, p = F.col(truth), F.col(predicted)
    return t, p, F.abs(t - p)


def error_aggs(truth: str = "net_sales", predicted: str = "predicted") -> dict[str, Column]:
    t, p, error = _pair(truth, predicted)
    return {
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(error),
        "mapd": F.avg(F.abs((t - p) / (t + F.lit(TINY)))) * 100,
    }


def metric_aggs(truth: str = "net_sales", predicted: str = "predicted") -> dict[str, Column]:
    t, p, error = _pair(truth, predicted)
    both = error_aggs(truth, predicted)
    return {
        "rmse": both["rmse"],
        "mae": both["mae"],
        "mape": F.avg(F.when(t != 0, error / F.abs(t))) * 100,
        "smape": F.avg(2 * error / (F.abs(t) + F.abs(p) + F.lit(TINY))) * 100,
    }


def tolerance_aggs(truth: str = "net_sales", predicted: str = "predicted") -> dict[str, Column]:
    t, p, _ = _pair(truth, predicted)
    off = F.abs((t - p) / (t + F.lit(TINY)))
    return {
        f"within_{round(tol * 100)}": F.avg(F.when(off <= tol, 1.0).otherwise(0.0)) * 100
        for tol in TOLERANCES
    }


def _one_row(df: DataFrame, aggs: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(n) for n, c in aggs.items()])


def metrics(df: DataFrame, truth: str = "net_sales", predicted: str = "predicted") -> DataFrame:
    """RMSE, MAE, MAPE over non-zero truth, SMAPE: one row, one pass."""
    return _one_row(df, metric_aggs(truth, predicted))


def mapd(df: DataFrame, truth: str = "net_sales", predicted: str = "predicted") -> DataFrame:
    return df.agg(error_aggs(truth, predicted)["mapd"].alias("mapd"))


def error_percentiles(
    df: DataFrame, truth: str = "net_sales", predicted: str = "predicted"
) -> DataFrame:
    _, _, error = _pair(truth, predicted)
    errors = settle(df.select(error.alias("_error")), "errors")  # the quantiles read them several times
    return quantiles(errors, [], "_error", {f"error_p{round(q * 100)}": q for q in PERCENTILES})


def within_tolerance(
    df: DataFrame, truth: str = "net_sales", predicted: str = "predicted"
) -> DataFrame:
    """Share of rows (in percent) whose relative error is at most 10, 20, 30 %."""
    return _one_row(df, tolerance_aggs(truth, predicted))


def errors_by(
    df: DataFrame, key: str, truth: str = "net_sales", predicted: str = "predicted"
) -> DataFrame:
    """RMSE, MAE and MAPD per value of ``key``."""
    aggs = error_aggs(truth, predicted)
    return df.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()]).orderBy(key)


def row_errors(df: DataFrame, truth: str = "net_sales", predicted: str = "predicted") -> DataFrame:
    t, p, error = _pair(truth, predicted)
    return df.withColumns(
        {"abs_error": error, "rel_error": F.abs((t - p) / (t + F.lit(TINY))) * 100}
    )


def zero_safe_rows(df: DataFrame, truth: str = "net_sales") -> DataFrame:
    return df.where(F.col(truth) != 0)


def sku_errors(df: DataFrame, truth: str = "net_sales", predicted: str = "predicted") -> DataFrame:
    return df.groupBy("sku").agg(F.avg(_pair(truth, predicted)[2]).alias("mean_abs_error"))


def worst_skus(df: DataFrame, k: int = 10, **names) -> DataFrame:
    return sku_errors(df, **names).orderBy(F.col("mean_abs_error").desc(), "sku").limit(k)


def best_skus(df: DataFrame, k: int = 10, **names) -> DataFrame:
    return sku_errors(df, **names).orderBy("mean_abs_error", "sku").limit(k)


def worst_best_skus(df: DataFrame, k: int = 10, **names) -> DataFrame:
    worst = worst_skus(df, k, **names).withColumn("side", F.lit("worst"))
    return worst.unionByName(best_skus(df, k, **names).withColumn("side", F.lit("best")))


# ---- anomalies ---------------------------------------------------------------

def anomaly_scores(
    df: DataFrame, window: int = 30, target: str = "net_sales", min_rows: int = 5
) -> DataFrame:
    """Distance from the rolling mean in rolling standard deviations."""

    def score(d: DataFrame, w) -> DataFrame:
        frame = w.rowsBetween(1 - window, 0)
        enough = F.count(target).over(frame) >= min_rows
        d = d.withColumns(
            {
                "rolling_mean": F.when(enough, F.avg(target).over(frame)),
                "rolling_std": F.when(enough, F.stddev_samp(target).over(frame)),
            }
        )
        spread = F.when(F.col("rolling_std") == 0, 1.0).otherwise(F.col("rolling_std"))
        return d.withColumn("z_score", (F.col(target) - F.col("rolling_mean")) / spread)

    return ordered(df, GROUP, ORDER, score, window)


def anomalies(
    df: DataFrame, window: int = 30, threshold: float = 3.0, target: str = "net_sales"
) -> DataFrame:
    return anomaly_scores(df, window, target).where(F.abs("z_score") > threshold)


def anomaly_counts(found: DataFrame, k: int = 10) -> DataFrame:
    """Groups with the most anomalies."""
    counts = found.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("anomaly_count"))
    return counts.orderBy(F.col("anomaly_count").desc(), *GROUP).limit(k)


# ---- report ------------------------------------------------------------------

def as_section(df: DataFrame, section: str, label: str, values: list[str]) -> DataFrame:
    """A small table in long form: section, item, name, value."""
    pairs = [F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values]
    return df.select(
        F.lit(section).alias("section"),
        F.col(label).cast("string").alias("item"),
        F.inline(F.array(*pairs)),
    )


def report_table(
    scored: DataFrame,
    weekday: DataFrame,
    month: DataFrame,
    holiday: DataFrame,
    importance: DataFrame | None = None,
    weights: dict[str, float] | None = None,
    k: int = 5,
) -> DataFrame:
    """Everything the sales report shows, as one long table."""
    accuracy = _one_row(scored, {**metric_aggs(), **tolerance_aggs()})
    accuracy = accuracy.withColumn("item", F.lit("all"))
    season = ["mean_sales", "median_sales", "std_sales", "ratio"]
    parts = [
        as_section(accuracy, "accuracy", "item", [c for c in accuracy.columns if c != "item"]),
        as_section(weekday, "season_weekday", "weekday_name", season),
        as_section(month, "season_month", "month_name", season),
        as_section(holiday, "season_holiday", "period", ["mean_sales", "ratio"]),
        as_section(worst_skus(scored, k), "worst_skus", "sku", ["mean_abs_error"]),
        as_section(best_skus(scored, k), "best_skus", "sku", ["mean_abs_error"]),
    ]
    if importance is not None:
        top = importance.orderBy(F.col("mean_importance").desc(), "feature").limit(10)
        parts.append(as_section(top, "features", "feature", ["mean_importance"]))
    if weights:
        rows = [(name, float(w)) for name, w in weights.items()]
        table = scored.sparkSession.createDataFrame(rows, "member string, weight double")
        parts.append(as_section(table, "weights", "member", ["weight"]))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
