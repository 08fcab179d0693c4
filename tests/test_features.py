import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import frames, history, pricing, promo, quality, stores, target
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle
from shelfcast.sources.fixture import Retail
from shelfcast.streaming.messages import changes_only

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def retail(spark):
    return Retail(spark, SMALL)


@pytest.fixture(scope="module")
def skewed(spark, retail):
    """A third of the lines moved into one (SKU, store) group, with gaps in target and price."""
    moved = (F.col("receipt_id") + F.col("line_part")) % 3 == 0
    df = retail.loaded.withColumns(
        {
            "sku": F.when(moved, "hot").otherwise(F.col("sku")),
            "store_id": F.when(moved, "S0").otherwise(F.col("store_id")),
            "net_sales": F.when(F.col("line_no") != 4, F.col("net_sales")),
            "price": F.when(F.col("line_part") % 4 != 0, F.col("price")),
        }
    )
    return settle(df, "skewed")


@pytest.mark.parametrize("exclude", [False, True])
def test_rolling_over_small_batches(spark, skewed, exclude):
    """Batches that end inside groups and lists; no list of values per row."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        found = history.rolling(skewed, (3, 30), ["median", "count", "std", "max"], exclude_current=exclude)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        got = found.toPandas().sort_values(ORDER).reset_index(drop=True)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "collect_list" not in plan
    groups = got.groupby(GROUP)["net_sales"]
    for n in (3, 30):
        for stat in ("median", "count", "std", "max"):
            want = groups.transform(lambda s: getattr((s.shift() if exclude else s).rolling(n, min_periods=0 if stat == "count" else 1), stat)())  # noqa: B023
            want = want.fillna(0) if stat in ("std", "count") else want
            assert np.allclose(got[f"{stat}_{n}"].astype(float), want.astype(float), atol=1e-6, equal_nan=True), (stat, n)


def test_rolling_refuses_rows_out_of_order(spark):
    rows = spark.createDataFrame([(1.0, 1), (2.0, 3)], "v double, place int").coalesce(1)
    with pytest.raises(Exception, match="not in the order of their window"):
        rows.select(history.window_statistics([3], ["median"])("v", "place")).collect()


CUT = {
    "lags": history.lags,
    "rolling_stats": history.rolling_stats,
    "rolling_sum_count": history.rolling_sum_count,
    "price_change": pricing.price_change,
    "promo_share_30": promo.promo_share_30,
    "recent_promo_7": promo.recent_promo_7,
    "distinct_promos": promo.distinct_promos_30d,
    "trend_slope": history.trend_slope,
    "yoy_change": history.yoy_change,
    "anomalies": quality.anomaly_scores,
    "numbered": history.numbered,
    "previous_mean": history.previous_mean,
    "folds": frames.ts_folds,
    "quantile_scale": stores.weighed_quantile_scale,
}


@pytest.mark.parametrize("name", CUT)
def test_cut_groups_give_the_same_rows(spark, skewed, name):
    def run():
        pdf = CUT[name](skewed).toPandas().sort_values(ORDER).reset_index(drop=True)
        return pdf[sorted(pdf.columns)]

    plain = run()
    spark.conf.set("shelfcast.skew.hotRows", "150")
    try:
        cut = run()
    finally:
        spark.conf.unset("shelfcast.skew.hotRows")
    assert len(plain) == skewed.count()
    pd.testing.assert_frame_equal(plain, cut, check_dtype=False, atol=1e-9)


def test_changes_only_cut(spark, retail):
    events = retail.table("events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id"))
    )
    plain = {r["event_id"] for r in changes_only(events).collect()}
    spark.conf.set("shelfcast.skew.hotRows", "64")
    try:
        cut = {r["event_id"] for r in changes_only(events).collect()}
    finally:
        spark.conf.unset("shelfcast.skew.hotRows")
    assert plain == cut


def group(spark, values, price=None):
    rows = [
        (dt.date(2024, 1, 1) + dt.timedelta(i), i, 1, 1, 1, 1.0, 1.0, "a", "E1", v, p)
        for i, (v, p) in enumerate(zip(values, price or values))
    ]
    names = [*ORDER, "sku", "store_id", "net_sales", "price"]
    kinds = ["date", "bigint", "bigint", "bigint", "int", "double", "double", "string", "string", "double", "double"]
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def column(df, name):
    return [r[name] for r in df.orderBy(*ORDER).collect()]


def test_lags_fill_with_median(spark):
    got = history.lags(group(spark, [1.0, 5.0, 3.0]), [1, 2])
    assert column(got, "lag_1") == [3.0, 1.0, 5.0]
    assert column(got, "lag_2") == [3.0, 3.0, 1.0]


@pytest.mark.parametrize("exclude_current", [False, True])
def test_all_widths_from_one_list(spark, exclude_current):
    rng = np.random.default_rng(3)
    values = [None if rng.random() < 0.3 else float(rng.integers(0, 9)) for _ in range(130)]
    values[20:55] = [None] * 35
    stats = ["mean", "median", "max", "min", "std", "sum", "count"]
    got = history.rolling(group(spark, values), [3, 30, 90], stats, exclude_current=exclude_current)
    got = got.orderBy(*ORDER).toPandas()
    series = pd.Series(values, dtype=float)
    series = series.shift(1) if exclude_current else series
    for n in (3, 30, 90):
        ref = series.rolling(n, min_periods=1)
        for stat in stats:
            want = getattr(ref, stat)()
            if stat in ("count", "std"):
                want = want.fillna(0)
            name = {"mean": "ma"}.get(stat, stat) + f"_{n}"
            np.testing.assert_allclose(got[name].astype(float), want, atol=1e-9, err_msg=name)
    empty = history.rolling(group(spark, values).limit(0), [3], ["median"])
    assert empty.count() == 0


def test_rolling_with_gaps(spark):
    values = [4.0, None, 1.0, 9.0, None, None, None, 2.0]
    got = history.rolling(group(spark, values), [3], ["mean", "median", "count", "std", "max"])
    ref = pd.Series(values, dtype=float).rolling(3, min_periods=1)
    clean = lambda name: [np.nan if v is None else v for v in column(got, name)]
    for name, want in (("ma_3", ref.mean()), ("median_3", ref.median()), ("max_3", ref.max())):
        np.testing.assert_allclose(clean(name), want.to_numpy())
    np.testing.assert_allclose(clean("std_3"), ref.std().fillna(0).to_numpy())


def test_exclude_current(spark):
    got = history.rolling(group(spark, [4.0, 2.0, 6.0]), [2], ["mean"], exclude_current=True)
    assert column(got, "ma_2") == [None, 4.0, 3.0]


def test_price_change_fills_gaps(spark):
    got = pricing.price_change(group(spark, [1.0] * 5, [10.0, None, 20.0, 0.0, 5.0]))
    assert column(got, "price_change") == [0.0, 0.0, 1.0, -1.0, 0.0]


def test_slope_needs_three(spark):
    got = history.trend_slope(group(spark, [1.0, 2.0, 4.0, 5.0]))
    assert column(got, "trend_slope_7")[:2] == [0.0, 0.0]
    assert column(got, "trend_slope_7")[3] == pytest.approx(np.polyfit(range(4), [1, 2, 4, 5], 1)[0])


def test_anomalies_need_five_rows_and_constant_groups_have_none(spark):
    assert quality.anomalies(group(spark, [1.0, 1.0, 1.0, 99.0])).count() == 0
    assert quality.anomalies(group(spark, [3.0] * 40)).count() == 0
    assert quality.anomalies(group(spark, [1.0, 2.0] * 14 + [500.0])).count() == 1


def test_yoy_zero_before(spark):
    df = group(spark, [0.0, 4.0, 8.0]).withColumn("sale_date", F.lit("2024-01-01").cast("date"))
    assert column(history.yoy_change(df), "yoy_change") == [1.0, 1.0, 2.0]


def test_share_of_day_adds_up(retail):
    df = stores.store_day_activity(retail.sales.withColumn("net_sales", F.col("quantity")))
    sums = df.groupBy("store_id", "sale_date").agg(F.sum("store_day_share").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_folds_never_look_ahead(retail):
    folds = frames.ts_folds(retail.loaded, 3)
    spans = folds.groupBy("fold").agg(F.min("row_index").alias("lo"), F.max("row_index").alias("hi"))
    rows = spans.orderBy("fold").collect()
    assert [r["fold"] for r in rows] == [0, 1, 2, 3]
    assert all(a["hi"] + 1 == b["lo"] for a, b in zip(rows, rows[1:]))
    assert len({r["hi"] - r["lo"] for r in rows[1:]}) == 1


def test_target_encoding_new_category(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 6, 1)]
    df = spark.createDataFrame(
        [(days[0], "a", 2.0), (days[1], "a", 4.0), (days[2], "b", 100.0)],
        "sale_date date, sku string, net_sales double",
    )
    got = target.target_encoding(df, features=["sku"]).collect()
    assert {r["sku"]: r["sku_target_mean"] for r in got} == {"a": 3.0, "b": 3.0}


def test_boxcox_matches_a_dense_search(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.gamma(2.0, 5.0, 400) + 0.5, 1)
    df = spark.createDataFrame([(float(v), 0) for v in values] + [(0.0, 0), (9.0, 1)], "net_sales double, weighed int")
    power, mean, deviation = target.boxcox_power(df, "net_sales")
    grid = np.arange(-2, 2, 1e-3)
    grid = grid[np.abs(grid) > 1e-9]
    fits = [
        -len(values) / 2 * np.log(np.var((values**p - 1) / p)) + (p - 1) * np.log(values).sum()
        for p in grid
    ]
    assert abs(power - grid[int(np.argmax(fits))]) <= 0.0011
    out = target.boxcox_target(df).where("weighed = 0 and net_sales > 0").agg(
        F.avg("boxcox_net_sales"), F.stddev_pop("boxcox_net_sales")
    ).first()
    assert out[0] == pytest.approx(0, abs=1e-9) and out[1] == pytest.approx(1)
    few = target.boxcox_target(df.limit(50))
    assert few.agg(F.max(F.abs("boxcox_net_sales"))).first()[0] == 0.0


def test_batch_history_window(spark, retail):
    cases = spark.createDataFrame(
        [("c1", "Brand#2", "S3", dt.date(2000, 6, 1))], "case_id string, sku string, store_id string, sale_date date"
    )
    one = frames.history_tail(retail.loaded, "Brand#2", "S3", dt.date(2000, 6, 1), 90)
    assert frames.batch_history(cases, retail.loaded, 90).count() == one.count()
    assert set(GROUP) <= set(one.columns)


def test_last_attributes(retail):
    got = frames.last_attributes(retail.loaded, ["price", "quantity"]).toPandas().set_index("sku")
    pdf = retail.loaded.toPandas().sort_values(ORDER).groupby("sku").tail(1).set_index("sku")
    assert (got["price"].sort_index() == pdf["price"].sort_index()).all()


def test_wide_features_sort_groups_once(spark, retail):
    from shelfcast.plans.features import wide_features

    loaded = settle(retail.loaded, "loaded")
    df = wide_features(loaded, retail.holidays, retail.promotions)
    assert df.count() == loaded.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # One sort each for (sku, store), for the SKU's rows over stores, and for the day of the year.
    by_order = [line for line in plan.splitlines() if "Sort [" in line and "sale_date" in line]
    assert len(by_order) == 3
