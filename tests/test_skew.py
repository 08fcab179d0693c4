import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.operators import skew
from shelfcast.operators.skew import attach, ordered, quantiles, running_sum, with_stats
from shelfcast.settings import settle


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows in one group, the rest spread over 40 groups."""
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 41, n))
    value = rng.integers(0, 50, n).astype(float)
    price = np.where(rng.random(n) < 0.9, np.nan, rng.integers(1, 9, n))
    pdf = pd.DataFrame({"k": key, "d": rng.integers(0, 60, n), "i": np.arange(n), "v": value})
    pdf["p"] = price
    df = spark.createDataFrame(pdf)
    return df.withColumn("p", F.when(~F.isnan("p"), F.col("p"))).coalesce(8)


def _windows(d, w):
    return d.withColumns(
        {
            "lag": F.lag("v", 20).over(w),
            "sum": F.sum("v").over(w.rowsBetween(-19, 0)),
            "fill": F.coalesce(
                F.last("p", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
                F.col("seed"),
            ),
        }
    )


def _pandas(df):
    return df.toPandas().sort_values("i").reset_index(drop=True)


@pytest.mark.parametrize("limit", ["16", "40", "200"])
def test_ordered_pieces_equal_plain_window(spark, rows, limit):
    plain = _pandas(ordered(rows, ["k"], ["d", "i"], _windows, 20, {"seed": "p"}))
    spark.conf.set("shelfcast.skew.hotRows", limit)
    try:
        split = _pandas(ordered(rows, ["k"], ["d", "i"], _windows, 20, {"seed": "p"}))
    finally:
        spark.conf.unset("shelfcast.skew.hotRows")
    pd.testing.assert_frame_equal(plain[sorted(plain)], split[sorted(split)])


def test_ordered_pieces_are_used(spark, rows, hot):
    plan = ordered(rows, ["k"], ["d", "i"], _windows, 20, {"seed": "p"})
    assert "_piece" in plan._jdf.queryExecution().toString()


def test_running_sum_pieces(rows, spark, hot):
    got = _pandas(running_sum(rows, ["k"], ["d", "i"], "v", "s"))
    ref = rows.toPandas().sort_values(["k", "d", "i"])
    ref["s"] = ref.groupby("k")["v"].cumsum()
    ref = ref.sort_values("i").reset_index(drop=True)
    assert np.allclose(got["s"], ref["s"])


@pytest.mark.parametrize("limit", [None, "20"])
def test_quantiles(spark, rows, limit):
    if limit:
        spark.conf.set("shelfcast.skew.hotRows", limit)
    try:
        got = quantiles(rows, ["k"], "v", {"a": 0.25, "b": 0.5, "c": 0.99}).toPandas()
        whole = quantiles(rows, [], F.col("v") * 1.5, {"m": 0.995}).first()["m"]
    finally:
        spark.conf.unset("shelfcast.skew.hotRows")
    pdf = rows.toPandas()
    ref = pdf.groupby("k")["v"].quantile([0.25, 0.5, 0.99]).unstack()
    got = got.set_index("k").sort_index()
    assert np.allclose(got[["a", "b", "c"]].to_numpy(), ref.to_numpy())
    assert np.isclose(whole, (pdf["v"] * 1.5).quantile(0.995))


def test_attach_without_broadcast(spark, rows):
    spark.conf.set("shelfcast.broadcast.maxRows", "1")
    try:
        df = with_stats(rows, ["k"], m=F.avg("v"))
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()
        got = _pandas(df)
    finally:
        spark.conf.unset("shelfcast.broadcast.maxRows")
    ref = rows.toPandas().sort_values("i").reset_index(drop=True)
    assert np.allclose(got["m"], ref.groupby("k")["v"].transform("mean"))


def test_attach_null_keys(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 5.0)], "k int, v double")
    got = {r["k"]: r["m"] for r in with_stats(df, ["k"], m=F.avg("v")).collect()}
    assert got == {1: 2.0, None: None}
    assert attach(df, df.groupBy("k").agg(F.max("v").alias("x")), ["k"]).count() == 2


@pytest.mark.parametrize("kind", ["many", "ties", "far"])
def test_narrowed_quantiles(spark, monkeypatch, kind):
    """Brackets narrow to the same values as counting them all, with and without keys."""
    rng = np.random.default_rng(5)
    values = {
        "many": rng.normal(size=20_000), "ties": rng.integers(0, 4, 20_000).astype(float),
        "far": rng.choice([-1.7e308, 1.7e308, 0.1, 1e-300], 20_000) * rng.choice([1, 0.5, 0.25], 20_000),
    }[kind]
    group = rng.choice(np.array(["a", "b", "c", None], object), 20_000, p=[0.7, 0.2, 0.09, 0.01])
    rows = [(g, float(v) if k % 50 else None) for k, (g, v) in enumerate(zip(group, values))]
    df = settle(spark.createDataFrame([*rows, ("empty", None), ("one", 3.0)], "g string, v double"))
    probs = {"low": 0.0, "q25": 0.25, "mid": 0.5, "q995": 0.995, "high": 1.0}
    want = {r["g"]: r for r in skew.quantiles(df, ["g"], "v", probs).collect()}
    whole = skew.quantiles(df, [], "v", probs).first()
    spark.conf.set("shelfcast.quantiles.narrowRows", "500")
    try:
        got = {r["g"]: r for r in skew.quantiles(df, ["g"], "v", probs).collect()}
        assert got == want and set(got) == {"a", "b", "c", None, "one"}
        assert skew.quantiles(df, [], "v", probs).first() == whole
        assert skew.quantiles(df.where("false"), ["g"], "v", probs).count() == 0
    finally:
        spark.conf.unset("shelfcast.quantiles.narrowRows")


def test_narrowing_shuffles_no_more_for_more_values(spark, monkeypatch):
    """Rows of the written tables stay alike while the distinct values grow tenfold."""
    written = []
    counted = skew.settle_counted

    def count(df, name="table"):
        table, rows = counted(df, name)
        written.append(rows)
        return table, rows

    monkeypatch.setattr(skew, "settle_counted", count)
    spark.conf.set("shelfcast.quantiles.narrowRows", "2000")
    sizes = []
    try:
        for rows in (40_000, 400_000):
            written.clear()
            df = spark.range(rows).selectExpr("rand(1) as v")
            skew.quantiles(settle(df), [], "v", {"mid": 0.5, "q99": 0.99})
            sizes.append(max(written))
    finally:
        spark.conf.unset("shelfcast.quantiles.narrowRows")
    assert max(sizes) <= 2000
