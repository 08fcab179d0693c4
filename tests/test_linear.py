"""Least squares from Gram sums, and category codes, against numpy and plain counting."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.models import linear
from shelfcast.models.prepare import apply_codes, category_codes


def _rows(spark, n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(1e6, 3.0, (n, 3))  # far from 0: sums of raw products would lose digits
    x[:, 2] = x[:, 0] - 2 * x[:, 1]
    y = 2.0 + 0.5 * (x[:, 0] - 1e6) - 1.5 * (x[:, 1] - 1e6) + rng.normal(0, 0.1, n)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(5)


def test_fit_equals_numpy(spark):
    x, y, df = _rows(spark)
    got = linear.fit(df, ["a", "b"])
    want = np.linalg.lstsq(np.column_stack([x[:, :2] - 1e6, np.ones(len(x))]), y, rcond=None)[0]
    assert got.rows == len(x)
    assert got.coefficients == pytest.approx(want[:2].tolist(), abs=1e-6)
    centred = x[:, :2] - x[:, :2].mean(axis=0)
    z = centred / centred.std(axis=0)
    ridge = np.linalg.solve(z.T @ z / len(z) + 0.3 * np.eye(2), z.T @ (y - y.mean()) / len(z)) / centred.std(axis=0)
    assert linear.fit(df, ["a", "b"], ridge=0.3).coefficients == pytest.approx(ridge.tolist(), abs=1e-6)


def test_fit_odd_features(spark):
    _, _, df = _rows(spark)
    both = linear.fit(df, ["a", "b", "c"])  # c depends on a and b
    plain = linear.fit(df, ["a", "b"])
    score = lambda m: [r["forecast"] for r in m.score(df, log_target=False).orderBy("a").collect()]
    assert score(both) == pytest.approx(score(plain), abs=1e-4)
    odd = df.withColumn("one", F.lit(7.0)).unionByName(
        spark.createDataFrame([(None, 1.0, 1.0, 1.0, 7.0), (float("nan"), 1.0, 1.0, 1.0, 7.0)], "a double, b double, c double, label double, one double")
    )
    got = linear.fit(odd, ["a", "one", "b"])
    assert got.coefficients[1] == 0 and got.rows == 600
    assert [got.coefficients[0], got.coefficients[2]] == pytest.approx(plain.coefficients, abs=1e-9)
    empty = linear.fit(df.limit(0), ["a", "b"])
    assert empty.coefficients == [0.0, 0.0] and empty.intercept == 0.0


def test_table_and_score(spark):
    model = linear.LeastSquares(["a", "b"], [0.5, -1.0], 0.25, 3)
    back = linear.LeastSquares.of(model.table(spark))
    assert (back.coefficients, back.intercept) == (model.coefficients, model.intercept)
    rows = spark.createDataFrame([(1, 2.0, None, 9.0), (2, float("nan"), 1.0, 9.0)], "id int, a double, b double, forecast double")
    got = {r.id: r.forecast for r in back.score(rows).collect()}
    assert got[1] == pytest.approx(np.expm1(1.25)) and got[2] == 0.0
    assert back.score(rows.drop("a", "b"), log_target=False).first()["forecast"] == 0.25


def test_category_codes_equal_plain_counting(spark, hot):
    rng = np.random.default_rng(2)
    labels = [None if k % 50 == 0 else f"v{k % 400}" if k % 3 else "hot" for k in rng.integers(0, 3000, 4000).tolist()]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "id int, kind string").repartition(6)
    codes = category_codes(df, "kind")
    counts = Counter(v for v in labels if v is not None)
    want = {v: float(i) for i, v in enumerate(sorted(counts, key=lambda v: (-counts[v], v)))}
    assert {r.kind: r.kind_code for r in codes.collect()} == want
    new = spark.createDataFrame([(1, "hot"), (2, "never seen"), (3, None)], "id int, kind string")
    got = {r.id: r.kind_code for r in apply_codes(new, {"kind": codes}).collect()}
    assert got == {1: 0.0, 2: float(len(want)), 3: float(len(want))}
    assert apply_codes(new, {"kind": category_codes(df.limit(0), "kind")}).agg(F.max("kind_code")).first()[0] == 0.0


def test_path_errors_equal_scoring(spark):
    _, _, df = _rows(spark)
    train, late = df.where("a <= 1000001"), df.where("a > 1000001")
    best, errors = linear.path(train, late, ["a", "b"], [0.0, 0.5, 5.0])
    for ridge, error in errors:
        model = linear.fit(train, ["a", "b"], ridge=ridge)
        raw = late.select("label", model.value(late.columns).alias("p"))
        assert error == pytest.approx(raw.agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("p"), 2)))).first()[0], abs=1e-6)
    assert [e[0] for e in errors] == [5.0, 0.5, 0.0]
    assert best.coefficients == linear.fit(train, ["a", "b"]).coefficients
    assert np.isnan(linear.path(train, late.limit(0), ["a", "b"], [0.0, 0.5])[1][0][1])


def test_forest_grows_in_blocks(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler

    from shelfcast.models import staged
    from shelfcast.models.ensemble import LABEL, regressor

    _, _, df = _rows(spark, 300)
    frame = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.withColumnRenamed("label", LABEL))
    frame = frame.withColumn("_late", F.col("a") > 1000002).coalesce(1).cache()
    estimator = regressor("forest", {"numTrees": 7, "maxDepth": 3})
    model = staged.grow_forest(estimator, frame, "_late", block=2, patience=10)
    assert len(model.errors) == 4 and sum(model.sizes) <= 7
    assert len(model.blocks) == int(np.argmin(model.errors)) + 1
    late = frame.where("_late")
    got = model.transform(late)
    assert got.columns == [*late.columns, "_forest"]
    rmse = got.agg(F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col("_forest"), 2)))).first()[0]
    assert rmse == pytest.approx(min(model.errors))
    # Without patience growth ends at the first block that is not better.
    short = staged.grow_forest(estimator, frame, "_late", block=2, patience=1)
    first = next((k for k in range(1, 4) if model.errors[k] >= min(model.errors[:k])), 3)
    assert len(short.errors) == first + 1
    model.save(str(tmp_path / "forest"))
    back = staged.StagedForest.load(str(tmp_path / "forest"), len(model.blocks), "_forest")
    assert [r["_forest"] for r in back.transform(late).collect()] == [r["_forest"] for r in got.collect()]
    assert sum(staged.grow_forest(estimator, frame.where("not _late"), "_late", block=4).sizes) == 7
