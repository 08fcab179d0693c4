import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog.forecasts import SMALL
from shelfcast.catalog.rows import cases
from shelfcast.models import ensemble as E
from shelfcast.models.prepare import align_features, index_categories
from shelfcast.models import search
from shelfcast.models.search import draw, search_params, trial_params
from shelfcast.operators.frames import ts_folds
from shelfcast.operators.target import train_test_split
from shelfcast.plans import jobs
from shelfcast.schema import ORDER
from shelfcast.settings import settle
from shelfcast.sources.fixture import Retail


@pytest.fixture(scope="module")
def retail(spark):
    return Retail(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def trained(retail):
    frame = jobs.model_frame(retail.loaded, retail.holidays, retail.promotions)
    train, test = train_test_split(frame, 60)
    lists = jobs.wide_feature_lists(frame)
    return jobs.fit_ensemble(train, *lists, params=SMALL), frame, train, test


def test_no_own_target_among_features(trained):
    model = trained[0]
    hidden = {"quantity", "net_sales", "returned_qty", "store_day_share", "yoy_change"}
    assert not hidden & set(model.prep.features)
    assert sum(model.weights) == pytest.approx(1)


def test_beats_a_constant(trained):
    model, _, train, test = trained
    mean = train.agg(F.avg("net_sales")).first()[0]
    scored = model.predict(test)
    row = scored.agg(
        F.avg(F.pow(F.col("net_sales") - F.col("predicted"), 2)).alias("m"),
        F.avg(F.pow(F.col("net_sales") - F.lit(mean), 2)).alias("c"),
        F.min("predicted").alias("low"),
    ).first()
    # The test tables hold random quantities, so a model can only come close to the mean.
    assert row["m"] < 1.25 * row["c"] and row["low"] >= 0


def test_same_seed_same_model(trained):
    model, frame, train, test = trained
    prep = model.prep.apply(train).withColumn(E.LABEL, F.log1p("net_sales"))
    a = E.fit_member("forest", prep, SMALL["forest"]).transform(model.prep.apply(test))
    b = E.fit_member("forest", prep, SMALL["forest"]).transform(model.prep.apply(test))
    both = a.select(*ORDER, F.col("_forest").alias("a")).join(
        b.select(*ORDER, F.col("_forest").alias("b")), ORDER
    )
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-6).count() == 0


def test_store_and_load(spark, trained, tmp_path):
    model, _, _, test = trained
    model.save(spark, str(tmp_path))
    back = E.Ensemble.load(spark, str(tmp_path))
    assert back.weights == model.weights and back.prep.features == model.prep.features
    before = {tuple(r[:5]): r[5] for r in model.predict(test).select(*ORDER[:5], "predicted").collect()}
    after = {tuple(r[:5]): r[5] for r in back.predict(test).select(*ORDER[:5], "predicted").collect()}
    assert before.keys() == after.keys()
    assert all(before[k] == pytest.approx(after[k]) for k in before)


def test_missing_features_and_new_categories(spark, trained):
    model = trained[0]
    rows = spark.createDataFrame([("new", "E99", "never")], "sku string, store_id string, promo_type string")
    assert model.predict(rows).first()["predicted"] >= 0


def test_importance_sums_to_one(spark, trained):
    table = trained[0].importance(spark)
    for kind in E.MEMBERS:
        assert table.agg(F.sum(f"{kind}_importance")).first()[0] == pytest.approx(1)


def test_weight_grid():
    grid = E.weight_grid()
    assert len(grid) == 66 and all(abs(sum(w) - 1) < 1e-9 for w in grid)


def test_best_weights_take_the_first_of_equals(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 5.0), (2.0, 2.0, 2.0, 0.0)], "y double, a double, b double, c double")
    table = E.ensemble_weights(df, "y", ["a", "b", "c"])
    assert table.count() == 66
    assert E.best_weights(table) == (0.0, 1.0, 0.0)


def test_search(trained):
    model, _, train, _ = trained
    frame = model.prep.apply(train).select(*ORDER, "features", F.log1p("net_sales").alias(E.LABEL))
    trials = trial_params("linear", 2)
    assert trials == trial_params("linear", 2)
    table, best = search_params(frame, "linear", trials, folds=2)
    assert table.count() == 4 and best in trials
    low, high, _ = (0.01, 0.1, "log")
    import random

    assert all(low <= draw({"s": (low, high, "log")}, random.Random(i))["s"] <= high for i in range(20))


def _search_frame(trained):
    model, _, train, _ = trained
    return settle(model.prep.apply(train).select(*ORDER, "features", F.log1p("net_sales").alias(E.LABEL)))


def _plain_loop(frame, kind, trials, folds):
    """Every trial on every fold, one after the other."""
    cut = settle(ts_folds(frame, folds))
    means = []
    for params in trials:
        scores = []
        for fold in range(1, folds + 1):
            model = E.fit_member(kind, cut.where(F.col("fold") < fold), params)
            error = F.expm1(f"_{kind}") - F.expm1(E.LABEL)
            scores.append(model.transform(cut.where(F.col("fold") == fold)).agg(F.sqrt(F.avg(error * error))).first()[0])
        means.append(sum(scores) / folds)
    return trials[means.index(min(means))], means


def test_search_side_by_side_equals_a_loop(trained):
    frame, trials = _search_frame(trained), trial_params("linear", 4)
    table, best = search_params(frame, "linear", trials, folds=3, parallel=4)
    want, means = _plain_loop(frame, "linear", trials, 3)
    assert best == want and table.count() == 12
    got = {r["trial"]: r["m"] for r in table.groupBy("trial").agg(F.avg("score").alias("m")).collect()}
    assert [got[n] for n in range(4)] == pytest.approx(means)


@pytest.mark.parametrize("kind", E.MEMBERS)
def test_halving_fits_less(trained, monkeypatch, kind):
    frame, fits = _search_frame(trained), []
    fit = search.fit_member
    monkeypatch.setattr(search, "fit_member", lambda *a: fits.append(1) or fit(*a))
    # Any of the bad trials loses on the first rung.
    bad = {"linear": {"regParam": 1e6}, "gbt": {"maxIter": 1, "stepSize": 0.01, "maxDepth": 1}, "forest": {"numTrees": 1, "maxDepth": 1}}[kind]
    good = {**trial_params(kind, 1)[0], **SMALL.get(kind, {}), **({"regParam": 1e-3} if kind == "linear" else {})}
    table, best = search_params(frame, kind, [bad, good, bad, bad], folds=4, halving=2)
    # Rungs: fold 1 for four trials, fold 2 for two, folds 3 and 4 for one.
    assert len(fits) == table.count() == 4 + 2 + 2 and best in (bad, good)
    last = [r["trial"] for r in table.where("fold = 4").collect()]
    assert len(last) == 1 and [bad, good, bad, bad][last[0]] == best


def test_rungs():
    assert search.rungs(5, 1) == [[1, 2, 3, 4, 5]]
    assert search.rungs(5, 2) == [[1], [2], [3, 4], [5]]
    assert search.rungs(9, 3) == [[1], [2, 3], [4, 5, 6, 7, 8, 9]]
    assert search.rungs(1, 2) == [[1]]


def test_failed_fit_is_raised(spark):
    def broken():
        raise ValueError("no")

    assert search.side_by_side(spark, [lambda n=n: n * n for n in range(9)], 3) == [n * n for n in range(9)]
    with pytest.raises(ValueError):
        search.side_by_side(spark, [lambda: 1, broken, lambda: 2], 2)


def test_forecast_future(trained, retail):
    model = trained[0]
    got = jobs.forecast_future(model, retail.loaded, retail.holidays, retail.promotions, 2)
    pairs = retail.loaded.select("sku", "store_id").distinct().count()
    rows = got.collect()
    assert len(rows) == 2 * pairs
    assert all(r["forecast"] is not None and r["forecast"] >= 0 for r in rows)


def test_batch_equals_single(spark, retail):
    lean = jobs.fit_lean(
        jobs.lean_frame(retail.loaded, retail.holidays, retail.promotions), params=SMALL["gbt"]
    )
    few = cases(retail).orderBy("case_id").limit(5).collect()
    table = spark.createDataFrame(few)
    args = (retail.loaded, retail.holidays, retail.promotions)
    whole = {r["case_id"]: r["forecast"] for r in jobs.batch_score(lean, table, *args).collect()}
    one = jobs.batch_score(lean, spark.createDataFrame(few[:1]), *args).first()
    assert len(whole) == 5 and whole[one["case_id"]] == pytest.approx(one["forecast"])
    assert all(v >= 0 for v in whole.values())


def test_align_and_index(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)], "k string, v double")
    assert align_features(df, ["x", "v"]).columns == ["x", "v"]
    codes = index_categories(df, ["k"]).transform(spark.createDataFrame([("a",), ("b",), ("zz",)], "k string"))
    assert [r["k_code"] for r in codes.collect()] == [0.0, 1.0, 2.0]


def test_case_defaults(spark, retail):
    rows = spark.createDataFrame(
        [("c", "Brand#2", "S3", dt.date(1998, 1, 7), 10.0)],
        "case_id string, sku string, store_id string, sale_date date, price double",
    )
    row = jobs.complete_cases(rows, retail.holidays, retail.promotions).first()
    assert (row["base_price"], row["promo_id"], row["discount_pct"], row["is_holiday"]) == (10.0, 0, 0.0, 1)


def test_matrix_holds_only_what_fits_read(spark, monkeypatch):
    """Order columns are written for a search only, and the files are packed harder than the session's."""
    rows = [(*[None] * 7, float(k)) for k in range(3)]
    kinds = ", ".join(f"{c} {'date' if c == 'sale_date' else 'double'}" for c in ORDER)
    train = spark.createDataFrame(rows, f"{kinds}, net_sales double").withColumn("sale_date", F.lit("2020-01-01").cast("date"))

    class Prepared:
        def apply(self, df):
            return df.withColumn("features", F.array("net_sales"))

    class Written(Exception):
        pass

    def written(df, *given):
        raise Written(df.columns, given)

    monkeypatch.setattr(jobs, "prepare_matrix", lambda *_: Prepared())
    monkeypatch.setattr(jobs, "settle", written)
    for trials, order in ((0, []), (1, ORDER)):
        with pytest.raises(Written) as seen:
            jobs.fit_ensemble(train, ["price"], [], trials=trials)
        assert seen.value.args == ([*order, "net_sales", "features", "_late", E.LABEL], ("matrix", "zstd"))


def test_written_tables_take_the_codec_they_are_given(spark):
    table = settle(spark.range(5), "packed", "zstd")
    assert all(".zstd." in file for file in table.inputFiles()) and table.count() == 5


def test_matrix_without_a_written_frame(spark, retail, monkeypatch):
    """Codes and encodings learnt beside the frame are those learnt from it, and no frame is written for them."""
    from shelfcast.catalog import forecasts

    monkeypatch.setattr(forecasts, "_kept", {})
    alone = forecasts.matrix(retail)
    assert [key[-1] for key in forecasts._kept] == ["matrix"]
    monkeypatch.setattr(forecasts, "_kept", {})
    forecasts.frame(retail)
    beside = forecasts.matrix(retail)
    plain = lambda d: sorted(map(repr, d.collect()))
    assert alone.dtypes == beside.dtypes and plain(alone) == plain(beside)
