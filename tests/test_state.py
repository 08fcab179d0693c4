"""Feature state against a full recompute; versions of stored folders."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.models import ensemble as E
from shelfcast.operators.frames import future_rows, union_history_future
from shelfcast.operators.target import last_date, train_test_split
from shelfcast.plans import jobs
from shelfcast.plans import state as S
from shelfcast.plans.features import OWN_TARGET, wide_features
from shelfcast.schema import GROUP, ORDER
from shelfcast.settings import settle
from shelfcast.sources import versions
from shelfcast.sources.fixture import Retail

PLACE = ["sku", "store_id", "sale_date"]


@pytest.fixture(scope="module")
def retail(spark):
    return Retail(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def history(retail):
    """A third of the lines in one group, gaps in target and price, and one group without any
    price in its last 150 rows."""
    moved = (F.col("receipt_id") + F.col("line_part")) % 3 == 0
    df = retail.loaded.withColumns(
        {
            "sku": F.when(moved, "hot").otherwise(F.col("sku")),
            "store_id": F.when(moved, "S0").otherwise(F.col("store_id")),
            "net_sales": F.when(F.col("line_no") != 4, F.col("net_sales")),
            "price": F.when((F.col("line_part") % 4 != 0) & ~(moved & (F.col("sale_date") > "1998-06-01")), F.col("price")),
        }
    )
    return settle(df, "history")


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    assert len(a) == len(b) > 0
    a, b = (x.sort_values(PLACE).reset_index(drop=True) for x in (a, b))
    for name in a.columns:
        pd.testing.assert_series_equal(a[name], b[name], check_dtype=False, rtol=1e-9, atol=1e-9)


def halves(df, how):
    side = {"rows": F.pmod(F.xxhash64(*ORDER), F.lit(2)) == 0, "days": F.col("sale_date") < "1997-01-01"}[how]
    return df.where(side), df.where(~side)


@pytest.mark.parametrize("how", [None, "rows", "days"])
def test_state_equals_recompute(retail, history, how):
    """From one state, or from two merged halves, cut across all groups or by day."""
    args = (retail.holidays, retail.promotions)
    if how:
        a, b = halves(history, how)
        state = S.FeatureState.build(a).merge(S.FeatureState.build(b))
    else:
        state = S.FeatureState.build(history)
    grid = settle(state.grid(*args, 3), "grid")
    got = S.grid_features(state, grid, *args)
    rows = settle(union_history_future(history, grid), "rows")
    want = future_rows(wide_features(rows, *args, exclude_current=True), last_date(history)).drop(*OWN_TARGET)
    assert set(got.columns) == set(want.columns)
    same(got.toPandas()[want.columns], want.toPandas())


def test_the_last_known_price_is_kept(history):
    state = S.FeatureState.build(history)
    hot = state.tail.where("sku = 'hot' and store_id = 'S0'")
    assert hot.count() == S.TAIL_ROWS + 1 and hot.where("price is not null").count() == 1
    sizes = state.tail.groupBy(*GROUP).count().agg(F.max("count")).first()[0]
    assert sizes <= S.TAIL_ROWS + 1


def test_forecast_reads_state_and_grid_only(spark, retail, history, tmp_path):
    S.FeatureState.build(history).save(spark, str(tmp_path))
    state = S.FeatureState.load(spark, str(tmp_path))
    args = (retail.holidays, retail.promotions)
    features = S.grid_features(state, state.grid(*args, 2), *args)
    read = set(features.inputFiles())
    assert read and not read & set(history.inputFiles())


def test_update_with_new_rows(spark, retail, history, tmp_path):
    """A day's new rows are merged into the stored state; it reads its own place and replaces it."""
    old, new = halves(history, "days")
    S.FeatureState.build(old).save(spark, str(tmp_path))
    state = S.update(spark, str(tmp_path), new)
    want = S.FeatureState.build(history)
    assert state.last_date() == want.last_date()
    assert state.values.exceptAll(want.values).isEmpty() and want.values.exceptAll(state.values).isEmpty()
    key = ["sku", "store_id", "receipt_id", "line_part", "line_supp", "line_no"]
    assert state.tail.select(*key).exceptAll(want.tail.select(*key)).isEmpty()
    assert state.tail.count() == want.tail.count()


def test_empty_history(spark, retail):
    state = S.FeatureState.build(retail.loaded.limit(0))
    grid = state.grid(retail.holidays, retail.promotions, 2)
    assert state.last_date() is None and grid.count() == 0
    assert S.grid_features(state, grid, retail.holidays, retail.promotions).count() == 0


# ---- versions ----------------------------------------------------------------


def test_readers_see_whole_versions(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        versions.current(spark, root)
    write = lambda n: lambda folder: spark.range(n).write.parquet(f"{folder}/t")
    first = versions.commit(spark, root, write(3))
    assert versions.current(spark, root) == first

    def slow(folder):
        write(5)(folder)
        assert versions.current(spark, root) == first  # a reader in the middle of a write
        assert spark.read.parquet(f"{versions.current(spark, root)}/t").count() == 3

    second = versions.commit(spark, root, slow)
    assert versions.current(spark, root) == second

    def broken(folder):
        write(7)(folder)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.commit(spark, root, broken)
    assert versions.current(spark, root) == second


def test_a_loaded_bundle_can_be_saved_in_place(spark, retail, tmp_path):
    frame = jobs.model_frame(retail.loaded, retail.holidays, retail.promotions)
    train, test = train_test_split(frame, 60)
    model = jobs.fit_ensemble(train, *jobs.wide_feature_lists(frame), kinds=("linear",))
    model.save(spark, str(tmp_path))
    back = E.Ensemble.load(spark, str(tmp_path))
    back.weights = (0.5,)
    back.save(spark, str(tmp_path))
    again = E.Ensemble.load(spark, str(tmp_path))
    assert again.weights == (0.5,)
    total = lambda m: m.predict(test).agg(F.sum("predicted")).first()[0]
    assert total(again) == pytest.approx(total(model) / 2)
    assert total(back) == pytest.approx(total(again))
