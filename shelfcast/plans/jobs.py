"""Whole jobs: training, evaluation, future forecast, scoring of cases and files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast import schema as S
from shelfcast.functions.columns import forecast_value, log_target
from shelfcast.models.ensemble import (
    LABEL,
    MEMBERS,
    Ensemble,
    best_weights,
    ensemble_weights,
    feature_deviations,
    fit_member,
    member_columns,
    prepare_matrix,
)
from shelfcast.models.linear import LeastSquares
from shelfcast.models.prepare import feature_columns
from shelfcast.models.search import search_params, trial_params
from shelfcast.operators import quality, summary
from shelfcast.operators.frames import batch_history, union_history_future
from shelfcast.operators.target import clip_target, split_date, train_test_split, upper_limit, winsorize_target
from shelfcast.plans.features import LEAN_FEATURES, OWN_TARGET, category_columns, lean_features, wide_features
from shelfcast.plans.state import FeatureState, grid_features
from shelfcast.settings import settle
from shelfcast.sources.files import write_result
from shelfcast.sources.load import join_holidays, join_promotions

NOT_FEATURES = [
    *S.ORDER[:5], "quantity", "returned_qty", "net_sales", "sku_store", "customer_card",
    "receipt_total", "certificate_total", *OWN_TARGET,
]
LEAN_CATEGORIES = ["promo_type", "promo_type_ext", "holiday_type"]
LEAN_ENCODED = ["sku", "store_id"]
VALIDATION_DAYS = 30


def model_features(loaded: DataFrame, holidays: DataFrame, promotions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features without the row's own target, not yet written, and the same rows with only what a preparation
    learns from: keys, target and text columns. ``loaded`` must be a written table."""
    features = wide_features(loaded, holidays, promotions, exclude_current=True)
    limit = upper_limit(loaded, "net_sales", 0.995)
    known = category_columns(loaded, promotions)
    return tuple(d.withColumn("net_sales", clip_target(F.col("net_sales"), limit)) for d in (features, known))


def model_frame(loaded: DataFrame, holidays: DataFrame, promotions: DataFrame) -> DataFrame:
    """Features without the row's own target, written once before any fitting."""
    loaded = settle(loaded, "loaded", "zstd")
    features = wide_features(loaded, holidays, promotions, exclude_current=True)
    return settle(winsorize_target(features, source=loaded), "frame", "zstd")


def wide_feature_lists(frame: DataFrame) -> tuple[list[str], list[str]]:
    numeric, categorical = feature_columns(frame, NOT_FEATURES)
    return numeric + categorical, categorical


def fit_ensemble(
    train: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    target: str = "net_sales",
    kinds: Sequence[str] = MEMBERS,
    params: dict | None = None,
    trials: int = 0,
    folds: int = 5,
    halving: int = 1,
) -> Ensemble:
    """Fit the members; weights come from the last days of the training rows.

    With ``trials`` each member's parameters are searched first (see ``search_params``).

    The test rows take no part: early stopping and weights use the validation slice.
    """
    params = dict(params or {})
    cut = split_date(train, VALIDATION_DAYS)
    is_late = F.col("sale_date") > F.lit(cut)
    prep = prepare_matrix(train.where(~is_late), features, categorical, target)
    # Only a search asks for the order of the rows.
    frame = prep.apply(train).select(
        *(S.ORDER if trials else []), target, "features", is_late.alias("_late"), log_target(F.col(target)).alias(LABEL)
    )
    frame = settle(frame, "matrix", "zstd")
    early = frame.where(~F.col("_late"))
    for kind in kinds if trials else ():
        _, params[kind] = search_params(early, kind, trial_params(kind, trials), folds, halving=halving)
    members = {k: fit_member(k, frame, params.get(k), "_late") for k in kinds}
    model = Ensemble(prep, members, (), params, True, feature_deviations(early))
    late = frame.where("_late").select("features", F.col(target).alias("_truth"))
    for kind, member in members.items():
        late = member.transform(late).withColumn(f"predicted_{kind}", F.expm1(f"_{kind}"))
    if len(kinds) == 3:
        model.weights = best_weights(ensemble_weights(late, "_truth", member_columns(kinds)))
    else:
        model.weights = tuple(1 / len(kinds) for _ in kinds)
    return model


def fit_lean(frame: DataFrame, target: str = "net_sales", params: dict | None = None) -> Ensemble:
    """One boosted model on the lean features, on the natural scale."""
    is_late = F.col("sale_date") > F.lit(split_date(frame, VALIDATION_DAYS))
    features = [f for f in LEAN_FEATURES if f not in ("receipt_total", "certificate_total", "customer_card")]
    prep = prepare_matrix(frame.where(~is_late), features, LEAN_CATEGORIES, target, LEAN_ENCODED)
    rows = prep.apply(frame).select(
        "features", is_late.alias("_late"), F.col(target).cast("double").alias(LABEL)
    )
    member = fit_member("gbt", settle(rows, "matrix", "zstd"), params, "_late")
    return Ensemble(prep, {"gbt": member}, (1.0,), {"gbt": params or {}}, log_target=False)


def lean_frame(loaded: DataFrame, holidays: DataFrame, promotions: DataFrame) -> DataFrame:
    loaded = settle(loaded, "loaded")
    features = lean_features(loaded, holidays, promotions, exclude_current=True)
    return settle(winsorize_target(features, q=0.99, source=loaded), "lean")


# ---- future forecast ---------------------------------------------------------

def forecast_from_state(
    model: Ensemble,
    state: FeatureState,
    holidays: DataFrame,
    promotions: DataFrame,
    days: int = 30,
) -> DataFrame:
    """Forecast per (SKU, store) and day for the ``days`` days after the state's last date.

    Reads the state and the grid only; the history is not needed.
    """
    features = grid_features(state, state.grid(holidays, promotions, days), holidays, promotions)
    return model.predict(features).select(
        "sale_date", "sku", "store_id",
        forecast_value(F.col("predicted"), F.col("weighed")).alias("forecast"),
    )


def forecast_future(
    model: Ensemble,
    loaded: DataFrame,
    holidays: DataFrame,
    promotions: DataFrame,
    days: int = 30,
) -> DataFrame:
    """The forecast for callers without a stored state: one pass over the history makes it."""
    state = FeatureState.build(loaded)
    return forecast_from_state(model, state, holidays, promotions, days)


# ---- scoring -----------------------------------------------------------------

def complete_cases(cases: DataFrame, holidays: DataFrame, promotions: DataFrame) -> DataFrame:
    """Cases with defaults for what may be left out: base price, promotion, discount, code."""
    have = set(cases.columns)
    given = cases.withColumns(
        {
            "base_price": F.coalesce("base_price", "price") if "base_price" in have else F.col("price"),
            "promo_id": F.coalesce("promo_id", F.lit(0)) if "promo_id" in have else F.lit(0),
            "_given": F.coalesce("discount_pct", F.lit(0.0)) if "discount_pct" in have else F.lit(0.0),
            "promo_code_used": F.col("promo_code").isNotNull().cast("int")
            if "promo_code" in have else F.lit(0),
        }
    ).drop("discount_pct", "promo_code")
    joined = join_promotions(join_holidays(given, holidays), promotions)
    return joined.withColumn("discount_pct", F.col("_given")).drop("_given")


def case_features(
    cases: DataFrame, loaded: DataFrame, holidays: DataFrame, promotions: DataFrame,
    days: int = 90,
) -> DataFrame:
    """Lean features of every case, computed on the case and its own history only."""
    cases = settle(cases, "given")
    full = complete_cases(cases, holidays, promotions).withColumn("_is_case", F.lit(True))
    past = batch_history(cases, loaded, days).withColumn("_is_case", F.lit(False))
    rows = settle(union_history_future(past, full), "cases")
    features = lean_features(rows, holidays, promotions, scope=["case_id"], exclude_current=True)
    return features.where("_is_case").drop("_is_case")


def batch_score(
    model: Ensemble, cases: DataFrame, loaded: DataFrame, holidays: DataFrame,
    promotions: DataFrame, days: int = 90,
) -> DataFrame:
    """The cases with their forecast."""
    cases = settle(cases, "given")
    features = case_features(cases, loaded, holidays, promotions, days)
    scored = model.predict(features, "forecast").select("case_id", "forecast")
    return cases.join(scored, "case_id", "left")


def score_rows(model: Ensemble | LeastSquares, rows: DataFrame, out: str = "forecast") -> DataFrame:
    """Score prepared feature rows, any number of them."""
    return model.predict(rows, out)


def score_csv(spark: SparkSession, model: Ensemble | LeastSquares, source: str, schema, path: str) -> None:
    """Read a feature CSV, append ``forecast``, write CSV."""
    rows = spark.read.schema(schema).option("header", True).csv(source)
    scored = score_rows(model, rows).select(*rows.columns, "forecast")
    write_result(scored, path)


# ---- the whole run -----------------------------------------------------------

def evaluate(model: Ensemble, test: DataFrame) -> DataFrame:
    return model.predict(test)


def run_forecast(
    loaded: DataFrame,
    holidays: DataFrame,
    promotions: DataFrame,
    folder: str,
    test_days: int = 30,
    forecast_days: int = 30,
    trials: int = 0,
    halving: int = 1,
) -> dict:
    """Train, store, evaluate, report and forecast; results are written below ``folder``."""
    spark = loaded.sparkSession
    loaded = settle(loaded, "loaded")
    frame = model_frame(loaded, holidays, promotions)
    train, test = train_test_split(frame, test_days)
    model = fit_ensemble(train, *wide_feature_lists(frame), trials=trials, halving=halving)
    model.save(spark, f"{folder}/model")
    state = FeatureState.build(loaded)
    state.save(spark, f"{folder}/state")
    scored = settle(evaluate(model, test), "scored")
    report = quality.report_table(
        scored, summary.season_weekday(frame), summary.season_month(frame),
        summary.season_holiday(frame), model.importance(spark), dict(zip(MEMBERS, model.weights)),
    )
    write_result(report, f"{folder}/report")
    write_result(quality.anomalies(frame), f"{folder}/anomalies", "parquet")
    if forecast_days > 0:
        future = forecast_from_state(model, state, holidays, promotions, forecast_days)
        write_result(future, f"{folder}/future_forecast")
    return {"model": model, "scored": scored, "report": report}

