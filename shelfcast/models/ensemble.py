"""Three regressors on the log target, their weights, and the stored bundle."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import not_negative
from shelfcast.models.staged import StagedForest, grow_forest
from shelfcast.operators.target import apply_encoding, encoding_tables
from shelfcast.sources import versions

MEMBERS = ("gbt", "forest", "linear")
DEFAULTS = {
    "gbt": {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 0.8},
    "forest": {"numTrees": 20, "maxDepth": 7, "subsamplingRate": 0.8},
    "linear": {"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.0},
}
SEED = 42
MAX_BINS = 128
LABEL = "_label"
WEIGHT_STEPS = 10


# ---- members -----------------------------------------------------------------

def regressor(kind: str, params: dict | None = None, validation: str | None = None):
    """A member by name; ``validation`` names the flag column for early stopping."""
    settings = {**DEFAULTS[kind], **(params or {})}
    common = {"featuresCol": "features", "labelCol": LABEL, "predictionCol": f"_{kind}"}
    if kind == "linear":
        return LinearRegression(**common, **settings)
    common |= {"seed": SEED, "maxBins": MAX_BINS}
    if kind == "forest":
        return RandomForestRegressor(**common, **settings)
    model = GBTRegressor(**common, **settings)
    return model.setValidationIndicatorCol(validation) if validation else model


def fit_member(
    kind: str, frame: DataFrame, params: dict | None = None, validation: str | None = None
):
    """Fit one member on a frame with ``features`` and the label.

    With ``validation`` (a flag column) the boosted member and the forest stop growing on the flagged rows. The
    linear member is solved in one step from the other rows; ``linear.path`` picks a penalty.
    """
    if validation and kind == "forest":
        return grow_forest(regressor(kind, params), frame, validation)
    if validation and kind == "linear":
        frame = frame.where(~F.col(validation))
    return regressor(kind, params, validation).fit(frame)


# ---- feature matrix ----------------------------------------------------------

@dataclass
class Preparation:
    """How rows become vectors: encodings, category codes, feature order."""

    features: list[str]
    categorical: list[str]
    encoded: list[str]
    model: PipelineModel
    encodings: dict[str, DataFrame] = field(default_factory=dict)
    overall: float | None = None

    def inputs(self) -> list[str]:
        codes = {c: f"{c}_code" for c in self.categorical}
        plain = [codes.get(f, f) for f in self.features if f not in self.encoded]
        return plain + [f"{f}_target_mean" for f in self.encoded]

    def apply(self, df: DataFrame) -> DataFrame:
        """Add ``features``; missing columns and missing values count as 0."""
        return self.model.transform(_complete(self._encode(df), self))

    def _encode(self, df: DataFrame) -> DataFrame:
        return apply_encoding(df, self.encodings, self.overall) if self.encodings else df


def _complete(df: DataFrame, prep: Preparation) -> DataFrame:
    names = [f for f in prep.features if f not in prep.encoded]
    names += [f"{f}_target_mean" for f in prep.encoded]
    have = set(df.columns)
    fixed = {}
    for name in names:
        if name in prep.categorical:
            fixed[name] = F.col(name).cast("string") if name in have else F.lit("0")
        else:
            fixed[name] = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in have else F.lit(0.0)
    return df.withColumns(fixed)


def prepare_matrix(
    train: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    target: str,
    encoded: Sequence[str] = ("sku", "store_id"),
) -> Preparation:
    """Learn encodings and category codes from the training rows only.

    Columns with many categories (``encoded``) become target means, because trees
    need a bin per category.
    """
    features = list(features)
    encoded = [f for f in encoded if f in features]
    categorical = [c for c in categorical if c in features and c not in encoded]
    prep = Preparation(features, categorical, encoded, PipelineModel([]))
    if encoded:
        prep.encodings, prep.overall = encoding_tables(train, encoded, target)
    stages = []
    if categorical:
        codes = [f"{c}_code" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=codes, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=prep.inputs(), outputCol="features"))
    prep.model = Pipeline(stages=stages).fit(_complete(prep._encode(train), prep))
    return prep


# ---- weights -----------------------------------------------------------------

def weight_grid(steps: int = WEIGHT_STEPS) -> list[tuple[float, float, float]]:
    """Every (w1, w2, w3) on the grid that sums to 1, first weight slowest."""
    return [
        (i / steps, j / steps, (steps - i - j) / steps)
        for i in range(steps + 1) for j in range(steps + 1 - i)
    ]


def weighted(members: Sequence[str], weights: Sequence[float]) -> Column:
    return sum((F.col(m) * F.lit(float(w)) for m, w in zip(members, weights)), F.lit(0.0))


def ensemble_weights(df: DataFrame, truth: str, members: Sequence[str]) -> DataFrame:
    """RMSE of every weighting, from one pass over the rows.

    Weights sum to 1, so the ensemble's error is the weighted sum of the members'
    errors, and its square needs only the mean product of every two errors.
    """
    errors = [F.col(m) - F.col(truth) for m in members]
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    products = df.agg(*[F.avg(errors[i] * errors[j]).alias(f"_{i}{j}") for i, j in pairs])
    rows = []
    for position, w in enumerate(weight_grid()):
        terms = [f"{(1 if i == j else 2) * w[i] * w[j]!r}D * _{i}{j}" for i, j in pairs]
        rows.append(
            f"struct({position} AS position, {w[0]!r}D AS w1, {w[1]!r}D AS w2, {w[2]!r}D AS w3, "
            f"sqrt(greatest(0D, {' + '.join(terms)})) AS rmse)"
        )
    return products.select(F.expr(f"inline(array({', '.join(rows)}))"))


def best_weights(table: DataFrame) -> tuple[float, float, float]:
    """The first of the weightings with the lowest RMSE."""
    best = table.orderBy(F.round("rmse", 12), "position").first()
    return best["w1"], best["w2"], best["w3"]


# ---- the bundle --------------------------------------------------------------

def member_columns(kinds: Sequence[str] = MEMBERS) -> list[str]:
    return [f"predicted_{k}" for k in kinds]


def ensemble_predict(
    df: DataFrame, weights: Sequence[float], members: Sequence[str], out: str = "predicted"
) -> DataFrame:
    """Weighted sum of member predictions on the natural scale."""
    return df.withColumn(out, weighted(members, weights))


@dataclass
class Ensemble:
    prep: Preparation
    members: dict
    weights: tuple[float, ...]
    params: dict
    log_target: bool = True
    deviations: list[float] = field(default_factory=list)

    def predict_members(self, df: DataFrame) -> DataFrame:
        df = self.prep.apply(df)
        for kind, model in self.members.items():
            df = model.transform(df)
            raw = F.col(f"_{kind}")
            natural = F.expm1(raw) if self.log_target else raw
            df = df.withColumn(f"predicted_{kind}", natural).drop(f"_{kind}")
        drop = ["features", *[f"{c}_code" for c in self.prep.categorical]]
        return df.drop(*drop, *[f"{f}_target_mean" for f in self.prep.encoded])

    def predict(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """Add member predictions and the ensemble's, never negative."""
        scored = self.predict_members(df)
        scored = ensemble_predict(scored, self.weights, member_columns(list(self.members)), out)
        return scored.withColumn(out, not_negative(F.col(out)))

    def importance(self, spark: SparkSession) -> DataFrame:
        return feature_importance(spark, self.prep.inputs(), self.members, self.deviations)

    # One folder holds the whole bundle, version by version.
    def save(self, spark: SparkSession, root: str) -> str:
        """Write a new version below ``root``. Until it is whole, readers get the one before; a
        loaded bundle can be saved to the place it came from."""
        return versions.commit(spark, root, lambda folder: self._write(spark, folder))

    def _write(self, spark: SparkSession, path: str) -> None:
        prep = self.prep
        prep.model.write().save(f"{path}/prepare")
        for kind, model in self.members.items():
            model.save(f"{path}/member-{kind}")
        for name, table in prep.encodings.items():
            table.write.parquet(f"{path}/encoding-{name}")
        facts = {
            "features": prep.features, "categorical": prep.categorical, "encoded": prep.encoded,
            "overall": prep.overall, "members": list(self.members), "weights": list(self.weights),
            "params": self.params, "log_target": self.log_target, "deviations": self.deviations,
            "blocks": {k: len(m.blocks) for k, m in self.members.items() if isinstance(m, StagedForest)},
        }
        rows = [(k, json.dumps(v)) for k, v in facts.items()]
        spark.createDataFrame(rows, "name string, value string").coalesce(1).write.parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, root: str) -> Ensemble:
        path = versions.current(spark, root)
        facts = {r["name"]: json.loads(r["value"]) for r in spark.read.parquet(f"{path}/facts").collect()}
        kinds = {
            "gbt": "GBTRegressionModel", "forest": "RandomForestRegressionModel",
            "linear": "LinearRegressionModel",
        }
        import pyspark.ml.regression as regression

        blocks = facts.get("blocks", {})
        members = {
            k: StagedForest.load(f"{path}/member-{k}", blocks[k], f"_{k}") if k in blocks
            else getattr(regression, kinds[k]).load(f"{path}/member-{k}")
            for k in facts["members"]
        }
        encodings = {f: spark.read.parquet(f"{path}/encoding-{f}") for f in facts["encoded"]}
        prep = Preparation(
            facts["features"], facts["categorical"], facts["encoded"],
            PipelineModel.load(f"{path}/prepare"), encodings, facts["overall"],
        )
        return Ensemble(
            prep, members, tuple(facts["weights"]), facts["params"], facts["log_target"],
            facts["deviations"],
        )


def feature_deviations(frame: DataFrame) -> list[float]:
    row = frame.agg(vector_to_array(Summarizer.std(F.col("features"))).alias("s")).first()
    return [float(v) for v in row["s"]]


def feature_importance(
    spark: SparkSession, names: Sequence[str], members: dict, deviations: Sequence[float]
) -> DataFrame:
    """Each member's importances scaled to sum 1, side by side, and their mean.

    A linear member counts |coefficient| x standard deviation of the feature.
    """
    columns = {}
    for kind, model in members.items():
        if kind == "linear":
            values = [abs(c) * s for c, s in zip(model.coefficients, deviations)]
        else:
            values = [float(v) for v in model.featureImportances.toArray()]
        total = sum(values) or 1.0
        columns[kind] = [v / total for v in values]
    rows = [
        (name, *[float(columns[k][i]) for k in members]) for i, name in enumerate(names)
    ]
    fields = ", ".join(f"{k}_importance double" for k in members)
    table = spark.createDataFrame(rows, f"feature string, {fields}")
    mean = sum((F.col(f"{k}_importance") for k in members), F.lit(0.0)) / len(members)
    return table.withColumn("mean_importance", mean).orderBy(
        F.col("mean_importance").desc(), "feature"
    )
