"""Ridge regression from one Gram-matrix aggregate, with its coefficients as a table.

Every task adds up the outer products of its rows (one matrix product per Arrow batch), Spark adds the
tasks' sums by position, and only the finished sums, one number per pair of features, reach the driver.
Scoring is a projection, so it stays in generated code and reaches any number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.columns import finite

INTERCEPT = "(intercept)"
# Variance below which a feature counts as constant, beside the square of its mean.
CONSTANT = 1e-12


def prepared(df: DataFrame, features: Sequence[str], target: str, label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, the features as finite doubles (missing columns and values are 0) and ln(1 + target).

    A target that is null, not finite or not above -1 gives a null label.
    """
    have = set(df.columns)
    value = finite(F.col(target).cast("double"))
    made = [
        (F.coalesce(finite(F.col(f).cast("double")), F.lit(0.0)) if f in have else F.lit(0.0)).alias(f) for f in features
    ]
    return df.select(*[k for k in keep if k not in features], *made, F.when(value > -1, F.log1p(value)).alias(label))


def gram(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, sums of products of the centred columns); rows with a null or a value that is not
    finite in any of the columns are left out."""
    columns, size = list(columns), len(columns)
    rows = df.select(*[finite(F.col(c).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]).dropna()
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"c{i}").alias(f"m{i}") for i in range(size)]).first()
    count = int(first["n"])
    if not count:
        return 0, np.zeros(size), np.zeros((size, size))
    # Means first: products of centred values lose no digits.
    means = np.array([first[f"m{i}"] for i in range(size)])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) - means
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["place", "x"])

    sums = rows.mapInArrow(products, "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(size * size)
    out[[r["place"] for r in sums]] = [r["x"] for r in sums]
    return count, means, out.reshape(size, size)


@dataclass
class LeastSquares:
    """label = intercept + sum of coefficient x feature."""

    features: list[str]
    coefficients: list[float]
    intercept: float
    rows: int

    def value(self, have: Sequence[str]) -> Column:
        """The prediction; features that are missing in ``have``, null or not finite count as 0."""
        terms = [
            F.coalesce(finite(F.col(f).cast("double")), F.lit(0.0)) * F.lit(c)
            for f, c in zip(self.features, self.coefficients) if f in have
        ]
        return sum(terms, F.lit(self.intercept))

    def score(self, df: DataFrame, out: str = "forecast", log_target: bool = True) -> DataFrame:
        """``df`` with the forecast on the natural scale, never negative; a column of that name is replaced."""
        raw = self.value(df.columns)
        return df.withColumn(out, F.greatest(F.expm1(raw) if log_target else raw, F.lit(0.0)))

    def predict(self, df: DataFrame, out: str = "forecast") -> DataFrame:
        """As the other models do it: the forecast for prepared rows."""
        return self.score(df, out)

    def table(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient), the intercept among them."""
        rows = [(INTERCEPT, self.intercept), *zip(self.features, self.coefficients)]
        return spark.createDataFrame(rows, "feature string, coefficient double")

    @staticmethod
    def of(table: DataFrame) -> LeastSquares:
        """The model of a stored coefficient table (one row per feature)."""
        found = {r["feature"]: r["coefficient"] for r in table.collect()}
        start = found.pop(INTERCEPT, 0.0)
        return LeastSquares(list(found), list(found.values()), start, 0)


def fit(df: DataFrame, features: Sequence[str], label: str = "label", ridge: float = 0.0) -> LeastSquares:
    """Least squares with a penalty of ``ridge`` on the coefficients of standardised features.

    Rows with a null or non-finite value are left out. Constant features get 0; of features that depend
    on each other the solution of least norm is taken; without rows all is 0.
    """
    return solve(features, *gram(df, [*features, label]), ridge)


def solve(features: Sequence[str], count: int, means: np.ndarray, sums: np.ndarray, ridge: float) -> LeastSquares:
    """The model of the sums that ``gram`` gives for the features and the label (last)."""
    features = list(features)
    if not count:
        return LeastSquares(features, [0.0] * len(features), 0.0, 0)
    inner, cross = sums[:-1, :-1], sums[:-1, -1]
    spread = np.sqrt(np.maximum(np.diag(inner) / count, 0.0))
    varies = spread**2 > CONSTANT * np.maximum(means[:-1] ** 2, CONSTANT)
    scale = np.where(varies, spread, 1.0)
    system = inner / np.outer(scale, scale) / count + ridge * np.eye(len(features))
    right = cross / scale / count
    found = np.zeros(len(features))
    if varies.any():
        found[varies] = np.linalg.lstsq(system[np.ix_(varies, varies)], right[varies], rcond=None)[0] / scale[varies]
    return LeastSquares(features, found.tolist(), float(means[-1] - means[:-1] @ found), count)


def path(
    train: DataFrame, late: DataFrame, features: Sequence[str], ridges: Sequence[float], label: str = "label"
) -> tuple[LeastSquares, list[tuple[float, float]]]:
    """The model of the penalty with the lowest error on the ``late`` rows (ties: the largest), and (penalty, RMSE)
    of all. Both sets of rows are read once: the errors too come from Gram sums. Without late rows the
    smallest penalty is taken and errors are NaN."""
    known = gram(train, [*features, label])
    count, means, sums = gram(late, [*features, label])
    found = []
    for ridge in sorted(ridges, reverse=True):
        model = solve(features, *known, ridge)
        v = np.append(-np.array(model.coefficients), 1.0)
        total = v @ sums @ v + count * (means @ v - model.intercept) ** 2
        found.append((model, ridge, float(np.sqrt(max(total, 0.0) / count)) if count else float("nan")))
    best = min(found, key=lambda f: f[2])[0] if count else found[-1][0]
    return best, [(ridge, error) for _, ridge, error in found]
