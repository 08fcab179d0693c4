"""Feature selection, category codes and feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from shelfcast.functions.columns import finite
from shelfcast.operators.skew import attach, running_sum
from shelfcast.settings import settle


def align_features(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The features in model order; missing ones are 0."""
    have = set(df.columns)
    columns = [F.col(f) if f in have else F.lit(0).alias(f) for f in features if f not in keep]
    return df.select(*keep, *columns)


def drop_invalid(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL, NaN or infinite value in any of the columns."""
    floats = {"double", "float"}
    kinds = dict(df.dtypes)
    fixed = {c: finite(F.col(c)) for c in columns if kinds[c] in floats}
    return df.withColumns(fixed).dropna(subset=list(columns))


def index_categories(train: DataFrame, columns: Sequence[str]) -> StringIndexerModel:
    """Category codes learnt from the training rows; new categories share one extra code."""
    return StringIndexer(
        inputCols=list(columns), outputCols=[f"{c}_code" for c in columns], handleInvalid="keep"
    ).fit(train)


def category_codes(train: DataFrame, column: str) -> DataFrame:
    """(column, column_code): every label with its rank by number of rows (most first, then by name), from 0.

    No label reaches the driver. Labels with equal counts are numbered by a running sum whose large groups
    are cut into pieces; how many labels come before them is a table of one row per distinct count (at
    most the square root of twice the rows). Null is no label.
    """
    labels = train.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    labels = settle(labels.withColumn("_one", F.lit(1)), "labels")
    more = Window.orderBy(F.desc("_rows")).rowsBetween(Window.unboundedPreceding, -1)
    before = labels.groupBy("_rows").agg(F.count(F.lit(1)).alias("_labels"))
    before = before.select("_rows", F.coalesce(F.sum("_labels").over(more), F.lit(0)).alias("_before"))
    placed = attach(running_sum(labels, ["_rows"], [column], "_one", "_place"), before, ["_rows"])
    return placed.select(column, (F.col("_before") + F.col("_place") - 1).cast("double").alias(f"{column}_code"))


def apply_codes(df: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """``df`` with ``<column>_code`` for every column; new labels and null share one code after all others.

    Small code tables are broadcast; others are joined by shuffle with the rows on the left, where
    adaptive execution splits a hot label. Columns of these names are replaced.
    """
    for column, table in codes.items():
        code = f"{column}_code"
        table = settle(table, "codes")
        df = attach(df.drop(code), table, [column])
        df = df.withColumn(code, F.coalesce(F.col(code), F.lit(float(table.count()))))
    return df


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature names: every column of a usable type not excluded."""
    numeric, categorical = [], []
    for field in df.schema.fields:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, NumericType):
            numeric.append(field.name)
        elif isinstance(field.dataType, StringType):
            categorical.append(field.name)
    return numeric, categorical
