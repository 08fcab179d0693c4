"""Forests that grow block by block and stop on a validation slice."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.settings import settle

# Trees of one block, and blocks without a better validation error before growth ends.
BLOCK_TREES, PATIENCE = 5, 2


@dataclass
class StagedForest:
    """Blocks of trees; the prediction is the mean over all trees."""

    blocks: list[RandomForestRegressionModel]
    out: str
    errors: Sequence[float] = ()  # validation RMSE after each block that was grown

    @property
    def sizes(self) -> list[int]:
        return [b.getNumTrees for b in self.blocks]

    def transform(self, df: DataFrame) -> DataFrame:
        total, sizes = F.lit(0.0), self.sizes
        names = [f"_block_{i}" for i in range(len(sizes))]
        for block, name, size in zip(self.blocks, names, sizes):
            df = block.copy().setPredictionCol(name).transform(df)
            total = total + F.col(name) * size
        return df.withColumn(self.out, total / sum(sizes)).drop(*names)

    @property
    def featureImportances(self):
        """Mean over the blocks, by their trees, as a vector."""
        from pyspark.ml.linalg import Vectors

        parts = [b.featureImportances.toArray() for b in self.blocks]
        return Vectors.dense(np.average(parts, axis=0, weights=self.sizes))

    def save(self, path: str) -> None:
        for i, block in enumerate(self.blocks):
            block.save(f"{path}/block-{i}")

    @staticmethod
    def load(path: str, blocks: int, out: str) -> StagedForest:
        return StagedForest([RandomForestRegressionModel.load(f"{path}/block-{i}") for i in range(blocks)], out)


def grow_forest(
    estimator: RandomForestRegressor, frame: DataFrame, validation: str,
    block: int = BLOCK_TREES, patience: int = PATIENCE,
) -> StagedForest:
    """Grow up to ``numTrees`` trees on the rows where ``validation`` (a flag column) is not true.

    After each block the mean of all trees so far is scored on the flagged rows, from a running sum that is
    written once per block, so earlier blocks are not asked again. Growth ends when ``patience`` blocks in a
    row bring no lower error, and the forest with the lowest error is kept. Without flagged rows all
    trees are grown. Blocks take consecutive seeds, so the result is the same in every run.
    """
    label, out = estimator.getLabelCol(), estimator.getPredictionCol()
    early = frame.where(~F.coalesce(F.col(validation), F.lit(False)))
    late = frame.where(F.col(validation)).select(estimator.getFeaturesCol(), label).withColumn("_sum", F.lit(0.0))
    wanted, first, blocks, errors, trees = estimator.getNumTrees(), estimator.getSeed(), [], [], 0
    while trees < wanted:
        size = min(block, wanted - trees)
        model = estimator.copy().setNumTrees(size).setSeed(first + len(blocks)).setPredictionCol(out).fit(early)
        blocks.append(model)
        trees += size
        late = settle(
            model.transform(late).select(estimator.getFeaturesCol(), label, (F.col("_sum") + F.col(out) * size).alias("_sum")),
            "grown",
        )
        error = late.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col("_sum") / trees, 2)))).first()[0]
        if error is None:
            continue
        errors.append(float(error))
        if len(errors) - 1 - int(np.argmin(errors)) >= patience:
            break
    keep = int(np.argmin(errors)) + 1 if errors else len(blocks)
    return StagedForest(blocks[:keep], out, tuple(errors))
