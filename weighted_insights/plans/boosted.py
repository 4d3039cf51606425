"""Boosted trees and forests as pipeline stages: estimators, and a model that scores, saves and loads."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.boosting import Growth, Tree, boost
from ..operators.forest import Forest, plant
from ..session import ship_package

#: What scoring needs of a tree; columns and cuts of binned rows are left out of a saved model.
SAVED = ("symmetric", "feature", "threshold", "left", "right", "value")


class BoostedTreesModel(Model, HasFeaturesCol, HasProbabilityCol, HasRawPredictionCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the margin, the probability of the positive class and the label it points to.

    Boosted trees add up to the margin; the trees of a forest (``average``) hold probabilities, whose mean is taken.
    """

    trees = Param(Params._dummy(), "trees", "starting margin and trees, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self, start: float = 0.0, trees: Sequence[Tree] = (), features: str = "features", average: bool = False):
        super().__init__()
        saved = [{name: value for name, value in asdict(tree).items() if name in SAVED} for tree in trees]
        self._set(trees=json.dumps({"start": start, "trees": saved, "average": average}), featuresCol=features)

    def setProbabilityCol(self, value: str) -> BoostedTreesModel:
        return self._set(probabilityCol=value)

    def setRawPredictionCol(self, value: str) -> BoostedTreesModel:
        return self._set(rawPredictionCol=value)

    def setPredictionCol(self, value: str) -> BoostedTreesModel:
        return self._set(predictionCol=value)

    def read_trees(self) -> tuple[float, list[Tree]]:
        held = json.loads(self.getOrDefault(self.trees))
        return held["start"], [Tree(**tree) for tree in held["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        start, trees = self.read_trees()
        average = json.loads(self.getOrDefault(self.trees))["average"]

        @F.pandas_udf("double")
        def margin(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for part in parts:
                x = np.stack(part.to_numpy()).T if len(part) else np.zeros((0, 0))
                total = np.full(len(part), start)
                for tree in trees if len(part) else ():
                    total += tree.score(x)
                if average:
                    # The margin of the mean, which stays finite.
                    mean = np.clip(total / max(len(trees), 1), 1e-12, 1 - 1e-12)
                    total = np.log(mean / (1 - mean))
                yield pd.Series(total)

        scored = dataset.withColumn("_margin", margin(vector_to_array(self.getFeaturesCol())))
        p = 1 / (1 + F.exp(-F.col("_margin")))
        return scored.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))),
                self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
                self.getPredictionCol(): (F.col("_margin") > 0).cast("double"),
            }
        ).drop("_margin")


class BoostedTrees(Estimator):
    """``groups`` are the one-hot ranges of the feature vector, ``row`` is a column that tells rows apart."""

    def __init__(
        self, growth: Growth, features: str = "features", label: str = "y", weight: str = "w", row: str | None = None, groups: Sequence[tuple[int, int]] = (), seed: int = 42
    ):
        super().__init__()
        self.growth, self.features, self.label, self.weight, self.row, self.groups, self.seed = growth, features, label, weight, row, tuple(groups), seed

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        start, trees = boost(dataset, self.growth, self.features, self.label, self.weight, self.row, self.groups, self.seed)
        return BoostedTreesModel(start, trees, self.features)


class RandomForest(Estimator):
    """Like :class:`BoostedTrees`, for a forest."""

    def __init__(
        self, forest: Forest, features: str = "features", label: str = "y", weight: str = "w", row: str | None = None, groups: Sequence[tuple[int, int]] = (), seed: int = 42
    ):
        super().__init__()
        self.forest, self.features, self.label, self.weight, self.row, self.groups, self.seed = forest, features, label, weight, row, tuple(groups), seed

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        trees = plant(dataset, self.forest, self.features, self.label, self.weight, self.row, self.groups, self.seed)
        return BoostedTreesModel(0.0, trees, self.features, average=True)
