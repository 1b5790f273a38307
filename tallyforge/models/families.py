"""Model families with the penalties of the usual textbook objectives, and their search spaces."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prep import fit_preprocessor
from .trees import BinnedTrees

SEED = 42
LABEL = "__label"


def uniform(*keys: object) -> float:
    """Number in [0, 1) from the hash of its keys, for draws made on the driver."""
    text = "|".join(str(k) for k in keys)
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 16**13


def log_uniform(low: float, high: float, u: float) -> float:
    return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))


@dataclass(frozen=True)
class Family:
    name: str
    classifies: bool
    build: Callable[[DataFrame, Mapping, str | None], Estimator]
    draw: Callable[[int], dict]

    def fit(
        self, train: DataFrame, groups: Mapping, params: Mapping, target: str, weight: str | None = None,
        prep: PipelineModel | None = None,
    ) -> PipelineModel:
        """Preprocessing and model as one object, learned on `train` only. `prep` must come from the same rows."""
        prep = prep or fit_preprocessor(train, groups)
        ready = prep.transform(train.withColumn(LABEL, F.col(target).cast("double"))).select(
            "features", LABEL, *([weight] if weight else [])
        )
        model = self.build(ready, params, weight).fit(ready)
        return PipelineModel([*prep.stages, model])

    def predict(self, model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Adds the probability of class 1, or the predicted level; the helper columns go."""
        out = model.transform(df)
        value = vector_to_array("probability")[1] if self.classifies else F.col("prediction")
        return out.select(*df.columns, value.alias(name))


def _weighted(estimator: Estimator, weight: str | None) -> Estimator:
    return estimator.setWeightCol(weight) if weight else estimator


def _logistic(ready: DataFrame, params: Mapping, weight: str | None) -> Estimator:
    total = ready.agg(F.sum(weight) if weight else F.count("*")).first()[0]
    return _weighted(LogisticRegression(
        labelCol=LABEL, maxIter=params.get("max_iter", 200), tol=params.get("tol", 1e-6), regParam=1.0 / (params["c"] * total),
        elasticNetParam=0.0, standardization=False,
    ), weight)


def _ridge(ready: DataFrame, params: Mapping, weight: str | None) -> Estimator:
    row = ready.agg(F.count("*").alias("n"), F.stddev_pop(LABEL).alias("s")).first()
    return _weighted(LinearRegression(
        labelCol=LABEL, solver="normal", regParam=params["alpha"] / row["n"] * (row["s"] or 0.0), elasticNetParam=0.0, standardization=False
    ), weight)


def _lasso(ready: DataFrame, params: Mapping, weight: str | None) -> Estimator:
    return _weighted(LinearRegression(
        labelCol=LABEL, regParam=params["alpha"], elasticNetParam=1.0, standardization=False, maxIter=500, tol=1e-10
    ), weight)


def _forest(kind: type) -> Callable:
    def build(ready: DataFrame, params: Mapping, weight: str | None) -> Estimator:
        options = {"trees": params.get("trees", 300), "depth": params["depth"], "min_leaf": params["min_leaf"], "features": params["features"]}
        plain = _weighted(kind(
            labelCol=LABEL, seed=SEED, numTrees=options["trees"], maxDepth=params["depth"],
            minInstancesPerNode=params["min_leaf"], featureSubsetStrategy=str(params["features"]),
        ), weight)
        return BinnedTrees(plain, False, kind is RandomForestClassifier, options, LABEL, weight, SEED)

    return build


def _boosted(kind: type) -> Callable:
    def build(ready: DataFrame, params: Mapping, weight: str | None) -> Estimator:
        options = {"trees": params.get("rounds", 600), "rate": params.get("rate", 0.03), "depth": params["depth"],
                   "min_leaf": params["min_leaf"], "rows": params["rows"], "features": params["features"]}
        plain = _weighted(kind(
            labelCol=LABEL, seed=SEED, maxIter=options["trees"], stepSize=options["rate"], maxDepth=params["depth"],
            minInstancesPerNode=params["min_leaf"], subsamplingRate=params["rows"], featureSubsetStrategy=str(params["features"]),
        ), weight)
        return BinnedTrees(plain, True, kind is GBTClassifier, options, LABEL, weight, SEED)

    return build


def _forest_space(i: int) -> dict:
    u = [uniform("forest", SEED, i, k) for k in range(3)]
    return {"depth": 4 + int(u[0] * 16), "min_leaf": 5 + int(u[1] * 95), "features": round(0.2 + 0.6 * u[2], 4)}


def _boosted_space(i: int) -> dict:
    u = [uniform("boosted", SEED, i, k) for k in range(4)]
    return {
        "depth": 3 + int(u[0] * 9), "min_leaf": 20 + int(u[1] * 280), "rows": round(0.6 + 0.4 * u[2], 4), "features": round(0.5 + 0.5 * u[3], 4),
    }


# Search spaces. Depths, leaf sizes, fractions and penalties cover the published ranges; the boosted trees
# grow by level, so they have no limit on leaves and no leaf penalty.
FAMILIES = {
    f.name: f
    for f in (
        Family("logistic", True, _logistic, lambda i: {"c": log_uniform(1e-3, 10.0, uniform("logistic", SEED, i))}),
        Family("forest", True, _forest(RandomForestClassifier), _forest_space),
        Family("boosted", True, _boosted(GBTClassifier), _boosted_space),
        Family("ridge", False, _ridge, lambda i: {"alpha": log_uniform(1e-2, 100.0, uniform("ridge", SEED, i))}),
        Family("lasso", False, _lasso, lambda i: {"alpha": (0.03, 0.1, 0.3, 1.0)[i % 4]}),
        Family("forest_level", False, _forest(RandomForestRegressor), _forest_space),
        Family("boosted_level", False, _boosted(GBTRegressor), _boosted_space),
    )
}


def coefficients(model: PipelineModel, names: Sequence[str]) -> dict[str, float]:
    return dict(zip(names, [float(v) for v in model.stages[-1].coefficients]))
