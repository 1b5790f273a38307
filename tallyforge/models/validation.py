"""Fitting loops around Spark models: folds, searches, curves, ablations, leave-one-group-out.

Ridge and logistic models of all folds, groups or shares come from `linear`, which reads the rows once, or once per
Newton step, for all of them. The other families loop on the driver over a handful of fits; each fit and each prediction
is a Spark job. Callers hand in a stored frame (`session.stored`), so that a loop scans it and does not rebuild it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import key_hash
from ..operators import metrics as M
from ..operators.aggregates import fold_summary
from ..operators.resampling import group_fold_table
from ..session import stored
from . import linear as L
from .families import LABEL, Family
from .prep import feature_names, fit_preprocessor

FOLD = "fold"
MAX_GROUPS = 1_000


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_folds(df: DataFrame, group: str, folds: int, target: str | None) -> DataFrame:
    return df.join(group_fold_table(df, group, folds, target), group)


def fold_preprocessors(cut: DataFrame, groups: Mapping, folds: int) -> list[PipelineModel]:
    """One preprocessor per fold, learned on that fold's training rows; every trial of a search shares them."""
    return [fit_preprocessor(cut.filter(F.col(FOLD) != k), groups) for k in range(folds)]


def predictions_by_fold(
    cut: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, folds: int, weight: str | None = None,
    both_parts: bool = True, preps: Sequence[PipelineModel] | None = None,
) -> DataFrame:
    out = []
    for k in range(folds):
        model = family.fit(cut.filter(F.col(FOLD) != k), groups, params, target, weight, preps[k] if preps else None)
        rows = cut if both_parts else cut.filter(F.col(FOLD) == k)
        part = F.when(F.col(FOLD) == k, "validation").otherwise("train")
        out.append(family.predict(model, rows).withColumn("part", part).withColumn(FOLD, F.lit(k)))
    return _union(out)


def fold_predictions(
    df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, group: str, folds: int = 5,
    weight: str | None = None, both_parts: bool = True,
) -> DataFrame:
    """Predictions of every fold's model on its own validation rows and, when asked, on its training rows."""
    cut = stored(with_folds(df, group, folds, target if family.classifies else None), "folds")
    return predictions_by_fold(cut, groups, family, params, target, folds, weight, both_parts)


def fold_metrics(predicted: DataFrame, family: Family, target: str, weight: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Metrics per fold and part, all folds in one set of grouped jobs."""
    by = [FOLD, "part"]
    if family.classifies:
        return M.classification_report(predicted, target, "prediction", threshold, weight, by)
    return M.regression_metrics(predicted, target, "prediction", by)


def oof_predictions(
    df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, group: str, folds: int = 5, weight: str | None = None
) -> DataFrame:
    """Every row once, predicted by a model that saw no row of its group."""
    if family.name in ("ridge", "logistic"):
        cut = stored(with_folds(df, group, folds, target if family.classifies else None), "folds")
        return _linear_left_out(cut, groups, family, params, target, FOLD, weight)
    return fold_predictions(df, groups, family, params, target, group, folds, weight, both_parts=False).drop("part")


def _linear_left_out(df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, by: str, weight: str | None) -> DataFrame:
    if family.name == "ridge":
        return L.ridge_left_out(df, groups, target, by, params["alpha"], weight)
    return L.logistic_left_out(df, groups, target, by, params["c"], weight)


def summarise(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    return fold_summary(metrics, "part", names)


def temporal_backtest(
    train: DataFrame, test: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str,
    weight: str | None = None, threshold: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """Learn on one year, score the next: (metrics, predictions)."""
    if family.name == "logistic":
        basis, (model,) = L.fit_logistic(train, groups, target, params["c"], weight)
        predicted = stored(test.withColumn("prediction", L.logistic_probability(basis, model)), "backtest")
    else:
        predicted = stored(family.predict(family.fit(train, groups, params, target, weight), test), "backtest")
    if family.classifies:
        return M.classification_report(predicted, target, "prediction", threshold, weight), predicted
    return M.regression_metrics(predicted, target, "prediction"), predicted


def _search_predictions(
    cut: DataFrame, groups: Mapping, family: Family, drawn: Sequence[Mapping], target: str, folds: int, weight: str | None
) -> DataFrame:
    """Predictions of every trial and fold, on both parts."""
    preps = fold_preprocessors(cut, groups, folds)
    return _union([
        predictions_by_fold(cut, groups, family, params, target, folds, weight, preps=preps).select(
            F.lit(i).alias("trial"), FOLD, "part", F.col(target).cast("double").alias("y"), "prediction")
        for i, params in enumerate(drawn)
    ])


def random_search(
    df: DataFrame, groups: Mapping, family: Family, target: str, group: str, trials: int, folds: int = 5,
    weight: str | None = None, overrides: Mapping | None = None,
) -> DataFrame:
    """One row per trial: parameters and mean / deviation of the unweighted score over the folds, best first.

    The score is AUC for classes and minus MAE for levels. Fitting uses the weight, scoring does not. Logistic models of
    all trials and folds come from the same scans.
    """
    cut = stored(with_folds(df, group, folds, target if family.classifies else None), "folds")
    drawn = [{**family.draw(i), **(overrides or {})} for i in range(trials)]
    by = ["trial", FOLD, "part"]
    newton = family.name == "logistic" and not overrides
    predicted = None if newton else stored(_search_predictions(cut, groups, family, drawn, target, folds, weight), "search")
    if newton:
        basis, models = L.fit_logistic(cut, groups, target, [p["c"] for p in drawn], weight, FOLD)
        place = F.floor(F.col("model") / (len(models) // trials)).cast("int").alias("trial")
        scores = L.logistic_auc(cut, basis, models, target, FOLD).select(place, "part", F.col("auc").alias("score"))
    elif family.classifies:
        scores = M.ranking_metrics(predicted, "y", "prediction", by=by, names=("auc",)).withColumnRenamed("auc", "score")
    else:
        scores = predicted.groupBy(*by).agg((-F.avg(F.abs(F.col("prediction") - F.col("y")))).alias("score"))
    validation = F.when(F.col("part") == "validation", F.col("score"))
    means = scores.groupBy("trial").agg(
        F.avg(F.when(F.col("part") == "train", F.col("score"))).alias("mean_train"),
        F.avg(validation).alias("mean_validation"), F.stddev_pop(validation).alias("std_validation"),
    )
    rows = [(i, family.name, {k: float(v) for k, v in params.items()}) for i, params in enumerate(drawn)]
    tried = df.sparkSession.createDataFrame(rows, "trial int, family string, params map<string,double>")
    return tried.join(means, "trial").orderBy(F.desc("mean_validation"), "trial")


def best_params(search: DataFrame) -> dict:
    row = search.orderBy(F.desc("mean_validation"), "trial").first()
    whole = {"depth", "min_leaf", "trees", "rounds", "max_iter"}
    return {k: int(v) if k in whole else v for k, v in row["params"].items()}


def family_comparison(searches: Sequence[DataFrame]) -> DataFrame:
    """Best trial per family, its gap between train and validation, and the family that wins."""
    best = _union(list(searches)).groupBy("family").agg(
        F.max_by(F.struct("trial", "mean_train", "mean_validation", "std_validation"), "mean_validation").alias("b")
    ).select("family", "b.*", (F.col("b.mean_train") - F.col("b.mean_validation")).alias("gap"))
    return best.withColumn("chosen", F.col("mean_validation") == best.agg(F.max("mean_validation")).scalar())


def learning_curve(
    df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, group: str, keys: Sequence[str],
    shares: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 1.0), folds: int = 5,
) -> DataFrame:
    """Unweighted AUC on nested shares of each fold's training rows. Rows enter in hash order, not file order."""
    cut = with_folds(df, group, folds, target).withColumn("__spot", key_hash(list(keys), 42) / F.lit(float(2**60)))
    cut, parts = stored(cut, "curve"), []
    if family.name == "logistic":
        basis, models = L.fit_logistic(cut, groups, target, params["c"], None, FOLD, list(shares), "__spot")
        names = df.sparkSession.createDataFrame([(i, float(m.share)) for i, m in enumerate(models)], "model int, share double")
        scores = L.logistic_auc(cut, basis, models, target, FOLD, "__spot").join(names, "model")
        return scores.groupBy("share", "part").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))
    for share in shares:
        for k in range(folds):
            learn = cut.filter((F.col(FOLD) != k) & (F.col("__spot") < share))
            model = family.fit(learn, groups, params, target)
            rows = learn.withColumn("part", F.lit("train")).unionByName(cut.filter(F.col(FOLD) == k).withColumn("part", F.lit("validation")))
            parts.append(family.predict(model, rows).select(
                F.lit(float(share)).alias("share"), F.lit(k).alias(FOLD), "part", target, "prediction"))
    scored = stored(_union(parts), "curve-scores")
    scores = M.ranking_metrics(scored, target, "prediction", by=["share", FOLD, "part"], names=("auc",))
    return scores.groupBy("share", "part").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))


def ablation(
    df: DataFrame, variants: Mapping[str, Mapping], family: Family, params: Mapping, target: str, group: str, folds: int = 5,
    weight: str | None = None,
) -> DataFrame:
    """Out-of-fold AUC of each variant of the feature groups."""
    parts = [
        oof_predictions(df, groups, family, params, target, group, folds, weight).withColumn("variant", F.lit(name))
        for name, groups in variants.items()
    ]
    kept = [p.select("variant", target, "prediction", *([weight] if weight else [])) for p in parts]
    return M.ranking_metrics(stored(_union(kept), "ablation"), target, "prediction", weight, by=["variant"], names=("auc",))


def leave_one_group_out(
    df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, group: str, weight: str | None = None
) -> DataFrame:
    """Each group predicted by a model that never saw it; its one-hot columns are all zero there. Any number of groups
    for ridge, whose models are sums without a group; other families fit one after the other."""
    if family.name in ("ridge", "logistic"):
        return _linear_left_out(df, groups, family, params, target, group, weight)
    values = [r[0] for r in df.select(group).dropna().distinct().limit(MAX_GROUPS + 1).collect()]
    if len(values) > MAX_GROUPS:
        raise ValueError(f"one fit per group: more than {MAX_GROUPS} groups; use group folds")
    out = []
    for v in sorted(values):
        model = family.fit(df.filter(F.col(group) != v), groups, params, target, weight)
        out.append(family.predict(model, df.filter(F.col(group) == v)))
    return _union(out)


def _importances(model) -> list[float]:
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    return [abs(float(v)) for v in model.coefficients]


def recursive_elimination(
    df: DataFrame, groups: Mapping, family: Family, params: Mapping, target: str, keep: int = 15, step: float = 0.2
) -> DataFrame:
    """Drops the weakest features, a share of the original count per round, until `keep` are left: (variable, kept, round)."""
    prep = fit_preprocessor(df, groups)
    names = feature_names(prep)
    ready = prep.transform(df.withColumn(LABEL, F.col(target).cast("double"))).select("features", LABEL)
    alive, gone, drop, turn = list(range(len(names))), {}, max(1, int(step * len(names))), 0
    while len(alive) > keep:
        turn += 1
        sliced = VectorSlicer(inputCol="features", outputCol="sliced", indices=alive).transform(ready).select(F.col("sliced").alias("features"), LABEL)
        strength = _importances(family.build(sliced, params, None).fit(sliced))
        weakest = sorted(range(len(alive)), key=lambda i: (strength[i], names[alive[i]]))[: min(drop, len(alive) - keep)]
        for i in weakest:
            gone[alive[i]] = turn
        alive = [a for i, a in enumerate(alive) if i not in set(weakest)]
    rows = [(n, i not in gone, gone.get(i)) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "variable string, kept boolean, round int")


def subset_evaluation(
    train: DataFrame, test: DataFrame, groups: Mapping, family: Family, params: Mapping, level: str, target: str, hit: str,
    group: str, keys: Sequence[str], folds: int = 5,
) -> DataFrame:
    """Risk AUC of a level model on validation (out of fold) and on the test year, risk taken from its residuals."""
    oof = stored(oof_predictions(train, groups, family, params, level, group, folds), "subset-oof")
    residuals = oof.select((F.col(level) - F.col("prediction")).alias("r"))
    predicted = stored(family.predict(family.fit(train, groups, params, level), test), "subset-test")
    parts = []
    for name, rows in (("validation", oof.select(*predicted.columns)), ("test", predicted)):
        risk = M.risk_of_missing(rows, "prediction", target, residuals, "r", keys)
        parts.append(risk.select(F.lit(name).alias("part"), hit, (1.0 - F.col("risk")).alias("safe")))
    return M.ranking_metrics(_union(parts), hit, "safe", by=["part"], names=("auc",))
