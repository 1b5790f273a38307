"""The two training flows: area level with risk from residuals, and person class with weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..models import validation as V
from ..models.families import FAMILIES
from ..operators import metrics as M
from ..operators.resampling import stratified_sample
from ..session import stored
from ..sources.sinks import save_model


def area_flow(
    table: DataFrame, groups: Mapping, family: str, train_year: int, test_year: int, trials: int, folds: int,
    overrides: Mapping | None = None, model_path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Search and backtest on the train year; then a fit on the latest year with out-of-fold residuals.

    Returns (backtest metrics, residuals of the latest year).
    """
    kind = FAMILIES[family]
    known = stored(table.filter(F.col("hit_t").isNotNull() & F.col("indicator_t").isNotNull()), "area-train")
    train, test = known.filter(F.col("target_year") == train_year), known.filter(F.col("target_year") == test_year)
    search = V.random_search(train, groups, kind, "indicator_t", "area_id", trials, folds, overrides=overrides)
    params = V.best_params(search)

    oof = stored(V.oof_predictions(train, groups, kind, params, "indicator_t", "area_id", folds), "area-oof")
    residuals = oof.select((F.col("indicator_t") - F.col("prediction")).alias("r"))
    predicted = stored(kind.predict(kind.fit(train, groups, params, "indicator_t"), test), "area-test")
    metrics = M.regression_metrics(predicted, "indicator_t", "prediction")
    risk = M.risk_of_missing(predicted, "prediction", "target_t", residuals, "r", ["area_id"])
    safe = risk.select(F.col("hit_t").cast("int").alias("hit"), (1.0 - F.col("risk")).alias("safe"))
    auc = M.ranking_metrics(safe, "hit", "safe", names=("auc",)).select("auc").scalar()

    latest = V.oof_predictions(test, groups, kind, params, "indicator_t", "area_id", folds)
    out = latest.select("area_id", (F.col("indicator_t") - F.col("prediction")).alias("residual"))
    if model_path:
        final = kind.fit(test, groups, params, "indicator_t")
        save_model(final, model_path, {"family": family, "params": params, "target": "indicator_t", "train_year": test_year, "features": groups})
    return metrics.withColumn("risk_auc", auc), out


def person_flow(
    table: DataFrame, groups: Mapping, family: str, target: str, weight: str, keys: Sequence[str], train_year: int, test_year: int,
    sample_share: float, trials: int, folds: int = 3, overrides: Mapping | None = None, model_path: str | None = None,
) -> DataFrame:
    """Search on a stratified sample, weighted fit on all of the train year, weighted metrics of the test year."""
    kind = FAMILIES[family]
    train, test = table.filter(F.col("year") == train_year), table.filter(F.col("year") == test_year)
    sample = stored(stratified_sample(train, sample_share, target, keys), "person-sample")
    params = V.best_params(V.random_search(sample, groups, kind, target, "area_id", trials, folds, weight, overrides))
    model = kind.fit(train, groups, params, target, weight)
    if model_path:
        save_model(model, model_path, {"family": family, "params": params, "target": target, "features": groups})
    predicted = stored(kind.predict(model, test).select(*keys, target, weight, "prediction"), "person-test")
    return M.classification_report(predicted, target, "prediction", 0.5, weight)


def projection_ranking(
    units: DataFrame, residuals: DataFrame, residual: str, half_width: float, keys: Sequence[str], tie_break: str
) -> DataFrame:
    """Slack and risk of each unit without and with the between-year effect, ranked by the latter.

    `units` has prediction and target_t; the effect spreads every residual over equally spaced shifts.
    """
    from ..operators.ordered import rank_positions
    from ..operators.resampling import residual_smear

    plain = M.risk_of_missing(units, "prediction", "target_t", residuals, residual, keys, name="risk_plain")
    wide = residual_smear(residuals.select(residual), residual, half_width)
    both = M.risk_of_missing(plain, "prediction", "target_t", wide, residual, keys, name="risk")
    ranked = both.filter(F.col("risk").isNotNull()).withColumn("slack", F.col("target_t") - F.col("prediction"))
    return rank_positions(ranked, "risk", tie_break)


def baseline_vs_model(
    train: DataFrame, test: DataFrame, groups: Mapping, family: str, params: Mapping, level: str, target: str, hit: str,
    group: str, keys: Sequence[str], folds: int,
) -> DataFrame:
    """MAE and Spearman of the model, of the same model on a permuted level, and of predicting the mean, on the test year."""
    from ..operators.resampling import shuffled

    kind = FAMILIES[family]
    mixed = shuffled(train, level, keys, name="__mixed").drop(level).withColumnRenamed("__mixed", level)
    mean = train.agg(F.avg(level)).scalar()
    frames = []
    for name, rows in (("model", train), ("permuted", mixed)):
        frames.append(kind.predict(kind.fit(rows, groups, params, level), test).withColumn("source", F.lit(name)))
    frames = [stored(f, "baseline") for f in frames]
    frames.append(test.withColumn("prediction", mean).withColumn("source", F.lit("mean")).select(*frames[0].columns))
    out = M.regression_metrics(V._union(frames), level, "prediction", ["source"])
    oof = stored(V.oof_predictions(train, groups, kind, params, level, group, folds), "baseline-oof")
    residuals = oof.select((F.col(level) - F.col("prediction")).alias("r"))
    risk = [M.risk_of_missing(f, "prediction", target, residuals, "r", keys).select("source", hit, (1.0 - F.col("risk")).alias("safe")) for f in frames[:2]]
    return out.join(M.ranking_metrics(V._union(risk), hit, "safe", by=["source"], names=("auc",)), "source", "left")
