"""Preprocessing that learns from the training rows only, as stages of a Spark ML model.

Spark's Imputer takes an approximate median and its scaler the sample deviation, so the numeric part is
learned here (two aggregates for all columns) and written down as one SQL stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import medians

READY = "__x"
MISSING = "ausente_"
MAX_CATEGORIES = 10_000


def _number(v: float) -> str:
    return f"{float(v)!r}D"


def _clean(c: str) -> str:
    return f"nanvl(CAST(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE))"


def _logged(e: str) -> str:
    return f"CASE WHEN {e} IS NOT NULL THEN log1p(greatest({e}, 0.0D)) END"


def numeric_expressions(
    train: DataFrame, groups: Mapping[str, Sequence[str]], scale: bool = True, log_before_impute: bool = False
) -> dict[str, str]:
    """SQL of each numeric feature, learned on `train`.

    history: median, and an indicator for columns that miss values in train; log: median, then log1p (or the
    other way round); numbers: median. Then mean 0 and population deviation 1; a constant becomes 0.
    A column without any value in train has no feature.
    """
    history, log, numbers = (list(groups.get(g, ())) for g in ("history", "log", "numbers"))
    source = {c: _clean(c) for c in [*history, *log, *numbers]}
    if log_before_impute:
        source.update({c: _logged(_clean(c)) for c in log})
    columns = list(source)
    if not columns:
        return {}
    base = train.select(*[F.expr(e).alias(c) for c, e in source.items()])
    middle = medians(base, columns).first()
    gaps = base.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in history] or [F.lit(0).alias("none")]).first()

    made: dict[str, str] = {}
    for c in columns:
        if middle is None or middle[c] is None:
            continue
        filled = f"coalesce({source[c]}, {_number(middle[c])})"
        made[c] = f"log1p(greatest({filled}, 0.0D))" if c in log and not log_before_impute else filled
    for c in history:
        if gaps[c] > 0 and c in made:
            made[f"{MISSING}{c}"] = f"CAST({_clean(c)} IS NULL AS DOUBLE)"
    if not scale:
        return made
    stats = train.select(*[F.expr(e).alias(n) for n, e in made.items()]).agg(
        *[F.avg(n).alias(f"{n}__m") for n in made], *[F.stddev_pop(n).alias(f"{n}__s") for n in made]
    ).first()
    return {
        n: f"({e} - {_number(stats[f'{n}__m'])}) / {_number(stats[f'{n}__s'] or 1.0)}" for n, e in made.items()
    }


def fit_preprocessor(
    train: DataFrame, groups: Mapping[str, Sequence[str]], scale: bool = True, log_before_impute: bool = False,
    output: str = "features",
) -> PipelineModel:
    """Numeric stage, one-hot categories (an unseen category is all zeros) and the feature vector."""
    numeric = numeric_expressions(train, groups, scale, log_before_impute)
    stages = [
        SQLTransformer(statement="SELECT *, " + ", ".join(f"{e} AS `{n}{READY}`" for n, e in numeric.items()) + " FROM __THIS__")
    ] if numeric else []
    inputs = [f"{n}{READY}" for n in numeric]
    categories = list(groups.get("categories", ()))
    if categories:
        texts = SQLTransformer(statement="SELECT *, " + ", ".join(
            f"coalesce(CAST(`{c}` AS STRING), 'nan') AS `{c}__text`" for c in categories) + " FROM __THIS__")
        indexer = StringIndexer(
            inputCols=[f"{c}__text" for c in categories], outputCols=[f"{c}__code" for c in categories],
            handleInvalid="keep", stringOrderType="alphabetAsc",
        )
        ready = texts.transform(train)
        fitted = indexer.fit(ready)
        sizes = [len(labels) for labels in fitted.labelsArray]
        if max(sizes) > MAX_CATEGORIES:
            raise ValueError(f"more than {MAX_CATEGORIES} categories in one column")
        encoder = OneHotEncoder(
            inputCols=[f"{c}__code" for c in categories], outputCols=[f"{c}{READY}" for c in categories], dropLast=True
        ).fit(fitted.transform(ready))
        stages += [texts, fitted, encoder]
        inputs += [f"{c}{READY}" for c in categories]
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output))
    return PipelineModel(stages)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the entries of the feature vector: columns, missing indicators, then column_category."""
    labels: dict[str, list[str]] = {}
    names: list[str] = []
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            for c, values in zip(stage.getInputCols(), stage.labelsArray):
                labels[c.removesuffix("__text")] = list(values)
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                name = c.removesuffix(READY)
                names += [f"{name}_{v}" for v in labels[name]] if name in labels else [name]
    return names


def transformed_matrix(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Design matrix with one named column per feature."""
    from pyspark.ml.functions import vector_to_array

    prep = PipelineModel([s for s in model.stages if not hasattr(s, "predict")])
    out = prep.transform(df).select(*keep, vector_to_array("features").alias("v"))
    return out.select(*keep, *[F.col("v")[i].alias(n) for i, n in enumerate(feature_names(prep))])
