"""Weighted metrics of a score against a 0/1 outcome, of a prediction against a level, and risk from residuals.

Ranking metrics come from `prefix_sums` over distinct scores; `by` gives the metric per group. A row with a
null outcome, score or weight takes no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import band_label, ratio
from .buckets import equal_width_bucket, quantile_bucket
from .ordered import average_ranks, prefix_sums


def _weight(weight: str | None) -> Column:
    return F.col(weight).cast("double") if weight else F.lit(1.0)


def score_sums(
    df: DataFrame, y: str, score: str, weight: str | None = None, by: Sequence[str] = (), edges: Sequence[float] | None = None
) -> DataFrame:
    """Per distinct score: weight of the positives and the negatives at it, below it and in total."""
    w, positive = _weight(weight), F.col(y) == 1
    known = df.filter(F.col(y).isNotNull() & w.isNotNull())
    return prefix_sums(
        known, score, {"pos": F.when(positive, w).otherwise(0.0), "neg": F.when(positive, 0.0).otherwise(w)}, by, edges
    )


def _ranking_aggregates() -> dict[str, Column]:
    pos, neg = F.col("pos"), F.col("neg")
    all_pos, all_neg = F.max("pos_total"), F.max("neg_total")
    won = F.sum(pos * (F.col("neg_before") + neg / 2.0))
    caught = F.col("pos_total") - F.col("pos_before")
    alarms = F.col("neg_total") - F.col("neg_before")
    precision = ratio(caught, caught + alarms)
    spread = ratio(caught, "pos_total") - ratio(alarms, "neg_total")
    return {
        "auc": ratio(won, all_pos * all_neg),
        "average_precision": ratio(F.sum(pos * F.coalesce(precision, F.lit(0.0))), all_pos),
        "ks": F.greatest(F.lit(0.0), F.max(spread)),
    }


def ranking_metrics(
    df: DataFrame, y: str, score: str, weight: str | None = None, by: Sequence[str] = (),
    names: Sequence[str] = ("auc", "average_precision", "ks"), edges: Sequence[float] | None = None,
) -> DataFrame:
    """AUC (ties at half), average precision (tied scores are one threshold) and KS from one set of prefix sums.

    AUC and KS are null when a group has one class only.
    """
    sums = score_sums(df, y, score, weight, by, edges)
    made = _ranking_aggregates()
    return sums.groupBy(*by).agg(*[made[n].alias(n) for n in names])


def roc_points(df: DataFrame, y: str, score: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per threshold (predict 1 when score >= threshold); the all-negative start (0, 0) is left implicit."""
    caught = F.col("pos_total") - F.col("pos_before")
    alarms = F.col("neg_total") - F.col("neg_before")
    return score_sums(df, y, score, weight, by).select(
        *by, F.col(score).alias("threshold"), ratio(alarms, "neg_total").alias("fpr"), ratio(caught, "pos_total").alias("tpr")
    )


def pr_points(df: DataFrame, y: str, score: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    caught = F.col("pos_total") - F.col("pos_before")
    alarms = F.col("neg_total") - F.col("neg_before")
    return score_sums(df, y, score, weight, by).select(
        *by, F.col(score).alias("threshold"), ratio(caught, caught + alarms).alias("precision"), ratio(caught, "pos_total").alias("recall")
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    """Rates of a confusion table; an empty denominator gives 0."""
    precision, recall = _or_zero(tp, tp + fp), _or_zero(tp, tp + fn)
    whole = tp + fp + fn + tn
    return [
        ratio(tp + tn, whole).alias("accuracy"), precision.alias("precision"), recall.alias("recall"),
        _or_zero(2 * precision * recall, precision + recall).alias("f1"),
        _or_zero(tn, tn + fn).alias("precision_negatives"), _or_zero(tn, tn + fp).alias("recall_negatives"),
        ratio(tp + fn, whole).alias("base_rate"),
    ]


def confusion_table(
    df: DataFrame, y: str, score: str, threshold: float = 0.5, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    w, called, true = _weight(weight), F.col(score) >= threshold, F.col(y) == 1

    def cell(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, w).otherwise(0.0)).alias(name)

    return df.dropna(subset=[y, score]).groupBy(*by).agg(
        cell(called & true, "tp"), cell(called & ~true, "fp"), cell(~called & true, "fn"), cell(~called & ~true, "tn")
    )


def confusion_metrics(
    df: DataFrame, y: str, score: str, threshold: float = 0.5, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    cells = confusion_table(df, y, score, threshold, weight, by)
    return cells.select(*by, F.lit(threshold).alias("threshold"), *rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")]))


def classification_report(
    df: DataFrame, y: str, score: str, threshold: float = 0.5, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Threshold rates beside AUC and average precision."""
    point = confusion_metrics(df, y, score, threshold, weight, by)
    rank = ranking_metrics(df, y, score, weight, by, names=("auc", "average_precision"))
    if by:
        return point.join(rank, list(by))
    return point.withColumn("auc", rank.select("auc").scalar()).withColumn(
        "average_precision", rank.select("average_precision").scalar()
    )


def threshold_grid(step: float = 0.02, low: float = 0.10, high: float = 0.90) -> list[float]:
    n = int(round((high - low) / step))
    return [round(low + i * step, 2) for i in range(n + 1)]


def threshold_sweep(df: DataFrame, y: str, score: str, weight: str | None = None, step: float = 0.02) -> DataFrame:
    """Confusion rates for every threshold of the grid.

    Rows are counted once by the number of thresholds they reach; cumulative sums over that short table
    (one row per threshold) give every confusion table. The scan does not grow with the grid.
    """
    grid = threshold_grid(step)
    splits = [float("-inf"), *grid, float("inf")]
    placed = Bucketizer(splits=splits, inputCol=score, outputCol="__reached").transform(df.dropna(subset=[y, score]))
    w, true = _weight(weight), F.col(y) == 1
    counts = (
        placed.groupBy(F.col("__reached").cast("int").alias("reached"))
        .agg(F.sum(F.when(true, w).otherwise(0.0)).alias("pos"), F.sum(F.when(true, 0.0).otherwise(w)).alias("neg"))
    )
    slots = df.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("reached"))
    filled = slots.join(counts, "reached", "left").na.fill(0.0, ["pos", "neg"])
    up = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = filled.select(
        "reached", F.sum("pos").over(up).alias("tp"), F.sum("neg").over(up).alias("fp"),
        F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"),
    ).filter("reached > 0")
    tp, fp = F.col("tp"), F.col("fp")
    threshold = F.element_at(F.array(*[F.lit(t) for t in grid]), F.col("reached"))
    return sums.select(threshold.alias("threshold"), *rates(tp, fp, F.col("p") - tp, F.col("n") - fp))


def operating_threshold(df: DataFrame, y: str, score: str, recall_negatives: float, weight: str | None = None) -> DataFrame:
    """Smallest threshold of the 0.01 grid that reaches the recall of class 0, else the largest."""
    sweep = threshold_sweep(df, y, score, weight, step=0.01)
    enough = F.min(F.when(F.col("recall_negatives") >= recall_negatives, F.col("threshold")))
    return sweep.agg(F.coalesce(enough, F.max("threshold")).alias("threshold"))


def brier(df: DataFrame, y: str, score: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    w, error = _weight(weight), F.col(score) - F.col(y)
    return df.dropna(subset=[y, score]).groupBy(*by).agg(ratio(F.sum(w * error * error), F.sum(w)).alias("brier"))


def calibration_curve(
    df: DataFrame, y: str, score: str, bands: int = 10, weight: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Weighted mean score and outcome per equal-width band; a band without rows is absent."""
    w = _weight(weight)
    band = equal_width_bucket(score, bands)
    sums = df.dropna(subset=[y, score]).groupBy(*by, band.alias("bucket")).agg(
        ratio(F.sum(w * F.col(score)), F.sum(w)).alias("predicted"),
        ratio(F.sum(w * F.col(y)), F.sum(w)).alias("observed"),
        F.count("*").alias("n"), F.sum(w).alias("weight"),
    )
    return sums.select(*by, band_label("bucket", bands).alias("band"), "predicted", "observed", "n", "weight")


def decile_calibration(df: DataFrame, y: str, score: str, weight: str | None = None, buckets: int = 10) -> DataFrame:
    w = _weight(weight)
    return quantile_bucket(df, score, buckets).groupBy("bucket").agg(
        ratio(F.sum(w * F.col(score)), F.sum(w)).alias("predicted"), ratio(F.sum(w * F.col(y)), F.sum(w)).alias("observed"),
        F.count("*").alias("n"),
    )


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Rank correlation of the rows where both values are known, average ranks on ties.

    Rows collapse to counts of distinct pairs before the ranks are joined.
    """
    by = list(by)
    both = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    rank_x = average_ranks(both, "x", by).select(*by, "x", F.col("rank").alias("rx"))
    rank_y = average_ranks(both, "y", by).select(*by, "y", F.col("rank").alias("ry"))
    pairs = both.groupBy(*by, "x", "y").agg(F.count("*").cast("double").alias("m"))
    r = pairs.join(rank_x, [*by, "x"]).join(rank_y, [*by, "y"])
    m, a, b = F.col("m"), F.col("rx"), F.col("ry")
    s = r.groupBy(*by).agg(
        F.sum(m).alias("n"), F.sum(m * a).alias("sa"), F.sum(m * b).alias("sb"),
        F.sum(m * a * b).alias("sab"), F.sum(m * a * a).alias("saa"), F.sum(m * b * b).alias("sbb"),
    )
    n = F.col("n")
    cov = F.col("sab") / n - F.col("sa") / n * F.col("sb") / n
    va = F.col("saa") / n - (F.col("sa") / n) * (F.col("sa") / n)
    vb = F.col("sbb") / n - (F.col("sb") / n) * (F.col("sb") / n)
    rho = F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb))
    return s.select(*by, n.cast("bigint").alias("n"), rho.alias("rho"))


def regression_metrics(df: DataFrame, y: str, prediction: str, by: Sequence[str] = (), rank: bool = True) -> DataFrame:
    """MAE, RMSE, R2, bias (prediction minus actual) and, when asked, the Spearman correlation."""
    known = df.dropna(subset=[y, prediction])
    e = F.col(prediction) - F.col(y)
    out = known.groupBy(*by).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1.0 - ratio(F.sum(e * e), F.var_pop(y) * F.count(y))).alias("r2"), F.avg(e).alias("bias"),
    )
    if not rank:
        return out
    rho = spearman(known, prediction, y, by)
    if by:
        return out.join(rho.select(*by, F.col("rho").alias("spearman")), list(by), "left")
    return out.withColumn("spearman", rho.select("rho").scalar())


def risk_of_missing(
    units: DataFrame, prediction: str, target: str, residuals: DataFrame, residual: str, keys: Sequence[str], name: str = "risk"
) -> DataFrame:
    """Share of residuals at or below the slack (target minus prediction); null without a slack.

    Residuals and slacks share one ordered sum, then each distinct slack is joined back by value.
    """
    slack = units.withColumn("__slack", F.col(target).cast("double") - F.col(prediction).cast("double") + F.lit(0.0))
    both = residuals.select((F.col(residual).cast("double") + F.lit(0.0)).alias("v"), F.lit(1).alias("r")).unionByName(
        slack.select(F.col("__slack").alias("v"), F.lit(0).alias("r"))
    )
    sums = prefix_sums(both, "v", {"r": F.col("r")})
    share = sums.select(F.col("v").alias("__slack"), ratio(F.col("r_before") + F.col("r"), "r_total").alias(name))
    return slack.join(share, "__slack", "left").drop("__slack")


def bias_corrected(units: DataFrame, prediction: str, bias: float) -> DataFrame:
    return units.withColumn(prediction, F.col(prediction) - F.lit(bias))


def missingness_auc(df: DataFrame, columns: Sequence[str], y: str, weight: str | None = None) -> DataFrame:
    """AUC of "the value is missing" per column, as max(auc, 1 - auc), all columns in one aggregate.

    Columns that never or always miss are left out.
    """
    w, true = _weight(weight), F.col(y) == 1
    aggs = [F.count("*").alias("__n"), F.sum(F.when(true, w)).alias("__p"), F.sum(F.when(~true, w)).alias("__q")]
    for i, c in enumerate(columns):
        gone = F.col(c).isNull()
        aggs += [
            F.count_if(gone).alias(f"m{i}"), F.sum(F.when(gone & true, w).otherwise(0.0)).alias(f"p{i}"),
            F.sum(F.when(gone & ~true, w).otherwise(0.0)).alias(f"q{i}"),
        ]
    row = df.agg(*aggs)
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("variable"), F.col(f"m{i}").alias("n_missing"),
            (0.5 + (ratio(f"p{i}", "__p") - ratio(f"q{i}", "__q")) / 2.0).alias("auc"),
        )
        for i, c in enumerate(columns)
    ])
    long = row.select("__n", F.explode(cells).alias("e")).select("__n", "e.*")
    return long.filter((F.col("n_missing") > 0) & (F.col("n_missing") < F.col("__n"))).select(
        "variable", "n_missing", F.greatest("auc", 1.0 - F.col("auc")).alias("auc_missing")
    )


def error_by_state(
    df: DataFrame, state: str, y: str, prediction: str, hit: str, score: str, total: str = "TOTAL"
) -> DataFrame:
    """Size, MAE, bias and AUC per state, and the same over all rows in a row named `total`."""
    e = F.col(prediction) - F.col(y)
    sums = df.groupingSets([[F.col(state)], []], F.col(state)).agg(
        F.grouping(state).alias("g"), F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias")
    ).select(F.when(F.col("g") == 1, total).otherwise(F.col(state)).alias(state), "n", "mae", "bias")
    each = ranking_metrics(df, hit, score, by=[state], names=("auc",))
    overall = ranking_metrics(df, hit, score, names=("auc",)).select(F.lit(total).alias(state), "auc")
    return sums.join(each.unionByName(overall), state, "left")
