import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import metrics as M
from tallyforge.operators import resampling as RS
from tallyforge.operators import stats as X


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def pairwise_auc(y, s, w):
    y, s, w = map(np.asarray, (y, s, w))
    p, n = y == 1, y == 0
    wins = (s[p][:, None] > s[n][None, :]) + 0.5 * (s[p][:, None] == s[n][None, :])
    return float((w[p][:, None] * w[n][None, :] * wins).sum() / (w[p].sum() * w[n].sum()))


def test_known_confusion(spark):
    df = frame(spark, y=[0, 0, 1, 1, 1, 0], p=[0.1, 0.6, 0.8, 0.4, 0.9, 0.2])
    r = M.confusion_metrics(df, "y", "p").first()
    assert (r.accuracy, r.precision, r.recall, r.recall_negatives, r.base_rate) == pytest.approx((4 / 6, 2 / 3, 2 / 3, 2 / 3, 0.5))
    empty = M.confusion_metrics(df, "y", "p", threshold=2.0).first()
    assert (empty.precision, empty.recall, empty.f1) == (0.0, 0.0, 0.0)


def test_auc_with_ties_and_weights(spark):
    rng = np.random.default_rng(0)
    y, s, w = rng.integers(0, 2, 400), np.round(rng.random(400), 1), rng.random(400) + 0.1
    r = M.ranking_metrics(frame(spark, y=y, s=s, w=w), "y", "s", "w").first()
    assert r.auc == pytest.approx(pairwise_auc(y, s, w))
    order = np.argsort(-s, kind="stable")
    cut = np.r_[np.flatnonzero(np.diff(s[order])), len(s) - 1]
    tp, al = np.cumsum(w[order] * y[order])[cut], np.cumsum(w[order])[cut]
    rec = tp / tp[-1]
    assert r.average_precision == pytest.approx(float((np.diff(np.r_[0, rec]) * tp / al).sum()))


def test_one_class_has_no_auc(spark):
    assert M.ranking_metrics(frame(spark, y=[1, 1], s=[0.1, 0.2]), "y", "s").first().auc is None


def test_limits(spark):
    perfect = frame(spark, y=[0, 0, 1, 1], p=[0.0, 0.0, 1.0, 1.0])
    flat = frame(spark, y=[0, 0, 1, 1], p=[0.5] * 4)
    assert M.brier(perfect, "y", "p").first()[0] == 0.0 and M.brier(flat, "y", "p").first()[0] == 0.25
    assert M.ranking_metrics(perfect, "y", "p").first().ks == 1.0 and M.ranking_metrics(flat, "y", "p").first().ks == 0.0


def test_calibration_recovers_frequencies(spark):
    rng = np.random.default_rng(2)
    p = rng.random(20000)
    df = frame(spark, y=(rng.random(20000) < p).astype(int), p=p)
    got = M.calibration_curve(df, "y", "p", 5).collect()
    assert len(got) == 5 and all(abs(r.predicted - r.observed) < 0.03 for r in got)
    assert {r.band for r in got} >= {"0.0 a 0.2", "0.8 a 1.0"}


def test_sweep_and_operating_threshold(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 2000)
    df = frame(spark, y=y, p=np.clip(0.4 * y + 0.6 * rng.random(2000), 0, 1))
    sweep = M.threshold_sweep(df, "y", "p").orderBy("threshold").collect()
    assert len(sweep) == 41 and all(a.recall_negatives <= b.recall_negatives for a, b in zip(sweep, sweep[1:]))
    one = M.confusion_metrics(df, "y", "p", 0.5).first()
    assert [r for r in sweep if r.threshold == 0.5][0].f1 == pytest.approx(one.f1)
    t = M.operating_threshold(df, "y", "p", 0.9).first().threshold
    assert M.confusion_metrics(df, "y", "p", t).first().recall_negatives >= 0.9
    assert M.operating_threshold(df, "y", "p", 1.1).first().threshold == 0.9


def test_risk_grows_with_slack_and_counts_ties(spark):
    units = spark.createDataFrame([(1, 60.0, 56.0), (2, 60.0, 60.0), (3, 60.0, 65.0), (4, None, 60.0)], "id int, p double, t double")
    residuals = spark.createDataFrame([(v,) for v in (-4.0, -2.0, 0.0, 2.0, 4.0)], "r double")
    got = {r.id: r.risk for r in M.risk_of_missing(units, "p", "t", residuals, "r", ["id"]).collect()}
    assert got == {1: 0.2, 2: 0.6, 3: 1.0, 4: None}


def test_regression_metrics(spark):
    r = M.regression_metrics(frame(spark, y=[50.0, 60, 70, 80], p=[52.0, 58, 71, 79]), "y", "p").first()
    assert (r.mae, r.bias, r.spearman) == pytest.approx((1.5, 0.0, 1.0)) and r.r2 > 0.95


def test_missing_shortcut_is_found(spark):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 1000)
    gone = (y == 1) & (rng.random(1000) < 0.5)
    df = frame(spark, y=y, atalho=np.where(gone, np.nan, 1.0), cheia=np.ones(1000)).withColumn("atalho", F.nanvl("atalho", F.lit(None).cast("double")))
    got = M.missingness_auc(df, ["atalho", "cheia"], "y").collect()
    assert [r.variable for r in got] == ["atalho"] and got[0].auc_missing > 0.6


def grouped(spark, strength=1.0, n=3000, groups=60):
    rng = np.random.default_rng(5)
    g = rng.integers(0, groups, n)
    y = (rng.random(n) < 0.5).astype(int)
    return frame(spark, id=np.arange(n), g=g, y=y, strong=np.round(y * 0.4 * strength + 0.6 * rng.random(n), 3), weak=np.round(rng.random(n), 3))


def test_shuffle_keeps_group_sums_and_kills_the_signal(spark):
    df = grouped(spark)
    out = RS.shuffled(df, "y", ["id"], ["g"]).cache()
    sums = out.groupBy("g").agg(F.sum("y").alias("a"), F.sum("shuffled").alias("b"))
    assert sums.filter("a <> b").count() == 0 and out.count() == df.count()
    assert M.ranking_metrics(out, "y", "strong").first().auc > 0.7
    assert M.ranking_metrics(out, "shuffled", "strong").first().auc == pytest.approx(0.5, abs=0.03)


def test_bootstraps(spark):
    df = grouped(spark).cache()
    r = RS.cluster_bootstrap(df, "y", "strong", "g", resamples=60).first()
    assert r.low <= r.estimate <= r.high and r.high - r.low < 0.15
    d = RS.paired_bootstrap(df, "y", "strong", "weak", "g", resamples=40).first()
    assert d.low <= d.difference <= d.high and d.low > 0


def test_draws_are_as_many_as_groups(spark):
    draws = RS.cluster_draws(grouped(spark), "g", 10)
    assert {r.n for r in draws.groupBy("rep").agg(F.sum("times").alias("n")).collect()} == {60}


def test_folds_are_disjoint_complete_and_balanced(spark):
    df = grouped(spark)
    out = RS.group_folds(df, "g", 5, "y").cache()
    assert out.count() == df.count() and out.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").count() == 0
    rates = [r.r for r in out.groupBy("fold").agg(F.avg("y").alias("r")).collect()]
    assert len(rates) == 5 and max(rates) - min(rates) < 0.08


def test_list_stability_equals_a_resample_by_resample_count(spark):
    rng = np.random.default_rng(6)
    res = np.round(rng.normal(size=31), 2)
    units = spark.createDataFrame([(i, 0.0, float(t)) for i, t in enumerate(np.linspace(-1, 1, 9))], "id int, p double, t double")
    residuals = frame(spark, k=np.arange(31), r=res)
    got = {r.id: r.share for r in RS.list_stability(units, "p", "t", residuals, "r", ["k"], ["id"], resamples=25).collect()}
    import hashlib

    h = lambda *k: int(hashlib.md5("|".join(map(str, (42, *k))).encode()).hexdigest()[:15], 16)
    order = sorted(range(31), key=lambda k: (h(k), k))
    want = {i: 0.0 for i in got}
    for rep in range(25):
        drawn = np.array([res[order[h(rep, slot) % 31]] for slot in range(31)])
        for i, t in enumerate(np.linspace(-1, 1, 9)):
            want[i] += ((drawn <= t).mean() >= 0.5) / 25
    assert got == pytest.approx(want)


def test_statistics_against_plain_formulas(spark):
    rng = np.random.default_rng(7)
    a, b, g = np.round(rng.normal(size=500), 1), np.round(rng.normal(size=500), 1), rng.integers(0, 4, 500)
    df = frame(spark, a=a, b=b + a, g=g, f=(a > 0).astype(int))
    rho = X.spearman_pairs(df, [("a", "b")]).first().rho
    assert rho == pytest.approx(pd.Series(a).rank().corr(pd.Series(b + a).rank()))
    ranks = pd.Series(a).rank()
    n = 500
    h = 12 / (n * (n + 1)) * sum(ranks[g == k].sum() ** 2 / (g == k).sum() for k in range(4)) - 3 * (n + 1)
    t = pd.Series(a).value_counts()
    assert X.kruskal_wallis(df, "a", "g").first().h == pytest.approx(h / (1 - ((t**3 - t).sum()) / (n**3 - n)))
    assert df.agg(X.adjusted_skewness("a")).first()[0] == pytest.approx(pd.Series(a).skew())


@pytest.mark.parametrize("table", [[[10, 20], [30, 5]], [[10, 0], [3, 7]], [[6, 0], [0, 9]], [[3, 4, 0], [1, 0, 9]]])
def test_chi_square_with_empty_cells(spark, table):
    o = np.array(table, dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    gap = np.abs(o - e)
    if o.shape == (2, 2):
        gap = gap - np.minimum(0.5, gap)
    rows = [(i, j) for i in range(o.shape[0]) for j in range(o.shape[1]) for _ in range(int(o[i, j]))]
    assert X.chi_square(spark.createDataFrame(rows, "r int, c int"), "r", "c").first().chi2 == pytest.approx((gap**2 / e).sum())


def test_tail_probabilities(spark):
    assert X.tail_probability(spark, "chi2", 3.841458820694124, 1) == pytest.approx(0.05)
    assert X.tail_probability(spark, "t", 2.2281388519649385, 10) == pytest.approx(0.05)
