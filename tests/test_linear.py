"""Models of all folds from one scan, against refits on each complement."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.models import linear as L
from tallyforge.models.families import FAMILIES

GROUPS = {"history": ["h"], "log": ["pop"], "numbers": ["d"], "categories": ["uf"]}


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(5)
    n = 240
    pdf = pd.DataFrame({
        "id": np.arange(n), "fold": rng.integers(0, 4, n).astype("int32"), "h": rng.normal(60, 10, n), "pop": rng.lognormal(9, 1.2, n), "d": rng.normal(10, 3, n),
        "uf": rng.choice(["CE", "BA", "SP"], n), "w": rng.uniform(0.5, 2, n), "spot": rng.random(n),
    })
    pdf["y"] = (pdf["h"] + rng.normal(0, 8, n) > 60).astype(int)
    pdf["level"] = pdf["h"] * 0.7 + pdf["d"] + rng.normal(0, 2, n)
    pdf.loc[:19, "h"] = np.nan
    pdf.loc[20:24, "pop"] = np.nan
    pdf.loc[pdf["fold"] == 3, "uf"] = "AM"  # a level that only its own fold has
    return pdf, spark.createDataFrame(pdf).cache()


def features(pdf, train):
    """numpy twin of the preprocessing: all rows, learned on `train`."""
    out = {}
    h, p, d = pdf["h"].fillna(train["h"].median()), np.log1p(pdf["pop"].fillna(train["pop"].median()).clip(lower=0)), pdf["d"]
    th, tp, td = train["h"].fillna(train["h"].median()), np.log1p(train["pop"].fillna(train["pop"].median()).clip(lower=0)), train["d"]
    gap, tgap = pdf["h"].isna().astype(float), train["h"].isna().astype(float)
    for name, x, t in (("h", h, th), ("pop", p, tp), ("d", d, td), ("ausente_h", gap, tgap)):
        out[name] = (x - t.mean()) / (t.std(ddof=0) or 1.0)
    for level in sorted(pdf["uf"].unique()):
        out[f"uf_{level}"] = (pdf["uf"] == level).astype(float)
    names = ["h", "pop", "d", "ausente_h", *[f"uf_{v}" for v in sorted(pdf["uf"].unique())]]
    return np.column_stack([np.ones(len(pdf)), *[out[n] for n in names]]), names


def numpy_ridge(x, y, alpha, w):
    penalty = alpha * np.eye(x.shape[1])
    penalty[0, 0] = 0
    return np.linalg.solve((x * w[:, None]).T @ x + penalty, (x * w[:, None]).T @ y)


def numpy_logistic(x, y, c, w):
    beta, free = np.zeros(x.shape[1]), np.ones(x.shape[1])
    free[0] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta = beta - np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(free / c), x.T @ (w * (p - y)) + free * beta / c)
    return beta


@pytest.mark.parametrize("ranges", [2, 7])
def test_medians_of_complements(spark, partitions, ranges):
    partitions(ranges)
    rng = np.random.default_rng(1)
    rows = [(f"g{i % 7}" if i % 11 else None, float(rng.choice([1.0, 2.0, 2.0, 2.0, rng.normal()])), None if i % 3 else float(i)) for i in range(500)] + [("alone", None, -1e9), ("none", None, None)]
    got = {(r.g, r.variable): r.median for r in L.complement_medians(spark.createDataFrame(rows, "g string, a double, b double"), ["a", "b"], "g").collect()}
    pdf = pd.DataFrame(rows, columns=["g", "a", "b"])
    for c in ("a", "b"):
        assert got[None, c] == pdf[c].median()
        for g in pdf.loc[pdf[c].notna(), "g"].dropna().unique():
            assert got[g, c] == pdf.loc[pdf["g"] != g, c].median(), (g, c)
    assert ("none", "a") not in got and ("alone", "a") not in got


@pytest.mark.parametrize("weight", [None, "w"])
def test_ridge_of_every_complement(base, weight):
    pdf, df = base
    got = L.ridge_left_out(df, GROUPS, "level", "fold", 3.0, weight).toPandas().set_index("id")["prediction"]
    assert len(got) == len(pdf)
    for k in range(4):
        train, rest = pdf[pdf["fold"] != k], pdf["fold"] == k
        x, _ = features(pdf, train)
        beta = numpy_ridge(x[~rest], train["level"].to_numpy(), 3.0, train["w"].to_numpy() if weight else np.ones(len(train)))
        np.testing.assert_allclose(got[pdf.loc[rest, "id"]], x[rest] @ beta, atol=1e-6)


def test_ridge_models_equal_spark_fits(base):
    pdf, df = base
    _, models = L.ridge_models(df, GROUPS, "level", "fold", 3.0)
    family = FAMILIES["ridge"]
    for m in models.collect():
        part = df.filter(F.col("fold") != int(m.key))
        assert m.n == part.count()
        rest = df.filter(F.col("fold") == int(m.key))
        want = family.predict(family.fit(part, GROUPS, {"alpha": 3.0}, "level"), rest).toPandas().set_index("id")["prediction"]
        got = L.ridge_left_out(df, GROUPS, "level", "fold", 3.0).filter(F.col("fold") == int(m.key)).toPandas().set_index("id")["prediction"]
        np.testing.assert_allclose(got.loc[want.index], want, atol=1e-5)
        break


@pytest.mark.parametrize("weight", [None, "w"])
def test_logistic_of_every_complement(base, weight):
    pdf, df = base
    basis, models = L.fit_logistic(df, GROUPS, "y", 0.5, weight, "fold")
    got = L.logistic_left_out(df, GROUPS, "y", "fold", 0.5, weight).toPandas().set_index("id")["prediction"]
    for m in models:
        rest = pdf["fold"] == int(m.left_out)
        train = pdf[~rest]
        x, names = features(pdf, train)
        beta = numpy_logistic(x[~rest], train["y"].to_numpy(), 0.5, train["w"].to_numpy() if weight else np.ones(len(train)))
        assert [n for n, _ in L.coefficient_rows(basis, m)] == [*names, "intercept"] and m.gradient_norm < 1e-4 and 2 < m.steps < 15
        np.testing.assert_allclose(m.beta, beta, atol=1e-6)
        np.testing.assert_allclose(got[pdf.loc[rest, "id"]], 1 / (1 + np.exp(-x[rest] @ beta)), atol=1e-7)


def test_logistic_of_shares(base):
    pdf, df = base
    _, models = L.fit_logistic(df, GROUPS, "y", 1.0, by="fold", shares=[0.4, 1.0], spot="spot")
    assert [(m.left_out, m.share) for m in models] == [(str(k), s) for s in (0.4, 1.0) for k in range(4)]
    for m in models[:4:3]:
        train = pdf[(pdf["fold"] != int(m.left_out)) & (pdf["spot"] < m.share)]
        x, names = features(pdf, train)
        beta = numpy_logistic(x[train.index], train["y"].to_numpy(), 1.0, np.ones(len(train)))
        np.testing.assert_allclose(m.beta, beta, atol=1e-6)


def test_separable_classes_and_empty_parts(spark):
    rows = [(i, float(i), int(i >= 20), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x double, y int, fold int")
    _, (m,) = L.fit_logistic(df, {"numbers": ["x"]}, "y", 1e6)
    assert np.isfinite(m.beta).all() and m.loss < 1
    one = L.ridge_left_out(df.filter("fold = 0"), {"numbers": ["x"]}, "y", "fold", 1.0).toPandas()
    assert (one["prediction"] == 0).all()  # no other group to learn from
