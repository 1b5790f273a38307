import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.models import prep
from tallyforge.models import validation as V
from tallyforge.models.families import FAMILIES, coefficients
from tallyforge.operators import attribution as AT
from tallyforge.operators import clustering as C
from tallyforge.operators.rows import feature_table

GROUPS = {"history": ["h"], "log": ["pop"], "numbers": ["d"], "categories": ["uf"]}


@pytest.fixture(scope="module")
def base(spark):
    rng = np.random.default_rng(0)
    n = 200
    pdf = pd.DataFrame({
        "id": np.arange(n), "area": np.repeat(np.arange(50), 4), "h": rng.normal(60, 10, n), "pop": rng.lognormal(9, 1.2, n), "d": rng.normal(10, 3, n),
        "uf": rng.choice(["CE", "BA", "SP"], n),
    })
    pdf["y"] = (pdf["h"] + rng.normal(0, 6, n) > 60).astype(int)
    pdf["level"] = pdf["h"] * 0.7 + pdf["d"] + rng.normal(0, 2, n)
    pdf.loc[:9, "h"] = np.nan
    pdf.loc[20:24, "pop"] = np.nan
    df = spark.createDataFrame(pdf)
    return pdf, df.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) if c in ("h", "pop") else F.col(c) for c in df.columns]).cache()


def test_preprocessing_equals_numpy(base):
    pdf, df = base
    model = prep.fit_preprocessor(df, GROUPS)
    assert prep.feature_names(model) == ["h", "pop", "d", "ausente_h", "uf_BA", "uf_CE", "uf_SP"]
    got = prep.transformed_matrix(model, df, ["id"]).toPandas().sort_values("id")
    h = pdf["h"].fillna(pdf["h"].median())
    p = np.log1p(pdf["pop"].fillna(pdf["pop"].median()).clip(lower=0))
    m = pdf["h"].isna().astype(float)
    for name, v in (("h", h), ("pop", p), ("ausente_h", m)):
        np.testing.assert_allclose(got[name], (v - v.mean()) / v.std(ddof=0), atol=1e-9)
    assert not got.isna().any().any() and abs(pd.Series(p).skew()) < abs(pdf["pop"].skew())


def test_unseen_category_and_constant_column(spark, base):
    _, df = base
    model = prep.fit_preprocessor(df.withColumn("d", F.lit(3.0)), GROUPS)
    new = df.limit(1).withColumn("uf", F.lit("XX"))
    row = prep.transformed_matrix(model, new).first()
    assert (row["uf_BA"], row["uf_CE"], row["uf_SP"]) == (0.0, 0.0, 0.0)
    assert prep.transformed_matrix(model, df.withColumn("d", F.lit(3.0))).agg(F.max(F.abs("d"))).first()[0] == 0.0


def test_no_indicator_for_a_column_that_is_full_in_train(base):
    _, df = base
    model = prep.fit_preprocessor(df.filter("h is not null"), GROUPS)
    assert "ausente_h" not in prep.feature_names(model)


def test_missing_column_raises(base):
    with pytest.raises(KeyError):
        feature_table(base[1], {"numbers": ["not_there"]})


def design(df, model):
    m = prep.transformed_matrix(model, df, ["id", "y", "level"]).toPandas().sort_values("id")
    return m.drop(columns=["id", "y", "level"]).to_numpy(), m["y"].to_numpy(float), m["level"].to_numpy(float)


def test_ridge_closed_form(base):
    _, df = base
    alpha = 3.0
    model = FAMILIES["ridge"].fit(df, GROUPS, {"alpha": alpha}, "level")
    x, _, y = design(df, model)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), want, atol=1e-8)


def test_logistic_newton(base):
    _, df = base
    df = df.withColumn("w", F.lit(1.0) + F.col("id") % 3)
    model = FAMILIES["logistic"].fit(df, GROUPS, {"c": 0.7, "tol": 1e-10}, "y", "w")
    x, y, _ = design(df, model)
    w = 1.0 + np.arange(200) % 3
    a, b = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    pen = np.eye(len(b)) / 0.7
    pen[-1, -1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ b))
        b -= np.linalg.solve(a.T @ (a * (w * p * (1 - p))[:, None]) + pen, a.T @ (w * (p - y)) + pen @ b)
    np.testing.assert_allclose(model.stages[-1].coefficients.toArray(), b[:-1], atol=1e-4)


def test_out_of_fold_is_complete_and_finds_the_signal(base):
    _, df = base
    out = V.oof_predictions(df, GROUPS, FAMILIES["logistic"], {"c": 1.0}, "y", "area", 4).cache()
    assert out.count() == 200 and out.filter("prediction is null").count() == 0
    from tallyforge.operators.metrics import ranking_metrics

    assert ranking_metrics(out, "y", "prediction").first().auc > 0.7


def test_leave_one_group_out_never_sees_its_own_group(spark):
    rows = [(g, float(v), 1.0) for g, v in (("A", 1), ("B", 2), ("C", 3)) for _ in range(10)]
    df = spark.createDataFrame(rows, "g string, y double, x double")
    out = V.leave_one_group_out(df, {"numbers": ["x"]}, FAMILIES["ridge"], {"alpha": 1.0}, "y", "g")
    got = {r.g: r.p for r in out.groupBy("g").agg(F.avg("prediction").alias("p")).collect()}
    assert got == pytest.approx({"A": 2.5, "B": 2.0, "C": 1.5})


def test_search_orders_trials_and_rfe_keeps_the_asked_number(base):
    _, df = base
    search = V.random_search(df, GROUPS, FAMILIES["ridge"], "level", "area", trials=2, folds=2)
    scores = [r.mean_validation for r in search.collect()]
    assert scores == sorted(scores, reverse=True) and V.best_params(search)["alpha"] > 0
    kept = V.recursive_elimination(df, GROUPS, FAMILIES["ridge"], {"alpha": 1.0}, "level", keep=3)
    assert {r.variable for r in kept.filter("kept").collect()} >= {"h", "d"} and kept.filter("kept").count() == 3


def test_tree_families_fit(base):
    _, df = base
    small = {"trees": 5, "depth": 3, "min_leaf": 2, "features": 0.8, "rounds": 3, "rate": 0.3, "rows": 0.8}
    for name, target in (("forest", "y"), ("boosted", "y"), ("forest_level", "level"), ("boosted_level", "level")):
        family = FAMILIES[name]
        out = family.predict(family.fit(df, GROUPS, small, target), df)
        assert out.filter("prediction is null").count() == 0
    for i in range(20):
        d = FAMILIES["forest"].draw(i)
        assert 4 <= d["depth"] <= 19 and 5 <= d["min_leaf"] <= 99 and 0.2 <= d["features"] <= 0.8


def test_sampled_attribution_adds_up_and_equals_the_linear_one(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(40), "a": rng.normal(size=40), "b": rng.normal(size=40)})).cache()
    score = lambda d: d.withColumn("prediction", 2.0 * F.col("a") - F.col("b"))
    phi = AT.attribution_sampled(df, ["a", "b"], ["id"], score, permutations=300)
    exact = AT.long_attributions(AT.attribution_linear(df, {"a": 2.0, "b": -1.0}, ["id"]), ["a", "b"], ["id"]).withColumnRenamed("phi", "want")
    worst = phi.join(exact, ["id", "variable"]).agg(F.max(F.abs(F.col("phi") - F.col("want"))), F.count("*")).first()
    assert worst[0] < 0.6 and worst[1] == 80


def test_permutation_importance_ranks_the_real_feature_first(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 1000)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(1000), "y": y, "a": y + rng.normal(size=1000), "b": rng.normal(size=1000)})).cache()
    got = {r.variable: r.drop_mean for r in AT.permutation_importance(df, ["a", "b"], ["id"], lambda d: d.withColumn("prediction", F.col("a")), "y", repeats=3).collect()}
    assert got["a"] > 0.15 and got["b"] == pytest.approx(0.0)


def brute_dbscan(x, eps, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = (d <= eps).sum(1) >= k
    lab = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if lab[i] < 0:
            todo, lab[i] = [i], i
            while todo:
                for j in np.flatnonzero((d[todo.pop()] <= eps) & core):
                    if lab[j] < 0:
                        lab[j] = i
                        todo.append(j)
    out = lab.copy()
    for i in np.flatnonzero(~core):
        near = lab[(d[i] <= eps) & core]
        out[i] = near.min() if len(near) else -1
    return out, np.sort(d, 1)


def test_density_clusters_with_a_crowded_cell_and_copies(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(3)
    x = np.r_[rng.normal(0, 0.05, (60, 2)), np.repeat(rng.normal(3, 0.1, (4, 2)), 15, axis=0), rng.uniform(-4, 6, (60, 2))]
    df = spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>").cache()
    want, d = brute_dbscan(x, 0.4, 5)
    got = {r.id: r.cluster for r in C.dbscan(df, "v", "id", 0.4, 5).collect()}
    assert [got[i] for i in range(len(x))] == want.tolist()
    near = {r.id: r.distance for r in C.k_distances(df, "v", "id", 4, 0.2).collect()}
    np.testing.assert_allclose([near[i] for i in range(len(x))], d[:, 3], atol=1e-12)


def test_silhouette_and_pca(spark):
    rng = np.random.default_rng(4)
    x = np.r_[rng.normal(0, 1, (30, 3)), rng.normal(4, 1, (40, 3))]
    c = np.r_[np.zeros(30), np.ones(40)].astype(int)
    df = spark.createDataFrame([(i, [float(a) for a in v], int(k)) for i, (v, k) in enumerate(zip(x, c))], "id long, v array<double>, c int").cache()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    a = np.array([d[i, (c == c[i])].sum() / ((c == c[i]).sum() - 1) for i in range(70)])
    b = np.array([d[i, c != c[i]].mean() for i in range(70)])
    assert C.silhouette(df, "v", "c", ["id"]).first()[0] == pytest.approx(((b - a) / np.maximum(a, b)).mean())
    got = [r.explained for r in C.pca_variance(C.as_vectors(df, "v"), 3).orderBy("component").collect()]
    vals = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    np.testing.assert_allclose(got, vals / vals.sum(), atol=1e-9)


def test_kmeans_of_all_starts_is_plain_lloyd(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(c, 0.4, size=(40, 3)) for c in (0, 3, 6)])
    df = C.as_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>"), "v")
    runs = C.kmeans_runs(df, [2, 3, 5], starts=3, keys=["id"])
    assert [(r.k, r.start) for r in runs] == [(k, s) for k in (2, 3, 5) for s in range(3)] and all(r.settled for r in runs)
    for r in runs:
        near = ((x[:, None] - r.centres[None]) ** 2).sum(axis=2)
        np.testing.assert_allclose(r.cost, near.min(axis=1).sum())
        for c in range(r.k):
            if (near.argmin(axis=1) == c).any():
                np.testing.assert_allclose(r.centres[c], x[near.argmin(axis=1) == c].mean(axis=0), atol=1e-9)
        assert r.sizes.sum() == len(x)
    best = C.best_runs(runs)
    assert best[3].cost == min(r.cost for r in runs if r.k == 3)
    got = C.assigned(best[3], df).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (got == ((x[:, None] - best[3].centres[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_shapley_values_of_a_model_with_interactions(spark):
    rng = np.random.default_rng(9)
    names = ["a", "b", "c"]
    x = rng.normal(size=(6, 3))
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id int, a double, b double, c double")
    back = [dict(zip(names, map(float, v))) for v in rng.normal(size=(2, 3))]
    f = lambda v: v[0] * v[1] + np.maximum(v[2], 0.1) * v[0]
    score = lambda d: d.withColumn("prediction", F.col("a") * F.col("b") + F.greatest("c", F.lit(0.1)) * F.col("a"))

    def value(row, inside):
        return np.mean([f([row[j] if j in inside else b[n] for j, n in enumerate(names)]) for b in back])

    want = {}
    for i, row in enumerate(x):
        for j, n in enumerate(names):
            rest = [k for k in range(3) if k != j]
            want[i, n] = sum(w * (value(row, {*s, j}) - value(row, set(s))) for s, w in (((), 1 / 3), ((rest[0],), 1 / 6), ((rest[1],), 1 / 6), (tuple(rest), 1 / 3)))
    got = {(r.id, r.variable): (r.phi, r.standard_error) for r in AT.attribution_shapley(df, names, ["id"], score, back).collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k]) < 1e-9 and got[k][1] == 0 for k in want)
    drawn = {(r.id, r.variable): (r.phi, r.standard_error) for r in AT.attribution_shapley(df, names, ["id"], score, back, draws=60, exact_up_to=2).collect()}
    assert all(abs(drawn[k][0] - want[k]) <= 5 * drawn[k][1] + 1e-9 for k in want) and max(e for _, e in drawn.values()) > 0


def test_principal_axes_are_numpys(spark):
    x = np.random.default_rng(10).normal(size=(50, 4)) @ np.diag([3.0, 2.0, 1.0, 0.0]) + 100
    df = C.as_vectors(spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>"), "v")
    axes = C.principal_axes(df)
    np.testing.assert_allclose(axes.covariance, np.cov(x.T), atol=1e-9)
    np.testing.assert_allclose(axes.values, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1], atol=1e-9)
    assert axes.residuals().max() < 1e-9 and abs(axes.values.sum() - axes.trace) < 1e-9
    rows = C.pca_variance(df, 4).collect()
    assert abs(rows[-1].cumulative - 1) < 1e-9 and rows[0].needed and not rows[-1].needed
    assert len(C.principal_axes(df.limit(0)).values) == 0


def test_mixtures_of_all_sizes_climb(spark):
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal((0, 0), 0.5, size=(120, 2)), rng.normal((5, 5), (1.0, 0.3), size=(80, 2))])
    df = C.as_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>"), "v")
    mixtures, n = C.mixture_runs(df, [1, 2, 3], 30, keys=["id"])
    assert [m.k for m in mixtures] == [1, 2, 3] and n == 200
    for m in mixtures:
        assert all(b >= a - 1e-4 for a, b in zip(m.path, m.path[1:])), m.path
        np.testing.assert_allclose(m.path[-1], np.logaddexp.reduce(m.logs(x), axis=1).sum(), rtol=1e-6)
    one, two = mixtures[0], mixtures[1]
    np.testing.assert_allclose(one.means[0], x.mean(axis=0), atol=1e-8)
    np.testing.assert_allclose(one.covariances[0], np.cov(x.T, ddof=0), atol=1e-5)
    np.testing.assert_allclose(sorted(two.weights), [0.4, 0.6], atol=0.01)
    rows = {r.k: r for r in C.gmm_bic(df, [1, 2, 3], 30, ["id"]).collect()}
    assert rows[2].bic < rows[1].bic and rows[2].parameters == 11
    np.testing.assert_allclose(rows[2].bic, 11 * np.log(200) - 2 * rows[2].log_likelihood)
