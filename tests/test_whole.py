"""Registered queries do the whole published job."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallyforge.models import linear as L
from tallyforge.models import trees as T
from tallyforge.models import validation as V
from tallyforge.models.families import FAMILIES
from tallyforge.operators import attribution as AT
from tallyforge.operators import resampling as RS
from tallyforge.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_list_stability_has_500_resamples(spark):
    shares = np.array([r.share for r in QUERIES["list_stability"](spark, SMALL).collect() if r.share is not None])
    assert np.abs(shares * 500 - np.round(shares * 500)).max() < 1e-3
    assert np.abs(shares * 60 - np.round(shares * 60)).max() > 1e-2
    assert "range(500)" in ORACLES["list_stability"] and "range(60)" not in ORACLES["list_stability"]


def test_draws_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(RS, "TASK_DRAWS", 100, raising=False)
    tasks, real = [], RS._picked_slots
    monkeypatch.setattr(RS, "_picked_slots", lambda rows, *a: tasks.append(rows.rdd.getNumPartitions()) or real(rows, *a))
    df = spark.range(40).selectExpr("id", "cast(id as double) as v")
    assert RS.residual_thresholds(df, "v", ["id"], 50).count() == 50 and tasks == [20]


def people(spark, n=400):
    rng = np.random.default_rng(3)
    g, x, k = rng.integers(0, 23, n), np.round(rng.normal(size=n), 1), rng.integers(0, 3, n)
    y = (rng.random(n) < 1 / (1 + np.exp(-x - 0.4 * k))).astype(int)
    rows = [(i, int(g[i]), float(x[i]) if i % 17 else None, str(k[i]), int(y[i]), float(1 + i % 3)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, g int, x double, k string, y int, w double"), {"history": ["x"], "categories": ["k"]}


def test_scores_of_all_models_come_from_one_scan(spark, monkeypatch):
    df, groups = people(spark)
    slow = replace(FAMILIES["logistic"], name="plain")  # fits and scores one model after the other
    want = {(r.share, r.part): r for r in V.learning_curve(df, groups, slow, {"c": 1.0, "tol": 1e-12}, "y", "g", ["id"], (0.3, 1.0), 2).collect()}
    monkeypatch.setattr(L, "RANGE_ROWS", 30)
    monkeypatch.setattr(L, "HELD_ROWS", 50)
    stored, real = [], V.stored
    monkeypatch.setattr(V, "stored", lambda f, label: stored.append(label) or real(f, label))
    got = {(r.share, r.part): r for r in V.learning_curve(df, groups, FAMILIES["logistic"], {"c": 1.0}, "y", "g", ["id"], (0.3, 1.0), 2).collect()}
    assert set(got) == set(want) and len(got) == 4 and "curve-scores" not in stored
    for k, r in want.items():
        assert got[k].auc_mean == pytest.approx(r.auc_mean, abs=1e-4) and got[k].auc_std == pytest.approx(r.auc_std, abs=1e-4)


def test_trials_of_a_search_come_from_the_same_scans(spark):
    df, groups = people(spark)
    search = lambda family, more: {r.trial: r for r in V.random_search(df, groups, family, "y", "g", 3, 2, "w", more).collect()}
    got, want = search(FAMILIES["logistic"], None), search(FAMILIES["logistic"], {"tol": 1e-12})
    for i in range(3):
        assert got[i].params == {"c": want[i].params["c"]}
        for name in ("mean_train", "mean_validation", "std_validation"):
            assert got[i][name] == pytest.approx(want[i][name], abs=1e-4)


def test_person_flow_searches_all_rows_of_the_year(spark, monkeypatch):
    seen = []

    def search(df, groups, family, target, group, trials, folds, weight, overrides):
        seen.append((df.count(), trials, folds, overrides))
        raise InterruptedError

    monkeypatch.setattr(V, "random_search", search)
    with pytest.raises(InterruptedError):
        QUERIES["train_person_flow"](spark, SMALL)
    whole = spark.read.parquet(f"{SMALL}/lineitem.parquet").filter("year(l_shipdate) = 1999").count()
    assert seen == [(whole, 10, 3, None)]


def test_drawn_coalitions_hash_the_keys_of_a_row_once(spark):
    df = spark.range(60).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"), F.rand(4).alias("d"))
    score = lambda f: f.withColumn("prediction", F.col("a") * 2 + F.col("b") * F.col("c") * F.col("d"))
    names, back = ["a", "b", "c", "d"], [{"a": 0.0, "b": 1.0, "c": 0.5, "d": 0.25}]
    out = AT.attribution_shapley(df, names, ["id"], score, back, draws=40, exact_up_to=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("md5(") == 1 and "array_sort" not in plan
    exact = {(r.id, r.variable): r.phi for r in AT.attribution_shapley(df, names, ["id"], score, back).collect()}
    gaps = [(abs(r.phi - exact[r.id, r.variable]), r.standard_error) for r in out.collect()]
    assert len(gaps) == 240 and all(g <= 6 * e + 1e-9 for g, e in gaps)
    assert np.mean([g for g, _ in gaps]) < 0.02 and np.mean([e for _, e in gaps]) > 0


def test_permutation_importance_permutes_five_times(spark, monkeypatch):
    seen, real = [], AT.permutation_importance

    def keep(*args, repeats=5, **more):
        seen.append(repeats)
        return real(*args, repeats=repeats, **more)

    monkeypatch.setattr(AT, "permutation_importance", keep)
    assert QUERIES["permutation_importance"](spark, SMALL).count() == 3 and seen == [5]
    assert ORACLES["permutation_importance"].count("range(5)") == 2


def test_trees_of_counted_cells_are_those_of_rows():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 4, (3, 500)).astype(np.uint8)
    y = ((codes[0] > 1) ^ (codes[1] > 2)).astype(float)
    ones = np.ones(500, np.int64)
    cells, of = np.unique(np.vstack([codes, y[None]]), axis=1, return_inverse=True)
    n = np.bincount(of.ravel(), minlength=cells.shape[1])
    options = (5, 0.3, 3, 10, 1.0, 3, True, 1)
    whole = list(T.boost((codes, y, np.ones(500), ones), *options))
    short = list(T.boost((cells[:3].astype(np.uint8), cells[3], np.ones(len(n)), n), *options))
    for a, b in zip(whole, short):
        assert a["feature"] == b["feature"] and a["cut"] == b["cut"] and np.allclose(a["value"], b["value"])
    first = T.tree_values(whole[0], codes)
    assert np.allclose(first[(codes[0] > 1) & (codes[1] < 3)], 1.0) and whole[0]["feature"][0] in (0, 1)


def test_each_node_splits_best_and_keeps_its_least_rows():
    rng = np.random.default_rng(9)
    codes, g = rng.integers(0, 6, (4, 300)), rng.normal(size=300)
    n = np.ones(300)
    tree, out = T.grow(codes, n, n, g, 1, 40, 4, rng)
    best = max(
        (g[codes[f] <= b].sum() ** 2 / (codes[f] <= b).sum() + g[codes[f] > b].sum() ** 2 / (codes[f] > b).sum(), f, b)
        for f in range(4) for b in range(5) if 40 <= (codes[f] <= b).sum() <= 260)
    assert (tree["feature"][0], tree["cut"][0]) == best[1:]
    low = codes[best[1]] <= best[2]
    np.testing.assert_allclose(out, np.where(low, g[low].mean(), g[~low].mean()))
    _, out = T.grow(codes, n, n, g, 6, 40, 4, rng)
    assert min(np.unique(out, return_counts=True)[1]) >= 40


@pytest.mark.parametrize("name, trees", [("forest_level", "trees"), ("boosted", "rounds"), ("boosted_level", "rounds")])
def test_trees_of_spark_and_of_cells_agree(spark, tmp_path, name, trees):
    df, groups = people(spark, 2000)
    params = {trees: 20, "rate": 0.3, "depth": 3, "min_leaf": 10, "features": 1.0, "rows": 1.0}
    family = FAMILIES[name]
    model = family.fit(df, groups, params, "y")
    got = np.array([r.prediction for r in family.predict(model, df).orderBy("id").collect()])
    model.write().overwrite().save(str(tmp_path / "model"))
    back = family.predict(PipelineModel.load(str(tmp_path / "model")), df).orderBy("id").collect()
    np.testing.assert_array_equal([r.prediction for r in back], got)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(T, "MAX_CELLS", 0)
        plain = family.fit(df, groups, params, "y")
    assert "BinnedTrees" not in type(plain.stages[-1]).__name__
    want = np.array([r.prediction for r in family.predict(plain, df).orderBy("id").collect()])
    assert np.corrcoef(got, want)[0, 1] > 0.98 and np.abs(got - want).mean() < 0.03


def test_registered_trees_have_the_published_numbers(spark, monkeypatch):
    seen = []

    class Told(Exception):
        pass

    def fit(self, train, groups, params, target, weight=None, prep=None):
        options = self.build(train, params, weight).options
        seen.append((self.name, options["trees"], options["depth"], options["min_leaf"], options.get("rate")))
        raise Told

    monkeypatch.setattr(type(FAMILIES["forest"]), "fit", fit)
    for query in ("random_forest", "boosted_trees"):
        with pytest.raises(Told):
            QUERIES[query](spark, SMALL)
    assert seen == [("forest_level", 300, 10, 70, None), ("boosted_level", 600, 9, 284, 0.03)]


def test_rows_are_permuted_as_by_positions_in_hash_orders(spark, monkeypatch):
    monkeypatch.setattr(AT, "PACKED_ROWS", 40)
    monkeypatch.setattr(AT, "BLOCK_ROWS", 30)
    df = spark.range(333).selectExpr("concat('k', id) as k", "cast(id % 2 as int) as y", "if(id = 5, null, id / 8.0D) as a", "cast(id % 3 as int) as b")
    pairs = AT.permuted_pairs(df, ["y", "a", "b"], ["a", "b"], ["k"], 3, 42)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and [f.dataType for f in pairs.schema["other"].dataType] == [df.schema["a"].dataType, df.schema["b"].dataType]
    got = sorted((r.rep, r.y, str(r.a), r.b, str(r.other.a), r.other.b) for r in pairs.collect())
    rows = {r.k: r for r in df.collect()}
    h = lambda *k: int(hashlib.md5("|".join(map(str, k)).encode()).hexdigest()[:15], 16)
    want = []
    for rep in range(3):
        takers, givers = (sorted(rows, key=lambda k: h(f"42{side}", rep, k)) for side in "rg")
        want += [(rep, rows[t].y, str(rows[t].a), rows[t].b, str(rows[g].a), rows[g].b) for t, g in zip(takers, givers)]
    assert got == sorted(want)
