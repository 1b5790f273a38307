"""Plans and work that must not grow faster than the tables."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import attribution as AT
from tallyforge.operators import clustering as C
from tallyforge.operators import resampling as RS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def noted(monkeypatch, module, name="stored"):
    """Plans of the frames that a module stores, by label."""
    plans, real = {}, getattr(module, name)

    def keep(df, label):
        plans.setdefault(label, []).append(plan_of(df))
        return real(df, label)

    monkeypatch.setattr(module, name, keep)
    return plans


def test_draws_of_residuals_are_not_broadcast(spark, monkeypatch):
    plans = noted(monkeypatch, RS)
    df = spark.range(200).select("id", (F.col("id") * 7 % 200).cast("double").alias("v"))
    assert RS.residual_thresholds(df, "v", ["id"], 20).count() == 20
    (plan,) = plans["drawn"]
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_drawn_coalitions_shuffle_rows_and_not_hybrids(spark):
    df = spark.range(50).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"))
    score = lambda d: d.withColumn("prediction", F.col("a") * 2 + F.col("b") * F.col("c"))
    out = AT.attribution_shapley(df, ["a", "b", "c"], ["id"], score, [{"a": 0.0, "b": 1.0, "c": 0.5}], draws=2, exact_up_to=0)
    plan = plan_of(out)
    assert plan.count("Exchange hashpartitioning") == 1 and plan.index("Generate") < plan.index("Exchange")
    assert out.count() == 150


def test_k_distances_begin_at_a_radius_that_nearly_all_points_need(spark, monkeypatch):
    plans = noted(monkeypatch, C)
    x = np.random.default_rng(5).normal(size=(300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {r.id: r.distance for r in C.k_distances(df, "v", "id", 4, 0.001).collect()}
    want = np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), axis=1)[:, 3]
    np.testing.assert_allclose([got[i] for i in range(300)], want, atol=1e-12)
    assert len(plans["k-distance"]) <= 2


def _counted_blocks(monkeypatch):
    sizes, real = [], C.stored

    def keep(df, label):
        out = real(df, label)
        if label == "blocks":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(C, "stored", keep)
    return sizes


def test_mirrored_blocks_are_run_once(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 20)
    sizes = _counted_blocks(monkeypatch)
    x = np.random.default_rng(6).uniform(0.1, 0.2, size=(100, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = C.dbscan(df, "v", "id", 1.0, 3).collect()
    assert {r.cluster for r in got} == {0} and len(got) == 100
    assert sizes[0] == 15 and sizes[1] == 15  # of 5 chunks


def test_points_that_are_no_cores_are_compared_once(spark, monkeypatch):
    from test_models import brute_dbscan

    monkeypatch.setattr(C, "BLOCK_ROWS", 20)
    sizes = _counted_blocks(monkeypatch)
    x = np.random.default_rng(9).uniform(-1, 1, size=(150, 2))
    x = np.r_[x, x[:8], [[0.0, 5.0], [-0.0, 5.0], [np.nan, 1.0]]]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {r.id: r.cluster for r in C.dbscan(df, "v", "id", 0.15, 5).collect()}
    want, _ = brute_dbscan(x, 0.15, 5)
    core = (np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= 0.15).sum(1) >= 5
    assert [got[i] for i in range(len(x))] == want.tolist() and (want[~core] >= 0).sum() > 10 and (want < 0).sum() > 10
    assert len(sizes) == 2  # once all, once the cores


def test_noise_share_compares_noise_once(spark, monkeypatch, tmp_path):
    from test_models import brute_dbscan

    from tallyforge.queries import modelling

    monkeypatch.setattr(C, "BLOCK_ROWS", 40)
    sizes = _counted_blocks(monkeypatch)
    rng = np.random.default_rng(10)
    x = np.r_[rng.normal(0, 0.6, (60, 3)), rng.normal(6, 0.6, (50, 3)), rng.uniform(-9, 9, (90, 3))].astype(np.float32)
    x = np.r_[x, x[-2:], x[-1:]]
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    want, _ = brute_dbscan(x.astype(float), 0.9, 4)
    got = modelling.noise_share(spark, str(tmp_path)).first()
    assert (got["n_clusters"], got["noise_pct"]) == (len(set(want[want >= 0])), round(1000 * float((want < 0).mean())) / 10)
    assert 20 < (want < 0).sum() < 180 and len(sizes) == 2


def test_a_chunk_is_bounded_in_rows_and_in_values(spark):
    def chunks(n, wide):
        df = spark.range(n).select("id", F.array(F.lit(0)).alias("cell"), F.array_repeat(F.lit(0.5), wide).alias("v"))
        return C._chunks(df).first()["chunks"]

    assert [chunks(60_000, 3), chunks(70_000, 3), chunks(9_000, 1000)] == [1, 2, 3]


def test_tiles_are_of_single_precision_where_that_is_sure():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    step = rng.normal(size=(700, 64))
    step /= np.linalg.norm(step, axis=1)[:, None]
    # Pairs a hair within and beyond the limit, and rows far from all others, which spoil their own tiles alone.
    y = x + step * (0.9 + rng.integers(-3, 4, size=(700, 1)) * 1e-9)
    y[600:650] += 1e6
    kinds = [(i, j, tile.dtype) for i, j, tile, _ in C._small_tiles(x, y, 0.81)]
    assert {d for _, j, d in kinds if j == 0} == {np.dtype("float32")} and {d for _, j, d in kinds if j > 0} == {np.dtype("float64")}
    want = np.array([np.sqrt(((a - y) ** 2).sum(1)) <= 0.9 for a in x])
    got = np.zeros(want.shape, bool)
    for r, c in C._pairs_within(x, y, 0.9):
        got[r, c] = True
    assert (got == want).all() and 100 < want.diagonal().sum() < 600


def test_rows_meet_their_vectors_by_a_hash(spark):
    df = spark.createDataFrame([(i, [float(i % 7), -0.0 if i % 2 else 0.0]) for i in range(60)], "id long, v array<double>")
    out = C.dbscan(df, "v", "id", 0.5, 3)
    assert {r.id: r.cluster for r in out.collect()} == {i: i % 7 for i in range(60)}
    assert "Join [h#" in plan_of(out)


def test_pairs_at_the_very_limit_are_measured():
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 4, size=(600, 3)).astype(float) + 1e6, rng.integers(0, 4, size=(500, 3)).astype(float) + 1e6
    y[0] = np.nan
    y[1] = 1e200
    want = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)) <= np.sqrt(2.0)
    got = np.zeros(want.shape, bool)
    for r, c in C._pairs_within(x, y, float(np.sqrt(2.0))):
        got[r, c] = True
    assert (got == want).all()


def test_person_model_without_a_join_has_the_rows_of_the_join(spark, tmp_path):
    from tallyforge.queries import base, modelling

    items = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    items.limit(0).unionByName(items).write.parquet(str(tmp_path / "once" / "lineitem.parquet"))
    twin = items.limit(7).withColumn("l_quantity", F.col("l_quantity") + 1)
    items.unionByName(items.limit(7)).unionByName(twin).write.parquet(str(tmp_path / "again" / "lineitem.parquet"))
    for name in ("once", "again"):
        sf = str(tmp_path / name)
        s = base.scored(spark, sf)
        want = base.persons(spark, sf).select("person_id", "year", "area_id", "school_id", "network", "weight", F.col("year").cast("double").alias("year_number")).join(
            s.select("person_id", "y", F.col("w").alias("case_weight"), F.col("score_a").alias("hint")), "person_id").join(s.select("person_id", F.col("score_b").alias("noise")), "person_id")
        got = modelling.person_model(spark, sf, noise=True)
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        assert ("Join" in plan_of(got)) == (name == "again")


def test_rows_of_equal_features_are_one_with_shares_too(spark, monkeypatch):
    from tallyforge.models import linear as L

    sizes, real = {}, L.stored

    def keep(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(L, "stored", keep)
    df = spark.range(4000).select((F.col("id") % 5).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("y"), (F.col("id") % 2).alias("g"), (F.col("id") * 37 % 4000 / 4000).alias("spot"))
    _, models = L.fit_logistic(df, {"numbers": ["x"]}, "y", 1.0, None, "g", [0.1, 0.5, 1.0], "spot")
    assert sizes["designs"] <= 2 * 3 * 5
    assert [(m.left_out, m.share) for m in models] == [(g, s) for s in (0.1, 0.5, 1.0) for g in ("0", "1")]
    # The same models from the rows of one part alone.
    for m in models:
        part = df.filter((F.col("g") != int(m.left_out)) & (F.col("spot") < m.share))
        _, (one,) = L.fit_logistic(part, {"numbers": ["x"]}, "y", 1.0)
        np.testing.assert_allclose(one.beta, m.beta, atol=1e-7)


def test_a_task_writes_a_score_once_for_all_its_rows(spark, monkeypatch):
    sizes, real = {}, RS.stored

    def keep(df, label):
        out = real(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(RS, "stored", keep)
    df = spark.range(40000).select((F.col("id") % 400).alias("g"), (F.col("id") * 7919 % 250).cast("double").alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    got = {r.rep: r.value for r in RS.resampled_metric(df, "y", "s", "g", "auc", 6).collect()}
    assert 0 < sizes["score-sums"] <= 250 * 4
    monkeypatch.setattr(RS, "HELD_SUMS", 50)
    again = {r.rep: r.value for r in RS.resampled_metric(df, "y", "s", "g", "auc", 6).collect()}
    assert got.keys() == again.keys() == set(range(6)) and all(abs(got[r] - again[r]) < 1e-12 for r in got)


def test_permuted_rows_are_matched_once_and_without_keys(spark, monkeypatch):
    plans = noted(monkeypatch, AT)
    df = spark.range(300).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 7 / 7.0).alias("a"), (F.col("id") % 11 / 11.0).alias("b"))
    out = AT.permutation_importance(df, ["a", "b"], ["k"], lambda d: d.withColumn("prediction", F.col("a") + F.col("b")), "y", repeats=2)
    (plan,) = plans["pairs"]  # the only frame with a join of rows
    assert "position" in plan and "md5" not in plan_of(out)
    assert {r.variable for r in out.collect()} == {"a", "b"}


def _steps(spark, monkeypatch, eps, least):
    """The step that counts and the step that links, as dbscan gives them to its blocks."""
    steps, real = [], C._per_block

    def keep(asking, targets, axes, work, schema):
        steps.append(work)
        return real(asking, targets, axes, work, schema)

    with monkeypatch.context() as m:
        m.setattr(C, "_per_block", keep)
        C.dbscan(spark.createDataFrame([(i, [0.0]) for i in range(5)], "id long, v array<double>"), "v", "id", eps, least)
    return steps


def test_a_dense_block_lists_few_of_its_pairs(spark, monkeypatch):
    count, link = _steps(spark, monkeypatch, 0.9, 4)
    rng = np.random.default_rng(11)
    x = np.r_[rng.normal(0, 0.05, (4000, 3)), [[5.0, 5.0, 5.0], [5.1, 5.0, 5.0]]]
    a = pd.DataFrame({"id": np.arange(len(x)), "v": list(x), "m": 1})
    b = pd.DataFrame({"id": np.arange(len(x)) + len(x), "v": list(x + 0.01), "m": 1})
    seen, real = [], C._pairs_within

    def counted(*args):
        for r, c in real(*args):
            seen[-1] += len(r)
            yield r, c

    monkeypatch.setattr(C, "_pairs_within", counted)
    for work, left, right in ((count, a, a), (link, a, a), (count, a, b), (link, a, b)):
        seen.append(0)
        out = work(left, right)
        if work is count:
            n = out[out.n > 0].set_index("id").n
            assert (n[n.index % len(x) < 4000] >= 4).all() and (n[n.index % len(x) >= 4000] == 2).all()
            assert len(out[out.near != out.id]) == (2 if right is a else 8)
        else:
            assert out.b.nunique() == 2 and len(out) == len(set(left.id) | set(right.id)) - 2
    assert max(seen) < 4000 * 4000 / 3


def test_tiles_far_apart_and_mirrored_tiles_are_not_run(monkeypatch):
    rng = np.random.default_rng(12)
    x = np.r_[rng.normal(0, 0.05, (2048, 3)), rng.normal(9, 0.05, (2048, 3))]
    tiles, real = [], C._small_tiles

    def counted(*args):
        for tile in real(*args):
            tiles.append(tile[:2])
            yield tile

    monkeypatch.setattr(C, "_small_tiles", counted)
    assert sum(len(r) for r, _ in C._pairs_within(x, x, 0.9)) == 2 * 2048 * 2048
    assert len(tiles) == 20  # 8 x 8 tiles, of which 2 x 4 x 4 are near, and of those mirrored ones once
    assert sum(len(r) for r, _ in C._pairs_within(x, x.copy(), 0.9)) == 2 * 2048 * 2048 and len(tiles) == 20 + 32


def test_clusters_stay_when_known_pairs_are_left_out(spark, monkeypatch):
    from test_models import brute_dbscan

    for name, size in (("BLOCK_ROWS", 90), ("TILE_ROWS", 16), ("TILE_COLUMNS", 16), ("CROWD", 4), ("PAIRS", 32), ("PIVOTS", 5)):
        monkeypatch.setattr(C, name, size)
    rng = np.random.default_rng(13)
    x = np.r_[rng.normal(0, 0.3, (150, 3)), rng.normal(2, 0.3, (100, 3)), rng.uniform(-2, 4, (120, 3))]
    x = np.r_[x, x[:9], x[-9:], [[np.nan, 1.0, 1.0]]]
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {r.id: r.cluster for r in C.dbscan(df, "v", "id", 0.45, 5).collect()}
    want, _ = brute_dbscan(x, 0.45, 5)
    assert [got[i] for i in range(len(x))] == want.tolist() and 20 < (want < 0).sum() < 200 and len(set(want)) > 2
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= 0.45
    first = {r.id: r.n for r in C.neighbour_counts(df, "v", "id", 0.45).collect()}
    assert all(n == near[i].sum() for i, n in first.items() if n)


def test_blocks_go_by_their_number_and_vectors_as_one_array(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_ROWS", 20)
    x = np.random.default_rng(14).uniform(0, 1, size=(90, 2))
    df = spark.createDataFrame([(i, v.tolist(), 1, [0]) for i, v in enumerate(x)], "id long, v array<double>, m int, cell array<long>")

    def work(a, b):
        whole = [C._points(side).sum() for side in (a, b)]
        return pd.DataFrame({"columns": [" ".join(sorted({*a, *b}))], "n": [len(a) * len(b)], "total": [sum(whole)]})

    out = C._per_block(df, None, 1, work, "columns string, n long, total double")
    assert "block" in plan_of(out) and "home" not in plan_of(out).split("FlatMapCoGroups")[1].split("\n")[0]
    sides = out.collect()
    assert len(sides) == 15 and {r.columns for r in sides} == {"block id m v"}
    assert abs(sum(r.total for r in sides) - 6 * x.sum()) < 1e-9  # of 5 chunks each is in 4 blocks with others, and is both sides of its own
    for rows in ([[1.0, np.nan], [2.0, 3.0]], []):
        got = C._points(C._frame(pa.table({"id": pa.array(range(len(rows)), pa.int64()), "v": pa.array(rows, pa.list_(pa.float64()))})))
        np.testing.assert_array_equal(got, np.array(rows))
    with pytest.raises(ValueError):
        C._frame(pa.table({"v": pa.array([[1.0], [1.0, 2.0]], pa.list_(pa.float64()))}))
