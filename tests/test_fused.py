"""Rules and rank correlations that share scans, against plain code."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import quality as Q
from tallyforge.operators import resampling as RS
from tallyforge.operators import stats as X


def test_rules_of_a_table_find_what_is_bad(spark):
    rows = [(1, "a", 5.0, 1), (1, "a", 50.0, 1), (2, "b", None, 0), (3, "x", 500.0, 1), (None, None, -1.0, None)]
    df = spark.createDataFrame(rows, "k int, area string, v double, flag int")
    areas = spark.createDataFrame([("a",), ("b",), ("b",)], "area string")
    rules = [
        Q.Key("key", ("k",)), Q.Known("area", "area", areas), Q.in_range("range", "v", 0, 100), Q.never_null("null", "v"),
        Q.never_null("null where", "v", F.col("flag") == 1), Q.always_true("true", F.col("flag") == 1), Q.Mean("mean", F.abs("v"), 139.1), Q.Mean("too much", F.abs("v"), 1.0),
    ]
    got = {r.check: (r.ok, r.detail) for r in Q.verdicts(df, rules).collect()}
    assert got == {"key": (False, 1), "area": (False, 1), "range": (False, 2), "null": (False, 1), "null where": (True, 0), "true": (False, 2), "mean": (True, 139000), "too much": (False, 139000)}
    no_key = {r.check: (r.ok, r.detail) for r in Q.verdicts(df, rules[1:]).collect()}
    assert no_key == {k: v for k, v in got.items() if k != "key"}
    empty = {r.check: (r.ok, r.detail) for r in Q.verdicts(df.limit(0), rules).collect()}
    assert empty["key"] == (True, 0) and empty["mean"] == (False, None) and empty["range"] == (True, 0)
    with pytest.raises(ValueError):
        Q.verdicts(df, [rules[0], rules[0]])


def test_one_scan_per_table(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "t"))
    plan = Q.verdicts(spark.read.parquet(str(tmp_path / "t")), [Q.Key("key", ("k",)), Q.in_range("a", "v", 0, 3), Q.never_null("b", "v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("gaps", [False, True])
def test_rank_correlations_equal_pandas(spark, gaps):
    rng = np.random.default_rng(2)
    n = 300
    pdf = pd.DataFrame(rng.integers(0, 12, size=(n, 6)).astype(float), columns=list("abcdef"))
    pdf["b"] += pdf["a"]
    if gaps:
        pdf.loc[:40, ["a", "b"]] = np.nan
        pdf.loc[200:, "c"] = np.nan
        pdf.loc[rng.random(n) < 0.3, "d"] = np.nan
    pdf["same"] = 1.0
    names = list(pdf.columns)
    df = spark.createDataFrame(pdf)
    got = {(r.v1, r.v2): (r.n, r.rho) for r in X.spearman_matrix(df, names).collect()}
    assert len(got) == 21
    for (a, b), (k, rho) in got.items():
        both = pdf[[a, b]].dropna()
        assert k == len(both)
        if "same" in (a, b):
            assert rho is None
        else:
            np.testing.assert_allclose(rho, both[a].rank().corr(both[b].rank()), atol=1e-9)
    assert len(X.null_patterns(df.select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in names]), names)) == (4 if gaps else 1)


def test_multiplicities_are_the_draws(spark):
    df = spark.createDataFrame([(f"g{i % 23}",) for i in range(100)] + [(None,)], "g string")
    want = {(r.g, r.rep): r.times for r in RS.cluster_draws(df, "g", 17).collect()}
    got = {r.g: np.frombuffer(bytes(r.times), "<u4") for r in RS.multiplicities(df, "g", 17).collect()}
    assert {(g, r): int(t) for g, v in got.items() for r, t in enumerate(v) if t} == want


def test_thresholds_of_resamples_with_ties_and_nulls(spark, partitions):
    partitions(3)
    rng = np.random.default_rng(3)
    rows = [(i, float(v) if i % 13 else None) for i, v in enumerate(rng.integers(-4, 5, 200))]
    df = spark.createDataFrame(rows, "k int, r double")
    from tallyforge.operators.ordered import hash_positions

    slots = {x.slot: x.r for x in hash_positions(df, ["k"], 42, name="slot").collect()}
    import hashlib

    want = {}
    for rep in range(12):
        drawn = [slots[int(hashlib.md5(f"42|{rep}|{s}".encode()).hexdigest()[:15], 16) % len(slots)] for s in range(len(slots))]
        drawn = sorted(v for v in drawn if v is not None)
        want[rep] = drawn[-(-len(drawn) // 2) - 1]
    assert {r.rep: r.threshold for r in RS.residual_thresholds(df, "r", ["k"], 12).collect()} == want
