"""Ordered operators against numpy and pandas, with a value and a group that hold a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyforge.operators import ordered as O


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(1)
    n = 3000
    v = np.round(rng.normal(size=n), 2)
    v[: n // 3] = 0.5
    g = rng.integers(0, 40, n)
    g[n // 3 : 2 * n // 3] = 7
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf).cache()


def test_average_ranks(skewed):
    pdf, df = skewed
    want = pdf.assign(r=pdf.groupby("g")["v"].rank()).groupby(["g", "v"])["r"].first()
    got = O.average_ranks(df, "v", ["g"]).toPandas().set_index(["g", "v"])["rank"].sort_index()
    pd.testing.assert_series_equal(got, want.sort_index(), check_names=False)


@pytest.mark.parametrize("fn", [O.medians, O.long_medians])
def test_medians(skewed, fn):
    pdf, df = skewed
    got = fn(df, ["v"], ["g"]).toPandas().set_index("g")["v"].sort_index()
    pd.testing.assert_series_equal(got, pdf.groupby("g")["v"].median(), check_names=False)


def test_quantiles_interpolate(skewed):
    pdf, df = skewed
    r = O.exact_quantiles(df, "v", {"a": 0.025, "b": 0.31, "c": 1.0}).first()
    assert (r.a, r.b, r.c) == pytest.approx(tuple(np.quantile(pdf["v"], [0.025, 0.31, 1.0])))


def test_positions_are_a_total_order(skewed):
    pdf, df = skewed
    got = O.rank_positions(df.select("id", "v"), "v", "id").toPandas().sort_values("position")
    want = pdf.sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist() and got["position"].tolist() == list(range(1, len(pdf) + 1))


def test_hash_positions_and_samples_do_not_depend_on_partitions(skewed, partitions):
    _, df = skewed
    seen = []
    for n in (1, 7):
        partitions(n)
        moved = df.repartition(n + 2)
        pos = sorted(map(tuple, O.hash_positions(moved, ["id"], 5, ["g"]).select("id", "position").collect()))
        pick = sorted(r.id for r in O.hash_sample(moved, ["id"], 5, F.rint(F.col("n_total") * 0.3), ["g"]).collect())
        seen.append((pos, pick))
    assert seen[0] == seen[1]


def test_hash_sample_takes_the_exact_share(skewed):
    pdf, df = skewed
    got = O.hash_sample(df, ["id"], 5, F.rint(F.col("n_total") * 0.3), ["g"]).toPandas().groupby("g").size()
    want = np.rint(pdf.groupby("g").size() * 0.3)
    assert all(got.get(g, 0) == k for g, k in want.items())


def test_an_empty_table_gives_no_rows(skewed):
    _, df = skewed
    assert O.prefix_sums(df.limit(0), "v", {"n": F.lit(1)}).count() == 0
