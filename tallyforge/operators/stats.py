"""Statistical tests as DataFrames of their statistic; tail probabilities on request."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..session import stored
from .aggregates import summed
from .metrics import ranking_metrics, spearman
from .ordered import average_ranks, unpivoted
from .windows import with_group_mean

# Task functions travel with their helpers, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(v1, v2, n, rho) per pair of columns, over the rows where both are known."""
    entries = F.array(*[
        F.struct(F.lit(a).alias("v1"), F.lit(b).alias("v2"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
        for a, b in pairs
    ])
    long = df.select(F.explode(entries).alias("e")).select("e.*").dropna()
    return spearman(long, "x", "y", ["v1", "v2"])


def null_patterns(df: DataFrame, columns: Sequence[str]) -> list[list[str]]:
    """Columns that miss in the same rows, group by group. A sum of row hashes proposes the groups, a count checks them."""
    row = F.xxhash64(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    found = df.agg(*[F.sum(F.when(F.col(c).isNotNull(), row)).alias(c) for c in columns]).first()
    groups: dict = {}
    for c in columns:
        groups.setdefault(found[c], []).append(c)
    others = [(g[0], c) for g in groups.values() for c in g[1:]]
    if others:
        apart = df.agg(*[F.count_if(F.col(a).isNull() != F.col(c).isNull()).alias(c) for a, c in others]).first()
        for a, c in others:
            if apart[c]:
                groups[found[c]].remove(c)
                groups[c, "alone"] = [c]
    return list(groups.values())


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle of the rank correlations of columns, each over the rows where both are known: (v1, v2, n, rho).

    Columns that miss in the same rows form a group. For every two groups their common rows are ranked once per column,
    and one sum of products of the centred ranks gives all their pairs: rows are copied once per column and pair of
    groups, not once per pair of columns.
    """
    columns = list(columns)
    numbers = stored(df.select(F.monotonically_increasing_id().alias("__row"), *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns]), "columns")
    groups = null_patterns(numbers, columns)
    sets = [(i, j) for i in range(len(groups)) for j in range(i, len(groups))]
    members = {s: sorted({*groups[s[0]], *groups[s[1]]}, key=columns.index) for s in sets}
    cells = F.array(*[
        F.when(F.col(groups[i][0]).isNotNull() & F.col(groups[j][0]).isNotNull(),
               F.array(*[F.struct(F.lit(k).alias("set"), F.lit(at).alias("at"), F.col(c).alias("value")) for at, c in enumerate(members[i, j])]))
        for k, (i, j) in enumerate(sets)
    ])
    known = F.flatten(F.filter(cells, lambda x: x.isNotNull()))
    long = stored(numbers.select("__row", F.explode(known).alias("c")).select("__row", "c.*"), "long")
    ranks = average_ranks(long, "value", ["set", "at"]).select("set", "at", "value", "rank")
    rows = long.join(ranks, ["set", "at", "value"]).groupBy("set", "__row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "rank"))), lambda e: e["rank"]).alias("ranks"))
    sizes = {r["set"]: r["n"] for r in long.filter("at = 0").groupBy("set").agg(F.count("*").alias("n")).collect()}

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            which = np.asarray(batch.column(0))
            for k in np.unique(which):
                x = np.array(batch.column(1).filter(pa.array(which == k)).to_pylist(), float) - (sizes[k] + 1) / 2
                total[k] = total.get(k, 0.0) + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.ravel().tolist() for v in total.values()], pa.list_(pa.float64()))], names=["set", "sums"])

    products = summed(rows.select("set", "ranks").mapInArrow(gram, "set int, sums array<double>"), ["set"], "sums").collect()  # pairs of columns
    out = {}
    for r in products:
        (i, j), names = sets[r["set"]], members[sets[r["set"]]]
        g = np.array(r["sums"]).reshape(len(names), -1)
        for x, a in enumerate(names):
            for y in range(x + 1, len(names)):
                b = names[y]
                if i != j and (a in groups[i]) == (b in groups[i]):
                    continue  # of one group: its own set has all their rows
                spread = g[x, x] * g[y, y]
                out[a, b] = (a, b, int(sizes[r["set"]]), float(g[x, y] / np.sqrt(spread)) if spread > 0 else None)
    return df.sparkSession.createDataFrame([out[p] for p in combinations(columns, 2) if p in out], "v1 string, v2 string, n bigint, rho double")


def strong_pairs(matrix: DataFrame, bound: float = 0.6) -> DataFrame:
    return matrix.filter(F.abs("rho") > bound)


def kruskal_wallis(df: DataFrame, value: str, group: str) -> DataFrame:
    """Tie-corrected H over the groups, with its degrees of freedom."""
    known = df.select(F.col(group).alias("group"), F.col(value).cast("double").alias("value")).dropna()
    ranks = average_ranks(known, "value")
    cells = known.groupBy("group", "value").agg(F.count("*").cast("double").alias("m")).join(ranks, "value")
    per_group = cells.groupBy("group").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("rank")).alias("s"))
    t = F.col("ties").cast("double")
    ties = ranks.agg(F.sum(t * t * t - t)).scalar()
    sums = per_group.agg(F.sum("n").alias("n"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"), F.count("*").alias("k"))
    n = F.col("n")
    h = 12.0 / (n * (n + 1)) * F.col("q") - 3.0 * (n + 1)
    return sums.withColumn("t", ties).select(
        ratio(h, 1.0 - F.col("t") / (n * n * n - n)).alias("h"), (F.col("k") - 1).alias("dof"), n.cast("bigint").alias("n")
    )


def eta_squared(df: DataFrame, value: str, group: str) -> DataFrame:
    known = df.select(F.col(group).alias("group"), F.col(value).cast("double").alias("value")).dropna()
    g = known.groupBy("group").agg(F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("p"))
    whole = known.agg(F.avg("value")).scalar()
    g = g.withColumn("d", F.col("m") - whole)
    between, within = F.sum(F.col("n") * F.col("d") * F.col("d")), F.sum(F.col("n") * F.col("p"))
    return g.agg(ratio(between, between + within).alias("eta_squared"))


def chi_square(df: DataFrame, row: str, column: str, minimum_row: int = 0) -> DataFrame:
    """Chi-square of the contingency table; the continuity correction applies with one degree of freedom only."""
    named = df.select(F.col(row).alias("row"), F.col(column).alias("column")).dropna()
    cells = named.groupBy("row", "column").agg(F.count("*").alias("seen"))
    rows = cells.groupBy("row").agg(F.sum("seen").alias("in_row"))
    if minimum_row:
        rows = rows.filter(F.col("in_row") >= minimum_row)
    kept = cells.join(rows, "row")
    columns = kept.groupBy("column").agg(F.sum("seen").alias("in_column"))
    size = kept.agg(F.sum("seen")).scalar()
    joined = kept.join(columns, "column").withColumn("n", size)
    expected = F.col("in_row") * F.col("in_column") / F.col("n")
    gap = F.abs(F.col("seen") - expected)
    # Empty cells have no row here: their expected counts are what is missing from n. In a 2 x 2 table the
    # empty cells (one, or the two of a diagonal) have equal expected counts.
    cut = gap - F.least(F.lit(0.5), gap)
    s = joined.agg(
        F.sum(gap * gap / expected).alias("plain"), F.sum(cut * cut / expected).alias("corrected"),
        F.sum(expected).alias("covered"), F.max("n").alias("n"), F.count("*").alias("cells"),
        ((F.count_distinct("row") - 1) * (F.count_distinct("column") - 1)).alias("dof"),
    )
    empty, holes = F.col("n") - F.col("covered"), 4 - F.col("cells")
    each = ratio(empty, holes)
    rest = each - F.least(F.lit(0.5), each)
    corrected = F.col("corrected") + F.coalesce(holes * ratio(rest * rest, each), F.lit(0.0))
    return s.select(F.when(F.col("dof") == 1, corrected).otherwise(F.col("plain") + empty).alias("chi2"), "dof", "n")


def adjusted_skewness(value: str) -> Column:
    """Bias-adjusted skewness (Spark's own is the population one)."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def variance_decomposition(df: DataFrame, value: str, outer: str, inner: str) -> DataFrame:
    """Sample variance between outer groups, between inner groups of one outer group, and within inner groups."""
    known = df.dropna(subset=[value, outer, inner])
    m = with_group_mean(with_group_mean(known, [outer], value, "mo"), [inner], value, "mi")
    s = m.agg(
        F.var_samp("mo").alias("between_outer"), F.var_samp(F.col("mi") - F.col("mo")).alias("between_inner"),
        F.var_samp(F.col(value) - F.col("mi")).alias("within"),
    )
    parts = ["between_outer", "between_inner", "within"]
    total = F.col(parts[0]) + F.col(parts[1]) + F.col(parts[2])
    return s.select(*[ratio(F.lit(100.0) * F.col(p), total).alias(f"{p}_pct") for p in parts])


def single_score_auc(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    """AUC of each column alone, its null rows left out."""
    long = unpivoted(df, columns, [y])
    return ranking_metrics(long, y, "value", by=["variable"], names=("auc",))


def leak_gate(
    df: DataFrame, columns: Sequence[str], y: str, minimum: int = 100, bound: float = 0.90, missing_bound: float = 0.60
) -> DataFrame:
    """Columns that tell the target too well: alone (auc > bound) or by being missing (auc >= missing_bound).

    A column with fewer than `minimum` values, or with one value only, has no verdict on its values.
    """
    from .metrics import missingness_auc

    long = unpivoted(df, columns, [y])
    sizes = long.groupBy("variable").agg(F.count("*").alias("n"), (F.min("value") < F.max("value")).alias("varies"))
    alone = single_score_auc(df, columns, y).join(sizes, "variable").filter((F.col("n") >= minimum) & F.col("varies"))
    alone = alone.select("variable", F.greatest("auc", 1.0 - F.col("auc")).alias("auc"))
    both = alone.join(missingness_auc(df, columns, y).drop("n_missing"), "variable", "full")
    leaks = (F.coalesce("auc", F.lit(0.0)) > bound) | (F.coalesce("auc_missing", F.lit(0.0)) >= missing_bound)
    return both.withColumn("leaks", leaks)


def weighted_rate(df: DataFrame, flag: str, weight: str, by: Sequence[str] = ()) -> DataFrame:
    w = F.col(weight)
    return df.groupBy(*by).agg(F.avg(flag).alias("raw"), ratio(F.sum(w * F.col(flag)), F.sum(w)).alias("weighted"))


def tail_probability(spark: SparkSession, kind: str, statistic: float, dof: float) -> float:
    """Tail of one number, from the maths library in Spark's own JVM: 'chi2' upper tail, 't' two-sided."""
    lib = spark.sparkContext._jvm.org.apache.commons.math3.distribution
    if kind == "chi2":
        return 1.0 - lib.ChiSquaredDistribution(float(dof)).cumulativeProbability(float(statistic))
    return 2.0 * (1.0 - lib.TDistribution(float(dof)).cumulativeProbability(abs(float(statistic))))


def spearman_p_value(spark: SparkSession, rho: float, n: int) -> float:
    if abs(rho) >= 1.0:
        return 0.0
    return tail_probability(spark, "t", rho * ((n - 2) / (1.0 - rho * rho)) ** 0.5, n - 2)
