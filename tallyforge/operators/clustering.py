"""Profiles: partitions, their quality, their names, and density clusters."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import key_hash, ratio, round_even
from ..session import stored
from .aggregates import summed
from .graph import connected_components
from .ordered import hash_sample, medians

SEED = 42
BLOCK_ROWS = 65_536  # of one side of a block
BLOCK_VALUES = 4_194_304  # of the vectors of one side
TILE_ROWS, TILE_COLUMNS = 512, 512  # a tile of single precision stays in the cache of a core
TILE_VALUES = 4_194_304
PAIRS = 16_384  # measured at once
CROWD = 1_024  # hits of a tile that are looked through before they are listed
PIVOTS = 64
REACH_POINTS = 256

# Task functions travel with their helpers, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def as_vectors(df: DataFrame, array: str = "embedding", name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array).cast("array<double>")))


# ---- partitions ----------------------------------------------------------------------------------


@dataclass
class Clusters:
    """Centres of one run, its cost, the rounds it took, and how many points each cluster holds."""

    k: int
    start: int
    centres: np.ndarray
    cost: float = math.inf
    rounds: int = 0
    sizes: np.ndarray | None = None
    settled: bool = False

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `prediction`: the nearest centre, ties to the first."""
        v = vector_to_array("features")
        gaps = F.array(*[_squared(v, F.array(*[F.lit(float(x)) for x in c])) for c in self.centres])
        return df.withColumn("prediction", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))


def _squared(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, q: s + q)


def kmeans_runs(df: DataFrame, ks: Sequence[int], starts: int = 10, max_iter: int = 50, keys: Sequence[str] = (), seed: int = SEED) -> list[Clusters]:
    """Lloyd's rounds for every number of clusters and every start at once: a round is one scan, in which each task
    sums the points of every cluster of every run that has not settled. Start s begins from the first k rows in the
    hash order of their keys (without keys, of their vectors). A cluster that loses all points keeps its centre."""
    points = df.select(*keys, vector_to_array("features").alias("__v"))
    named = list(keys) or [F.to_json("__v")]
    order = [points.select(F.lit(s).alias("start"), key_hash(named, f"{seed}s{s}").alias("h"), F.concat_ws("|", *[F.col(c).cast("string") if isinstance(c, str) else c for c in named]).alias("name"), "__v")
             .orderBy("h", "name").limit(max(ks)) for s in range(starts)]
    first: dict[int, list] = {}
    for r in reduce(DataFrame.unionByName, order).collect():  # starts x the most clusters
        first.setdefault(r["start"], []).append((r["h"], r["name"], r["__v"]))
    runs = [Clusters(k, s, np.array([v for _, _, v in sorted(rows)[:k]], float)) for k in ks for s, rows in sorted(first.items())]
    vectors = points.select("__v")
    for turn in range(max_iter + 1):
        open_ = [r for r in runs if not r.settled]
        if not open_:
            break
        for run, (cost, sizes, sums) in zip(open_, _lloyd_sums(vectors, [r.centres for r in open_])):
            run.cost, run.sizes = cost, sizes
            moved = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], run.centres)
            run.settled = turn == max_iter or bool(np.abs(moved - run.centres).max() <= 1e-12 * max(1.0, np.abs(moved).max()))
            if not run.settled:
                run.centres, run.rounds = moved, run.rounds + 1
    return runs


def _lloyd_sums(vectors: DataFrame, centres: Sequence[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(cost, sizes, sums of points) of every set of centres, from one scan and one row per task."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 + len(c) * (1 + c.shape[1])) for c in centres]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.asarray(part.column(0).flatten()).reshape(part.num_rows, -1)
                for c, sums in zip(centres, total):
                    gaps = np.stack([((x - m) ** 2).sum(axis=1) for m in c], axis=1)
                    near = gaps.argmin(axis=1)
                    sums[0] += gaps[np.arange(len(x)), near].sum()
                    sums[1 : 1 + len(c)] += np.bincount(near, minlength=len(c))
                    np.add.at(sums[1 + len(c) :].reshape(len(c), -1), near, x)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.concatenate(total).tolist()], pa.list_(pa.float64()))], names=["one", "sums"])

    row = summed(vectors.mapInArrow(gather, "one int, sums array<double>"), ["one"], "sums").first()
    flat, out = np.array(row["sums"]) if row else np.zeros(0), []
    for c in centres:
        size = 1 + len(c) * (1 + c.shape[1])
        mine, flat = flat[:size], flat[size:]
        out.append((float(mine[0]), mine[1 : 1 + len(c)], mine[1 + len(c) :].reshape(len(c), -1)))
    return out


def best_runs(runs: Sequence[Clusters]) -> dict[int, Clusters]:
    """Per number of clusters the run of the lowest cost, ties to the first start."""
    best: dict[int, Clusters] = {}
    for run in sorted(runs, key=lambda r: r.start):
        if run.k not in best or run.cost < best[run.k].cost:
            best[run.k] = run
    return best


def kmeans(df: DataFrame, k: int, starts: int = 10, max_iter: int = 50, keys: Sequence[str] = ()) -> Clusters:
    """The run with the lowest cost of several starts."""
    return best_runs(kmeans_runs(df, [k], starts, max_iter, keys))[k]


def hierarchical(df: DataFrame, k: int):
    return BisectingKMeans(k=k, seed=SEED).fit(df)


def assigned(model, df: DataFrame, name: str = "cluster") -> DataFrame:
    out = model.transform(df).withColumnRenamed("prediction", name)
    return out.select(*df.columns, name)


def choose_k(df: DataFrame, ks: Sequence[int], keys: Sequence[str], starts: int = 10, sample: int = 3000) -> DataFrame:
    """Cost, sampled silhouette and Davies-Bouldin for each number of clusters."""
    rows = []
    for k, model in best_runs(kmeans_runs(df, ks, starts, keys=keys)).items():
        labelled = assigned(model, df)
        arrays = labelled.withColumn("v", vector_to_array("features"))
        s = silhouette(arrays, "v", "cluster", keys, sample).first()["silhouette"]
        d = davies_bouldin(arrays, "v", "cluster").first()["davies_bouldin"]
        rows.append((k, model.cost, s, d))
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double, davies_bouldin double")


@dataclass
class Mixture:
    """A full-covariance mixture; `path` has the log-likelihood at the beginning of every round."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    path: list[float]
    settled: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def parameters(self) -> int:
        d = self.means.shape[1]
        return (self.k - 1) + self.k * d + self.k * d * (d + 1) // 2

    def logs(self, x: np.ndarray) -> np.ndarray:
        """(rows, components): log of weight times density."""
        out = []
        for w, m, c in zip(self.weights, self.means, self.covariances):
            low = np.linalg.cholesky(c)
            z = np.linalg.solve(low, (x - m).T)
            out.append(np.log(max(w, 1e-300)) - 0.5 * (len(m) * math.log(2 * math.pi) + (z * z).sum(axis=0)) - np.log(np.diag(low)).sum())
        return np.stack(out, axis=1)


def mixture_runs(df: DataFrame, ks: Sequence[int], max_iter: int = 100, tolerance: float = 1e-6, floor: float = 1e-6, keys: Sequence[str] = ()) -> tuple[list[Mixture], int]:
    """(mixtures, rows): expectation-maximisation for every number of components at once. A round is one scan, in which
    each task sums the moments of its rows' responsibilities for every mixture that still moves. It begins at k-means
    centres with the covariance of all rows and ends when the log-likelihood gains less than `tolerance` of itself."""
    axes, vectors = principal_axes(df), df.select(vector_to_array("features").alias("v"))
    n, d = df.count(), len(axes.means)
    spread = axes.covariance * max(n - 1, 1) / max(n, 1) + floor * np.eye(d)
    mixtures = [Mixture(np.maximum(r.sizes, 1) / np.maximum(r.sizes, 1).sum(), r.centres, np.repeat(spread[None], r.k, 0), []) for r in best_runs(kmeans_runs(df, ks, 1, 5, keys)).values()]
    for turn in range(max_iter + 1):
        open_ = [m for m in mixtures if not m.settled]
        if not open_:
            break
        for m, (ll, counts, sums, squares) in zip(open_, _responsible(vectors, open_, axes.means)):
            gain = ll - m.path[-1] if m.path else math.inf
            m.path.append(ll)
            m.settled = turn == max_iter or gain <= tolerance * abs(ll)
            if not m.settled:
                held = np.maximum(counts, 1e-12)
                mean = sums / held[:, None]
                m.weights, m.means = counts / counts.sum(), mean + axes.means
                m.covariances = squares / held[:, None, None] - mean[:, :, None] * mean[:, None, :] + floor * np.eye(d)
    return mixtures, n


def _responsible(vectors: DataFrame, mixtures: Sequence[Mixture], shift: np.ndarray) -> list[tuple]:
    """(log-likelihood, counts, sums, products around `shift`) of every mixture's responsibilities, from one scan."""
    d = len(shift)
    frozen = [Mixture(m.weights, m.means, m.covariances, []) for m in mixtures]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 + m.k * (1 + d + d * d)) for m in frozen]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.asarray(part.column(0).flatten()).reshape(part.num_rows, -1)
                for m, sums in zip(frozen, total):
                    logs = m.logs(x)
                    whole = np.logaddexp.reduce(logs, axis=1)
                    r, y = np.exp(logs - whole[:, None]), x - shift
                    products = [((y * r[:, [k]]).T @ y).ravel() for k in range(m.k)]
                    sums += np.concatenate([[whole.sum()], r.sum(axis=0), (r.T @ y).ravel(), *products])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.concatenate(total).tolist()], pa.list_(pa.float64()))], names=["one", "sums"])

    flat, out = np.array(summed(vectors.mapInArrow(gather, "one int, sums array<double>"), ["one"], "sums").first()["sums"]), []
    for m in mixtures:
        mine, flat = np.split(flat, [1 + m.k * (1 + d + d * d)])
        counts, sums, products = np.split(mine[1:], [m.k, m.k * (1 + d)])
        out.append((float(mine[0]), counts, sums.reshape(m.k, d), products.reshape(m.k, d, d)))
    return out


def gmm_bic(df: DataFrame, ks: Sequence[int], max_iter: int = 100, keys: Sequence[str] = ()) -> DataFrame:
    """Full-covariance mixtures and their BIC, with the rounds taken."""
    mixtures, n = mixture_runs(df, ks, max_iter, keys=keys)
    rows = [(m.k, m.path[-1], m.parameters, m.parameters * math.log(n) - 2.0 * m.path[-1], len(m.path) - 1) for m in mixtures]
    return df.sparkSession.createDataFrame(rows, "k int, log_likelihood double, parameters int, bic double, rounds int")


def pca_scores(df: DataFrame, k: int) -> DataFrame:
    """The feature vector replaced by its first k principal scores."""
    out = PCA(k=k, inputCol="features", outputCol="scores").fit(df).transform(df)
    return out.drop("features").withColumnRenamed("scores", "features")


@dataclass
class Axes:
    """Means, covariance (of a sample), its eigenvalues in falling order, and the axes as columns."""

    means: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def trace(self) -> float:
        return float(np.trace(self.covariance))

    def residuals(self) -> np.ndarray:
        """Length of C v - lambda v for every axis."""
        return np.linalg.norm(self.covariance @ self.vectors - self.vectors * self.values, axis=0)


def principal_axes(df: DataFrame) -> Axes:
    """From one scan: every task sums its rows' products around the first row's values, one row per task is shuffled,
    and the driver gets a matrix of the features. The sign of an axis is that of its largest loading."""
    first = df.select(vector_to_array("features").alias("v")).first()
    if first is None:
        return Axes(np.zeros(0), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    shift = np.array(first["v"], float)
    d = len(shift)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + d + d * d)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = np.asarray(part.column(0).flatten()).reshape(part.num_rows, -1) - shift
                total += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["one", "sums"])

    row = summed(df.select(vector_to_array("features").alias("v")).mapInArrow(gather, "one int, sums array<double>"), ["one"], "sums").first()
    sums = np.array(row["sums"])
    n, mean = sums[0], sums[1 : 1 + d] / sums[0]
    covariance = (sums[1 + d :].reshape(d, d) - n * np.outer(mean, mean)) / max(n - 1, 1)
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), range(d)])
    return Axes(mean + shift, covariance, values, vectors * np.where(signs == 0, 1.0, signs))


def pca_variance(df: DataFrame, k: int, share: float = 0.8) -> DataFrame:
    """(component, explained, cumulative, needed, variance, residual): `needed` marks the components that reach the share,
    `residual` says how well the axis solves its equation."""
    axes = principal_axes(df)
    left, total, rows = axes.residuals(), 0.0, []
    for i, v in enumerate(axes.values[:k]):
        explained = float(v) / axes.trace if axes.trace > 0 else 0.0
        rows.append((i + 1, explained, total + explained, total < share, float(v), float(left[i])))
        total += explained
    return df.sparkSession.createDataFrame(rows, "component int, explained double, cumulative double, needed boolean, variance double, residual double")


def pca_moments(df: DataFrame) -> DataFrame:
    """(i, j, covariance) for i <= j, and the trace as i = j = -1."""
    axes = principal_axes(df)
    rows = [(i, j, float(axes.covariance[i, j])) for i in range(len(axes.means)) for j in range(i, len(axes.means))]
    return df.sparkSession.createDataFrame([*rows, (-1, -1, axes.trace)], "i int, j int, covariance double")


def pca_loadings(df: DataFrame, k: int, names: Sequence[str]) -> DataFrame:
    """Loadings per component, the sign fixed so that the largest one is positive."""
    pc = principal_axes(df).vectors[:, :k]
    rows = [(j + 1, n, float(pc[i, j])) for j in range(pc.shape[1]) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "component int, variable string, loading double")


# ---- quality -------------------------------------------------------------------------------------


def silhouette(df: DataFrame, vector: str, cluster: str, keys: Sequence[str], sample: int = 3000, by_row: bool = False) -> DataFrame:
    """Mean Euclidean silhouette over a sample of at most `sample` rows (all rows when there are fewer).

    The sample, bounded by that size, goes to every task; each task measures its own rows against it.
    """
    rows = hash_sample(df.select(*keys, F.col(vector).cast("array<double>").alias("v"), F.col(cluster).cast("bigint").alias("c")),
                       keys, SEED, F.least(F.col("n_total"), F.lit(sample)))
    held = rows.select("v", "c").limit(sample).toPandas()
    points = np.array(held["v"].tolist(), dtype=float)
    labels = held["c"].to_numpy()
    shared = df.sparkSession.sparkContext.broadcast((points, labels))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pts, lab = shared.value
        kinds, sizes = np.unique(lab, return_counts=True)
        member = (lab[:, None] == kinds[None, :]).astype(float)
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.array(pdf["v"].tolist(), dtype=float)
            sq = (x**2).sum(1)[:, None] + (pts**2).sum(1)[None, :] - 2.0 * x @ pts.T
            sums = np.sqrt(np.clip(sq, 0.0, None)) @ member
            own = np.searchsorted(kinds, pdf["c"].to_numpy())
            at = np.arange(len(pdf))
            inside = sizes[own] - 1
            a = sums[at, own] / np.maximum(inside, 1)
            means = sums / sizes[None, :]
            means[at, own] = np.inf
            b = means.min(1)
            top = np.maximum(a, b)
            s = np.where((inside > 0) & np.isfinite(b) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)
            yield pdf[list(keys)].assign(silhouette=s)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", silhouette double"
    each = rows.mapInPandas(measure, schema)
    return each if by_row else each.agg(F.avg("silhouette").alias("silhouette"))


def _long_vector(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    return df.select(*keep, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "value"))


def _centroids(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    means = _long_vector(df, vector, cluster).groupBy(cluster, "dim").agg(F.avg("value").alias("m"))
    return means.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda e: e.m).alias("centre"))


def _distance(a, b):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, q: s + q))


def davies_bouldin(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Mean over clusters of the worst (s_i + s_j) / d_ij. The table of centres has one row per cluster."""
    centres = _centroids(df, vector, cluster)
    spread = df.join(centres, cluster).groupBy(cluster).agg(
        F.avg(_distance(F.col(vector).cast("array<double>"), F.col("centre"))).alias("s")
    )
    table = centres.join(spread, cluster).select(F.struct(F.col(cluster).alias("c"), "centre", "s").alias("e"))
    every = table.agg(F.collect_list("e")).scalar()
    with_others = table.withColumn("others", every).select("e", F.explode("others").alias("o")).filter(F.col("e.c") != F.col("o.c"))
    d = _distance(F.col("e.centre"), F.col("o.centre"))
    worst = with_others.groupBy("e.c").agg(F.max(ratio(F.col("e.s") + F.col("o.s"), d)).alias("w"))
    return worst.agg(F.avg("w").alias("davies_bouldin"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two partitions from the counts of their contingency table."""
    cells = df.groupBy(a, b).agg(F.count("*").cast("double").alias("n"))

    def pairs(c: str):
        return F.sum(F.col(c) * (F.col(c) - 1) / 2)

    both = cells.agg(pairs("n").alias("ij"), F.sum("n").alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(pairs("n")).scalar()
    columns = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(pairs("n")).scalar()
    out = both.withColumn("a", rows).withColumn("b", columns)
    expected = ratio(F.col("a") * F.col("b"), F.col("n") * (F.col("n") - 1) / 2)
    top = (F.col("a") + F.col("b")) / 2
    return out.select(F.coalesce(ratio(F.col("ij") - expected, top - expected), F.lit(1.0)).alias("adjusted_rand"))


# ---- profiles ------------------------------------------------------------------------------------


def profile_naming(df: DataFrame, cluster: str, level: str, size: str) -> DataFrame:
    """Order and name of each cluster: by median level; lowest, highest, and in between large or small units.

    A cluster in between counts as large when its median size is at least the median of the medians.
    """
    m = medians(df, [level, size], [cluster])
    order = Window.orderBy(level, cluster)
    # One row per cluster from here on.
    ranked = m.withColumn("rank", F.row_number().over(order)).withColumn("k", F.count("*").over(Window.partitionBy()))
    middle = m.agg(F.percentile(size, F.lit(0.5))).scalar()
    name = (
        F.when(F.col("rank") == 1, "lowest level").when(F.col("rank") == F.col("k"), "highest level")
        .when(F.col("size_gap") >= 0, "middle level, large").otherwise("middle level, small")
    )
    return ranked.withColumn("size_gap", F.col(size) - middle).select(cluster, "rank", level, size, name.alias("name"))


def profile_signature(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Cluster medians on the standardised scale of all rows: long (cluster, variable, value)."""
    stats = df.agg(*[F.avg(c).alias(f"{c}__m") for c in columns], *[F.stddev_pop(c).alias(f"{c}__s") for c in columns]).first()
    m = medians(df, columns, [cluster])
    cells = F.array(*[
        F.struct(F.lit(c).alias("variable"), ((F.col(c) - F.lit(stats[f"{c}__m"])) / F.lit(stats[f"{c}__s"] or 1.0)).alias("value"))
        for c in columns
    ])
    return m.select(cluster, F.explode(cells).alias("e")).select(cluster, "e.*")


def profile_matrix(df: DataFrame, cluster: str, risk: str, columns: Sequence[str]) -> DataFrame:
    sums = df.groupBy(cluster).agg(
        F.count("*").alias("n"), round_even(F.avg(risk), 4).alias("mean_risk"),
        round_even(ratio(100.0 * F.count_if(F.col(risk) >= 0.5), F.count(risk)), 1).alias("at_risk_pct"),
    )
    return sums.join(medians(df, columns, [cluster]), cluster, "left")


# ---- density clusters ----------------------------------------------------------------------------

_BLOCK = ["home", "home_chunk", "at", "chunk"]


def distinct_points(df: DataFrame, vector: str, key: str) -> DataFrame:
    """(id, v, m): one row per distinct vector with its smallest id and its number of copies."""
    known = df.select(F.col(vector).cast("array<double>").alias("v"), F.col(key).cast("bigint").alias("id")).filter("v is not null")
    return known.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("m"))


def _for_rows(df: DataFrame, vector: str, key: str, found: DataFrame, name: str) -> DataFrame:
    """(id, `name`): what was found for a vector (v, `name`), for all rows that have it. Rows are ordered by a hash of the
    vector, as comparing long arrays is slow."""
    rows = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows, found = (side.withColumn("h", F.xxhash64("v")) for side in (rows, found))
    return rows.join(found, ["h", "v"]).select("id", name)


def _widest(points: DataFrame, axes: int) -> list[int]:
    spans = _long_vector(points, "v").groupBy("dim").agg(F.variance("value").alias("s")).orderBy(F.desc("s"), "dim").limit(axes)
    return [r["dim"] for r in spans.collect()]


def _celled(points: DataFrame, width: float, dims: Sequence[int]) -> DataFrame:
    """Points with their cell: two points within `width` differ by at most `width` on every axis, so they lie in the same
    or in neighbouring cells of a grid over the widest axes."""
    return points.withColumn("cell", F.array(*[F.floor(F.col("v")[d] / F.lit(width)).cast("bigint") for d in dims]))


def _chunks(celled: DataFrame) -> DataFrame:
    """(cell, chunks): a crowded cell is cut into chunks of bounded size, in rows and in values."""
    rows, values = F.count("*") / F.lit(BLOCK_ROWS), F.sum(F.size("v")) / F.lit(BLOCK_VALUES)
    return stored(celled.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(rows).cast("int"), F.ceil(values).cast("int")).alias("chunks")), "cells")


def _renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def _per_block(asking: DataFrame, targets: DataFrame | None, axes: int, work, schema: str) -> DataFrame:
    """Runs `work(asking rows, target rows)` for every block: a chunk of a cell and a chunk of a cell nearby, each of about
    BLOCK_ROWS rows and BLOCK_VALUES values at most. Blocks are found on the tables of cells, so a point is copied once per block it takes part in.
    Without targets the points meet each other, and of two mirrored blocks only one is run. A point goes to its blocks
    with the block's number alone: cells are arrays, slow to sort by and to hand to a task for every row.
    """
    homes = _chunks(asking)
    ats = homes if targets is None else _chunks(targets)
    near = homes.select(F.col("cell").alias("home"), F.col("chunks").alias("home_chunks"), F.array().cast("array<bigint>").alias("at"))
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    for i in range(axes):
        near = near.select("home", "home_chunks", F.explode(steps).alias("d"), "at").select(
            "home", "home_chunks", F.concat("at", F.array(F.col("home")[i] + F.col("d"))).alias("at"))
    met = near.join(ats.select(F.col("cell").alias("at"), "chunks"), "at")
    blocks = met.withColumn("home_chunk", F.explode(F.sequence(F.lit(0), F.col("home_chunks") - 1))).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    if targets is None:
        blocks = blocks.filter(F.struct("home", "home_chunk") <= F.struct(F.col("at").alias("home"), F.col("chunk").alias("home_chunk")))
    blocks = stored(blocks.select(*_BLOCK, F.monotonically_increasing_id().alias("block")), "blocks")

    def placed(points: DataFrame, sizes: DataFrame) -> DataFrame:
        return points.join(sizes, "cell").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).drop("chunks")

    left = _renamed(placed(asking, homes), cell="home", chunk="home_chunk").join(blocks, ["home", "home_chunk"]).drop(*_BLOCK)
    right = _renamed(placed(asking if targets is None else targets, ats), cell="at").join(_renamed(blocks), ["at", "chunk"]).drop(*_BLOCK)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return pa.Table.from_pandas(work(_frame(a), _frame(b)), preserve_index=False)

    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)


def _frame(rows: pa.Table) -> pd.DataFrame:
    """Rows of a block. Their vectors are taken out as one array, not one by one."""
    v, out = rows.column("v").combine_chunks(), rows.drop_columns(["v"]).to_pandas()
    sizes = np.unique(v.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of {sizes.tolist()} values")
    return out.assign(v=list(v.flatten().to_numpy(zero_copy_only=False).reshape(len(out), *sizes)) if len(out) else [])


def _points(pdf: pd.DataFrame) -> np.ndarray:
    return np.array(pdf["v"].tolist(), dtype=float)


def _exact(x: np.ndarray, y: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the pairs (x[r], y[c])."""
    out = np.empty(len(r))
    for i in range(0, len(r), PAIRS):
        diff = x[r[i : i + PAIRS]] - y[c[i : i + PAIRS]]
        out[i : i + PAIRS] = np.sqrt((diff * diff).sum(axis=1))
    return out


def _squares(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray, float]]:
    """Tiles of squared distances by matrix products: (first row of x, tile, bound of its error). Where squares leave the
    range of doubles the bound is infinite, and all pairs of a tile have to be measured."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    right = np.hstack([-2.0 * y, yy[:, None], np.ones((len(y), 1))]).T.copy()
    left = np.hstack([x, np.ones((len(x), 1)), xx[:, None]])
    top = yy.max(initial=0.0)
    rows = max(1, TILE_VALUES // max(1, len(y)))
    for i in range(0, len(x), rows):
        bound = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (xx[i : i + rows].max() + top)
        if np.isfinite(bound):
            yield i, left[i : i + rows] @ right, bound
        else:
            yield i, np.zeros((len(left[i : i + rows]), len(y))), np.inf


def _by_place(x: np.ndarray) -> np.ndarray:
    """An order of the rows by the nearest of a few of them, so that near rows share tiles."""
    pivots = x[:: -(-len(x) // PIVOTS)]
    with np.errstate(over="ignore", invalid="ignore"):
        return np.argsort(((pivots * pivots).sum(axis=1) - 2.0 * x @ pivots.T).argmin(axis=1), kind="stable")


def _sides(a: pd.DataFrame, b: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, pd.DataFrame, np.ndarray]:
    """Both sides of a block and their vectors, near rows together. Chunks are the same or share no point; those of the
    same chunk are one array."""

    def ordered(side):
        x = _points(side)
        order = _by_place(x)
        return side.iloc[order], x[order]

    a, x = ordered(a)
    return (a, x, a, x) if a["id"].min() == b["id"].min() else (a, x, *ordered(b))


def _far(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """(tiles of x, tiles of y): whether no pair of theirs is within eps, as the balls around them are further apart."""

    def balls(side, rows):
        tiles = [side[i : i + rows] for i in range(0, len(side), rows)]
        centres = np.array([t.mean(axis=0) for t in tiles]).reshape(len(tiles), side.shape[1])
        return centres, np.array([np.sqrt(((t - c) ** 2).sum(axis=1).max()) for t, c in zip(tiles, centres)])

    with np.errstate(over="ignore", invalid="ignore"):
        (at, reach), (to, width) = balls(x, TILE_ROWS), balls(y, TILE_COLUMNS)
        gaps = np.array([np.sqrt(((to - c) ** 2).sum(axis=1)) for c in at]).reshape(len(at), len(to))
        return gaps * (1.0 - 1e-9) > (reach[:, None] + width + eps) * (1.0 + 1e-9)


def _small_tiles(x: np.ndarray, y: np.ndarray, square: float, skipped: Callable[[slice, slice], bool] = lambda *_: False) -> Iterator[tuple[int, int, np.ndarray, float]]:
    """Tiles of squared distances: (first row of x, of y, tile, bound of its error). They come from single precision where
    that is sure enough beside `square`, else from doubles; where those overflow, the bound is infinite."""

    def sides(x, xx, y, yy):
        return np.hstack([x, np.ones((len(x), 1)), xx[:, None]]), np.hstack([-2.0 * y, yy[:, None], np.ones((len(y), 1))])

    with np.errstate(over="ignore", invalid="ignore"):
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
        left, right = (side.astype(np.float32) for side in sides(x, xx, y, yy))
    panels = [(j, right[j : j + TILE_COLUMNS].T.copy(), yy[j : j + TILE_COLUMNS].max()) for j in range(0, len(y), TILE_COLUMNS)]
    single, double = (float(np.finfo(t).eps) for t in (np.float32, float))
    for i in range(0, len(x), TILE_ROWS):
        rows, top = slice(i, i + TILE_ROWS), xx[i : i + TILE_ROWS].max()
        for j, panel, most in panels:
            if skipped(rows, slice(j, j + TILE_COLUMNS)):
                continue
            reach = 8.0 * (x.shape[1] + 4) * float(top + most)
            if 1e-20 < square < 1e30 and reach * single <= square / 16:
                yield i, j, left[rows] @ panel, reach * single
            elif math.isfinite(reach):
                columns = slice(j, j + TILE_COLUMNS)
                l, r = sides(x[rows], xx[rows], y[columns], yy[columns])
                yield i, j, l @ r.T, reach * double
            else:
                yield i, j, np.zeros((len(left[rows]), panel.shape[1])), math.inf


def _pairs_within(x: np.ndarray, y: np.ndarray, eps: float, kinds: Callable[[slice, slice], tuple[np.ndarray, np.ndarray]] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of x and of y at most eps apart, in lots; pairs too close to eps for a matrix product are measured. If y is x, of
    two mirrored tiles one is run. `kinds` of some rows of x and of y says what the caller has no use for: rows of the same
    kind, whose pairs may be left out. It is asked anew for each tile, so a caller that learns from a lot gets fewer."""
    square, held, n = eps * eps, [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    far, mirrored = _far(x, y, eps), x is y and TILE_ROWS == TILE_COLUMNS

    def skipped(rows: slice, columns: slice) -> bool:
        if far[rows.start // TILE_ROWS, columns.start // TILE_COLUMNS] or mirrored and columns.start < rows.start:
            return True
        if kinds is None:
            return False
        mine, theirs = kinds(rows, columns)
        return mine[0] == theirs[0] and bool((mine == mine[0]).all() and (theirs == mine[0]).all())

    for i, j, squares, bound in _small_tiles(x, y, square, skipped):
        bound += 1e-14 * square
        hit = squares <= square + bound
        if kinds is not None and np.count_nonzero(hit) > CROWD:
            mine, theirs = kinds(slice(i, i + TILE_ROWS), slice(j, j + TILE_COLUMNS))
            hit &= mine[:, None] != theirs
        rows = np.flatnonzero(hit.any(axis=1))
        if not len(rows):
            continue
        r, c = np.divmod(np.flatnonzero(hit[rows].ravel()), hit.shape[1])
        r = rows[r]
        doubt = ~(squares[r, c] <= square - bound)
        r, c = r + i, c + j
        if doubt.any():
            keep = ~doubt
            keep[doubt] = _exact(x, y, r[doubt], c[doubt]) <= eps
            r, c = r[keep], c[keep]
        if mirrored and i != j:
            r, c = np.r_[r, c], np.r_[c, r]
        held.append((r, c))
        n += len(r)
        if n >= PAIRS:
            yield tuple(np.concatenate(side) for side in zip(*held))
            held, n = held[:1], 0
    yield tuple(np.concatenate(side) for side in zip(*held))


def _neighbours(celled: DataFrame, axes: int, eps: float, least: int = 0) -> DataFrame:
    """(id, n, near): a point's neighbours in a block (n, near is the point itself), and each neighbour of a point that has
    fewer than `least` there (near, n is 0). A point with fewer than `least` in all thus has all its neighbours named.
    Two points of `least` each are not compared further, so from `least` on n says no more than that; without `least` it
    is exact."""

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"id": [], "n": [], "near": []}).astype("int64")
        a, x, b, y = _sides(a, b)
        (ids_a, m_a), (ids_b, m_b) = ((side["id"].to_numpy(), side["m"].to_numpy()) for side in (a, b))
        of_a, of_b = np.zeros(len(a)), np.zeros(len(b))

        def kinds(rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
            return np.where(of_a[rows] >= least, 0, 1), np.where(of_b[columns] >= least, 0, 2)

        few = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        for r, c in _pairs_within(x, y, eps, kinds if least else None):
            of_a += np.bincount(r, weights=m_b[c], minlength=len(a))
            of_b += np.bincount(c, weights=m_a[r], minlength=len(b))
            # Counts only rise, so a point keeps fewer than `least` pairs.
            keep = (of_a[r] < least) | (of_b[c] < least)
            few.append((r[keep], c[keep]))
        r, c = (np.concatenate(side) for side in zip(*few))
        mine = of_a[r] < least
        if x is y:
            counted, n, named, near = ids_a, of_a, ids_a[r[mine]], ids_b[c[mine]]
        else:
            theirs, met_a, met_b = of_b[c] < least, of_a > 0, of_b > 0
            counted, n = np.r_[ids_a[met_a], ids_b[met_b]], np.r_[of_a[met_a], of_b[met_b]]
            named, near = np.r_[ids_a[r[mine]], ids_b[c[theirs]]], np.r_[ids_b[c[mine]], ids_a[r[theirs]]]
        return pd.DataFrame({"id": np.r_[counted, named], "n": np.r_[n, np.zeros(len(named))].astype("int64"), "near": np.r_[counted, near]})

    return _per_block(celled, None, axes, count, "id bigint, n bigint, near bigint")


def neighbour_counts(df: DataFrame, vector: str, key: str, eps: float, axes: int = 3) -> DataFrame:
    """(id, n): points within eps of each distinct point, itself and its copies included. Blocks return counts, not pairs."""
    points = stored(distinct_points(df, vector, key), "points")
    dims = _widest(points, axes)
    return _neighbours(_celled(points, eps, dims), len(dims), eps).groupBy("id").agg(F.sum("n").alias("n"))


def _hooked(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Parents, all of them roots, after joining the trees of u and v; a root is the smallest of its tree."""
    while len(u):
        pu, pv = parent[u], parent[v]
        apart = pu != pv
        u, v = u[apart], v[apart]
        np.minimum.at(parent, np.maximum(pu, pv)[apart], np.minimum(pu, pv)[apart])
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    return parent


def dbscan(df: DataFrame, vector: str, key: str, eps: float, min_points: int, axes: int = 3) -> DataFrame:
    """(id, cluster): the smallest core id of the cluster, -1 for noise.

    A border point joins the cluster with the smallest id among its core neighbours. Copies of a point count
    as neighbours of each other but are measured once. All points are compared once, for their counts; what is no core has
    its few neighbours from there, and only cores are compared again.
    """
    points = stored(distinct_points(df, vector, key), "points")
    dims = _widest(points, axes)
    celled = _celled(points, eps, dims)
    near = stored(_neighbours(celled, len(dims), eps, min_points), "neighbours")
    counts = near.groupBy("id").agg((F.sum("n") >= min_points).alias("core"))
    placed = stored(celled.join(counts, "id"), "core")
    cores = placed.filter("core")

    def link(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        """Enough edges to keep the connections of a block: at most one per point, however dense the block."""
        ids = np.union1d(a["id"].to_numpy(), b["id"].to_numpy())
        tree = np.arange(len(ids))
        if len(a) and len(b):
            a, x, b, y = _sides(a, b)
            at_a, at_b = np.searchsorted(ids, a["id"].to_numpy()), np.searchsorted(ids, b["id"].to_numpy())
            for r, c in _pairs_within(x, y, eps, lambda rows, columns: (tree[at_a[rows]], tree[at_b[columns]])):
                tree = _hooked(tree, at_a[r], at_b[c])
        held = np.flatnonzero(tree != np.arange(len(ids)))
        return pd.DataFrame({"a": ids[held], "b": ids[tree[held]]}).astype("int64")

    labels = stored(connected_components(cores.select("id"), _per_block(cores, None, len(dims), link, "a bigint, b bigint")), "labels")

    # The cores near a core are of its own component.
    touched = near.filter("near <> id").select("id", "near").join(_renamed(labels, id="near"), "near").select("id", "component")
    joined = touched.unionByName(labels).groupBy("id").agg(F.min("component").alias("component"))
    found = placed.select("id", "v").join(joined, "id", "left").select("v", F.coalesce("component", F.lit(-1)).alias("cluster"))
    return _for_rows(df, vector, key, found, "cluster")


def noise_share(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        round_even(ratio(F.lit(100.0) * F.count_if(F.col("cluster") < 0), F.count("*")), 1).alias("noise_pct"),
    )


def eps_grid(df: DataFrame, vector: str, key: str, grid: Sequence[float], min_points: int) -> DataFrame:
    """Number of clusters and noise share for each eps."""
    parts = [noise_share(dbscan(df, vector, key, e, min_points)).withColumn("eps", F.lit(float(e))) for e in grid]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _nearest(a: pd.DataFrame, b: pd.DataFrame, k: int, limit: float) -> pd.DataFrame:
    """(id, d): per row of a the k smallest distances to rows of b, copies counted, none above `limit`."""
    ids, out = [np.empty(0, np.int64)], [np.empty(0)]
    if len(a) and len(b):
        x, y, copies = _points(a), _points(b), np.minimum(b["m"].to_numpy(), k)
        # The k-th smallest of the minima of at least k groups of columns is no less than the k-th smallest of all.
        groups = max(64, 4 * k)
        for i, squares, bound in _squares(x, y):
            cap = np.full(len(squares), limit * limit)
            if len(y) >= groups:
                minima = squares[:, : len(y) // groups * groups].reshape(len(squares), -1, groups).min(axis=1)
                cap = np.minimum(cap, np.partition(minima, k - 1, axis=1)[:, k - 1])
            cap += 2.0 * bound + 1e-14 * cap
            r, c = np.divmod(np.flatnonzero((squares <= cap[:, None]).ravel()), len(y))
            d = _exact(x, y, r + i, c)
            inside = d <= limit
            r, c, d = r[inside], c[inside], d[inside]
            order = np.lexsort((d, r))
            r, d, n = r[order], d[order], copies[c[order]]
            before = np.cumsum(n) - n
            starts = np.flatnonzero(np.diff(r, prepend=-1))
            before -= np.repeat(before[starts], np.diff(np.r_[starts, len(r)]))
            n = np.clip(k - before, 0, n)
            ids.append(np.repeat(a["id"].to_numpy()[r + i], n))
            out.append(np.repeat(d, n))
    return pd.DataFrame({"id": np.concatenate(ids).astype("int64"), "d": np.concatenate(out)})


def _kth(near: DataFrame, k: int) -> DataFrame:
    best = near.groupBy("id").agg(F.array_sort(F.collect_list("d")).alias("d")).filter(F.size("d") >= k)
    return best.select("id", F.element_at("d", k).alias("distance"))


def _usual_reach(points: DataFrame, k: int) -> float:
    """A little more than the distance that nearly all of a few points, lowest in hash order, have to their k-th nearest."""
    asked = points.orderBy(F.xxhash64("id"), "id").limit(REACH_POINTS).toPandas()

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield _nearest(asked, batch, k, math.inf)

    found = [r["distance"] for r in _kth(points.mapInPandas(nearest, "id bigint, d double"), k).collect()]  # one row per point asked
    found = [d for d in found if math.isfinite(d)]
    return 1.05 * float(np.quantile(found, 0.98)) if found else 0.0


def k_distances(df: DataFrame, vector: str, key: str, k: int, radius: float, axes: int = 3) -> DataFrame:
    """(id, distance) to the k-th nearest point, the point itself being the first.

    Blocks return at most k distances per point. The first radius is `radius`, or what a few points need if that is more. A
    point with fewer than k neighbours within it is asked again with a doubled radius, so the result is exact for any first
    radius.
    """
    points = stored(distinct_points(df, vector, key), "points")
    k = min(k, points.agg(F.sum("m")).first()[0] or 0)
    dims = _widest(points, axes)
    radius = max(radius, _usual_reach(points, k)) if k else radius
    todo, found = points.select("id"), []

    def nearest_within(limit: float):
        return lambda a, b: _nearest(a, b, k, limit)

    while True:
        celled = _celled(points, radius, dims)
        near = _per_block(celled.join(todo, "id"), celled, len(dims), nearest_within(radius), "id bigint, d double")
        found.append(stored(_kth(near, k), "k-distance"))
        todo = stored(todo.join(found[-1], "id", "left_anti"), "k-left")
        if todo.limit(1).count() == 0:
            break
        radius *= 2.0
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    mine = points.join(every, "id").select("v", "distance")
    return _for_rows(df, vector, key, mine, "distance")
