"""Linear models of all folds at once: one scan collects moments, or one scan per Newton step serves every model.

A preprocessed feature is linear in a fixed basis: the known value (0 where it misses), whether it misses, and whether a
category has a level. What a fold learns (median, mean, deviation) only changes the linear map from that basis to the
features. So the rows are read as basis vectors, and a fold's model is solved from sums over the rows of its training
part, which are the sums of all rows less those of the fold.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import summed
from ..operators.ordered import range_count
from ..session import stored
from .prep import MAX_CATEGORIES, MISSING

# Task functions travel with their helpers, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY, BASIS = "__key", "__basis"
# Rows that place the edges of score ranges, rows of a range, and rows that a task scores at once.
EDGE_ROWS, RANGE_ROWS, HELD_ROWS = 20_000, 2_000_000, 200_000


# ---- medians of complements -----------------------------------------------------------------------


def complement_medians(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, variable, median): exact median of each column over the rows outside each group; a null `by` has all rows.

    Rows collapse to counts per (value range, value, group). The counts per range tell in which range a complement's
    middle lies; only those ranges are opened, so no row is copied once per group. Groups that hold no value of a
    column have no row for it: their complement is all rows.
    """
    n = range_count(df.sparkSession)
    wide = df.select(F.col(by).cast("string").alias(by), *[F.col(c).cast("double").alias(c) for c in columns])
    cuts = wide.approxQuantile(list(columns), [i / n for i in range(1, n)], max(1e-4, 0.25 / n))
    splits = [[float("-inf"), *sorted(set(found)), float("inf")] for found in cuts]
    spots = [f"{c}__range" for c in columns]
    cut = Bucketizer(splitsArray=splits, inputCols=list(columns), outputCols=spots, handleInvalid="keep").transform(wide)
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(s).cast("int").alias("range"), F.col(c).alias("value")) for c, s in zip(columns, spots)])
    long = cut.select(by, F.explode(cells).alias("cell")).select(by, "cell.*").filter("value is not null")
    counts = stored(long.groupBy("variable", "range", "value", by).agg(F.count("*").alias("n")), "value-counts")

    per_range = stored(counts.groupBy("variable", "range", by).agg(F.sum("n").alias("n")), "range-counts")
    whole = per_range.groupBy("variable", "range").agg(F.sum("n").alias("t"))
    left = per_range.filter(F.col(by).isNotNull()).select("variable", by).distinct()
    left = left.unionByName(whole.select("variable", F.lit(None).cast("string").alias(by)).distinct())
    dense = left.join(whole, "variable").join(per_range, ["variable", "range", by], "left").withColumn("c", F.col("t") - F.coalesce("n", F.lit(0)))
    of = Window.partitionBy("variable", by)
    placed = dense.withColumn("before", F.coalesce(F.sum("c").over(of.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("all", F.sum("c").over(of))
    middles = F.explode(F.array(F.floor((F.col("all") - 1) / 2), F.floor(F.col("all") / 2)))
    asked = placed.filter("all > 0").select("variable", "range", by, "before", "c", middles.alias("at"))
    asked = stored(asked.filter("at >= before and at < before + c").select("variable", "range", F.col(by).alias("left_out"), (F.col("at") - F.col("before")).alias("at")), "middles")

    def pick(_key, values, wanted):
        values = values.sort_by("value")
        value, count, group = values["value"].to_numpy(), values["n"].to_numpy(), np.array(values[by].to_pylist(), object)
        found, names = [], wanted["left_out"].to_pylist()
        for name, at in zip(names, wanted["at"].to_pylist()):
            ends = np.cumsum(np.where(group == name, 0, count) if name is not None else count)
            found.append(float(value[np.searchsorted(ends, at, side="right")]))
        return pa.table({"variable": wanted["variable"], by: pa.array(names, pa.string()), "value": pa.array(found, pa.float64())})

    opened = counts.join(asked.select("variable", "range").distinct(), ["variable", "range"], "left_semi")
    ends = opened.groupBy("variable", "range").cogroup(asked.groupBy("variable", "range")).applyInArrow(pick, f"variable string, `{by}` string, value double")
    return ends.groupBy(by, "variable").agg(F.avg("value").alias("median"))


# ---- basis ----------------------------------------------------------------------------------------


@dataclass
class Basis:
    """Expressions of the basis, and what the features are made of. Known values are centred and scaled by fixed numbers,
    which changes no model but keeps sums small."""

    numbers: list[str]
    logged: set[str]
    history: set[str]
    levels: list[tuple[str, str]]
    centre: dict[str, float]
    scale: dict[str, float]

    @property
    def width(self) -> int:
        return 2 * len(self.numbers) + len(self.levels)

    @property
    def names(self) -> list[str]:
        gaps = [f"{MISSING}{c}" for c in self.numbers if c in self.history]
        return [*self.numbers, *gaps, *[f"{c}_{v}" for c, v in self.levels]]

    def value(self, c: str) -> Column:
        x = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double"))
        return F.when(x.isNotNull(), F.log1p(F.greatest(x, F.lit(0.0)))) if c in self.logged else x

    def column(self) -> Column:
        known = [F.coalesce((self.value(c) - self.centre[c]) / self.scale[c], F.lit(0.0)) for c in self.numbers]
        missing = [self.value(c).isNull().cast("double") for c in self.numbers]
        held = [(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan")) == v).cast("double") for c, v in self.levels]
        return F.array(*known, *missing, *held)

    def features(self, medians: Mapping[str, float], n: float, sums: np.ndarray, squares: np.ndarray) -> np.ndarray:
        """(1 + width, 1 + features): from (1, basis) to (1, features), given what a training part holds."""
        k = len(self.numbers)
        out = np.zeros((1 + self.width, 1 + len(self.names)))
        out[0, 0] = 1.0
        n = max(n, 1.0)

        def put(at: int, parts: list[tuple[int, float]], mean: float, square: float) -> None:
            spread = square - mean * mean
            spread = np.sqrt(spread) if spread > 1e-12 * max(1.0, square) else 1.0
            out[0, at] = -mean / spread
            for row, factor in parts:
                out[1 + row, at] = factor / spread

        at = 1
        for i, c in enumerate(self.numbers):
            if c in medians:
                m = np.log1p(max(medians[c], 0.0)) if c in self.logged else medians[c]
                fill = (m - self.centre[c]) / self.scale[c]
                put(at, [(i, 1.0), (k + i, fill)], (sums[i] + fill * sums[k + i]) / n, (squares[i] + fill * fill * squares[k + i]) / n)
            at += 1
        for i, c in enumerate(self.numbers):
            if c in self.history:
                put(at, [(k + i, 1.0)], sums[k + i] / n, squares[k + i] / n)
                at += 1
        for j in range(len(self.levels)):
            out[1 + 2 * k + j, at + j] = 1.0
        return out


def learn_basis(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> Basis:
    history, log, numbers, categories = (list(groups.get(g, ())) for g in ("history", "log", "numbers", "categories"))
    basis = Basis([*history, *log, *numbers], set(log), set(history), [], {}, {})
    if basis.numbers:
        row = df.agg(*[F.avg(basis.value(c)).alias(f"m{i}") for i, c in enumerate(basis.numbers)],
                     *[F.stddev_pop(basis.value(c)).alias(f"s{i}") for i, c in enumerate(basis.numbers)]).first()
        basis.centre = {c: row[f"m{i}"] or 0.0 for i, c in enumerate(basis.numbers)}
        basis.scale = {c: row[f"s{i}"] or 1.0 for i, c in enumerate(basis.numbers)}
    for c in categories:
        found = [r[0] for r in df.select(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("nan"))).distinct().limit(MAX_CATEGORIES + 1).collect()]
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"more than {MAX_CATEGORIES} categories in one column")
        basis.levels += [(c, v) for v in sorted(found)]
    return basis


def _medians(df: DataFrame, basis: Basis, by: str) -> DataFrame:
    """(by, medians): the map of all medians of each complement; the null row has those of all rows."""
    clean = df.select(by, *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in basis.numbers])
    return complement_medians(clean, basis.numbers, by).groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("variable", "median"))).alias("medians"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(rows, -1)


# ---- ridge ----------------------------------------------------------------------------------------


def _moments(df: DataFrame, basis: Basis, target: str, key: str, weight: str | None) -> DataFrame:
    """(key, sums): n, sums and squares of the basis, then the weighted Gram matrix of (1, basis, y), per group; one row
    per group and task is shuffled."""
    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(key).cast("string").alias("key"), basis.column().alias("b"), F.col(f"`{target}`").cast("double").alias("y"), w.alias("w")).filter(
        "key is not null and y is not null and w is not null")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            b = _matrix(batch.column(1), batch.num_rows)
            y, weights = (np.asarray(batch.column(c)) for c in (2, 3))
            coded = batch.column(0).dictionary_encode()
            code = np.asarray(coded.indices)
            for k, name in enumerate(coded.dictionary.to_pylist()):
                at = np.flatnonzero(code == k)
                x = np.hstack([np.ones((len(at), 1)), b[at], y[at, None]])
                found = np.concatenate([[len(at)], b[at].sum(axis=0), (b[at] ** 2).sum(axis=0), ((x * weights[at, None]).T @ x).ravel()])
                total[name] = total[name] + found if name in total else found
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["key", "sums"])

    return summed(rows.mapInArrow(gather, "key string, sums array<double>"), ["key"], "sums")


def ridge_models(df: DataFrame, groups: Mapping, target: str, by: str, alpha: float, weight: str | None = None) -> tuple[Basis, DataFrame]:
    """The basis, and (key, n, theta, names, coefficients, intercept): for each group the ridge model of all other rows.

    theta is the model over (1, basis), `coefficients` that over the standardised features. The penalty `alpha` falls on
    the features, not on the intercept. Groups are solved where their sums are; only the sums of all rows, whose size is
    the square of the number of features, go to every task.
    """
    known = df.filter(F.col(by).isNotNull() & F.col(f"`{target}`").isNotNull())
    basis = learn_basis(known, groups)
    sums = stored(_moments(known, basis, target, by, weight), "moments")
    whole = summed(sums.select(F.lit(0).alias("one"), "sums"), ["one"], "sums").first()
    total = np.array(whole["sums"]) if whole else np.zeros(1)
    plan = sums
    if basis.numbers:
        middles = stored(_medians(known.select(F.col(by).cast("string").alias("key"), *[F.col(f"`{c}`") for c in basis.numbers]), basis, "key"), "medians")
        everywhere = next((r["medians"] for r in middles.filter("key is null").collect()), {})
        plan = sums.join(middles.filter("key is not null"), "key", "left")
    else:
        everywhere = {}
        plan = sums.withColumn("medians", F.lit(None).cast("map<string,double>"))
    p = basis.width

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                left = total - np.array(row["sums"])
                n = left[0]
                gram = left[1 + 2 * p:].reshape(p + 2, p + 2)
                # A column that this group does not know keeps the median of all rows.
                to = basis.features({**everywhere, **dict(row["medians"] or [])}, n, left[1:1 + p], left[1 + p:1 + 2 * p])
                penalty = alpha * np.eye(to.shape[1])
                penalty[0, 0] = 0.0
                normal = to.T @ gram[:-1, :-1] @ to + penalty
                beta = np.linalg.lstsq(normal, to.T @ gram[:-1, -1], rcond=None)[0] if n > 0 else np.zeros(to.shape[1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["key"]], pa.string()), pa.array([int(n)], pa.int64()), pa.array([(to @ beta).tolist()], pa.list_(pa.float64())),
                    pa.array([basis.names], pa.list_(pa.string())), pa.array([beta[1:].tolist()], pa.list_(pa.float64())), pa.array([float(beta[0])])],
                    names=["key", "n", "theta", "names", "coefficients", "intercept"])

    return basis, plan.mapInArrow(solve, "key string, n bigint, theta array<double>, names array<string>, coefficients array<double>, intercept double")


def dot(theta: Column, basis: Column) -> Column:
    """theta over (1, basis)."""
    terms = F.zip_with(F.slice(theta, F.lit(2), F.size(basis)), basis, lambda t, b: t * b)
    return F.aggregate(terms, F.get(theta, F.lit(0)), lambda s, t: s + t)


def ridge_left_out(df: DataFrame, groups: Mapping, target: str, by: str, alpha: float, weight: str | None = None, name: str = "prediction") -> DataFrame:
    """Every row with a group, predicted by the ridge model of all other groups. One scan for the moments of all models
    and one for the predictions, however many groups there are."""
    basis, models = ridge_models(df, groups, target, by, alpha, weight)
    models = stored(models.select(F.col("key").alias(KEY), "theta"), "models").withColumnRenamed("theta", "__theta")
    made = df.withColumn(KEY, F.col(by).cast("string")).withColumn(BASIS, basis.column()).join(models, KEY)
    return made.select(*[F.col(f"`{c}`") for c in df.columns], dot(F.col("__theta"), F.col(BASIS)).alias(name))


# ---- logistic -------------------------------------------------------------------------------------


@dataclass
class Trained:
    """A logistic model: who it is for, its map to features, weights over features, and how it ended."""

    left_out: str | None
    share: float
    to: np.ndarray
    beta: np.ndarray
    loss: float
    gradient_norm: float
    steps: int

    @property
    def theta(self) -> np.ndarray:
        return self.to @ self.beta


def _collapsed(df: DataFrame, basis: Basis, target: str, by: str | None, weight: str | None, spot: str | None, shares: Sequence[float] = ()) -> DataFrame:
    """(key, spot, b, w0, w1, n): rows of the same basis vector are one, unless nearly all differ. A spot becomes the largest
    share that it reaches: it lies below the same shares."""
    w = F.col(f"`{weight}`").cast("double") if weight else F.lit(1.0)
    y = F.col(f"`{target}`").cast("double")
    low = F.lit(float("-inf"))
    below = F.when(F.col(spot).isNotNull(), F.greatest(low, low, *[F.when(F.col(spot) >= s, F.lit(float(s))) for s in shares])) if spot else F.lit(0.0)
    rows = df.select((F.col(by).cast("string") if by else F.lit("")).alias("key"), below.alias("spot"), basis.column().alias("b"),
                     F.when(y == 0, w).otherwise(0.0).alias("w0"), F.when(y == 1, w).otherwise(0.0).alias("w1"), F.lit(1).cast("bigint").alias("n"), y.alias("y"), w.alias("w"))
    rows = rows.filter("key is not null and y is not null and w is not null").drop("y", "w")
    seen = rows.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("key", "spot", "b")).alias("kinds")).first()
    if seen["kinds"] * 4 < seen["n"]:
        rows = rows.groupBy("key", "spot", "b").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"), F.sum("n").alias("n"))
    return stored(rows, "designs")


def _per_model(rows: DataFrame, parts: Sequence[tuple[str | None, float]], thetas: Sequence[np.ndarray] | None, width: int) -> list[np.ndarray]:
    """For every training part (all keys but one, spots below a share): without thetas n, sums and squares of the basis; with
    them loss, gradient and Hessian over (1, basis). One scan for all parts."""

    def steep(x: np.ndarray, w0: np.ndarray, w1: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """Loss, gradient and Hessian of one model."""
        eta = x @ theta
        small = np.exp(-np.abs(eta))
        p = np.where(eta >= 0, 1.0, small) / (1.0 + small)
        w = w0 + w1
        loss = (w * (np.log1p(small) + np.maximum(-eta, 0.0)) + w0 * eta).sum()
        return np.concatenate([[loss], x.T @ (w * p - w1), ((x * (w * p * (1 - p))[:, None]).T @ x).ravel()])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list = [0.0] * len(parts)
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = batch.column(0).dictionary_encode()
            key, names = np.asarray(coded.indices), coded.dictionary.to_pylist()
            spot, w0, w1, n = (np.asarray(batch.column(c)).astype(float) for c in (1, 3, 4, 5))
            b = _matrix(batch.column(2), batch.num_rows)
            x = np.hstack([np.ones((len(b), 1)), b])
            for left, share in dict.fromkeys(parts):
                inside = spot < share
                if left in names:
                    inside &= key != names.index(left)
                at = np.flatnonzero(inside)
                same = [k for k, part in enumerate(parts) if part == (left, share)]
                if thetas is None:
                    found = np.concatenate([[n[at].sum()], n[at] @ b[at], n[at] @ b[at] ** 2])
                    for k in same:
                        total[k] = total[k] + found
                    continue
                xk, a0, a1 = x[at], w0[at], w1[at]
                for k in same:
                    total[k] = total[k] + steep(xk, a0, a1, thetas[k])
        found = [k for k, v in enumerate(total) if not np.isscalar(v)]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([total[k].tolist() for k in found], pa.list_(pa.float64()))], names=["model", "sums"])

    made = summed(rows.mapInArrow(gather, "model int, sums array<double>"), ["model"], "sums").collect()  # one row per model
    size = 1 + 2 * width if thetas is None else 1 + (1 + width) + (1 + width) ** 2
    out = [np.zeros(size) for _ in parts]
    for r in made:
        out[r["model"]] = np.array(r["sums"])
    return out


def fit_logistic(
    df: DataFrame, groups: Mapping, target: str, c: float | Sequence[float], weight: str | None = None, by: str | None = None, shares: Sequence[float] = (),
    spot: str | None = None, keys: Sequence[str | None] | None = None, steps: int = 30, tolerance: float = 1e-8,
) -> tuple[Basis, list[Trained]]:
    """Penalised logistic models (C x loss + half the squared weights, intercept free) by Newton steps.

    Without `by` there is one model of all rows; with it one per group left out (`keys`, or all of them: a few folds), and
    with `shares` one per share of the rows by `spot`. Several `c` give that many sets of models, one after the other, from
    the same scans. A step reads the rows once for all models and brings one gradient
    and Hessian per model to the driver. A step that raises a model's loss is halved. It ends when every gradient is
    below `tolerance` of the rows' weight, or after `steps`.
    """
    basis = learn_basis(df, groups)
    if keys is None:
        keys = [None] if by is None else sorted(r[0] for r in df.select(F.col(by).cast("string")).dropna().distinct().limit(1_001).collect())
    if len(keys) > 1_000:
        raise ValueError("more than 1000 groups; use group folds")
    parts = [(k, s) for s in (shares or [float("inf")]) for k in keys]
    rows = _collapsed(df, basis, target, by, weight, spot, shares)
    moments = _per_model(rows, parts, None, basis.width)
    maps = []
    for share in shares or [float("inf")]:
        part = (df.filter(F.col(spot) < share) if spot else df).withColumn(KEY, F.col(by).cast("string") if by else F.lit(""))
        middles = {r[KEY]: r["medians"] for r in _medians(part, basis, KEY).filter(F.col(KEY).isNull() | F.col(KEY).isin([k for k in keys if k is not None])).collect()} if basis.numbers else {}
        for k in keys:
            m = moments[len(maps)]
            maps.append(basis.features({**middles.get(None, {}), **(middles.get(k) or {})}, m[0], m[1:1 + basis.width], m[1 + basis.width:]))
    cs = [float(c)] * len(parts) if np.isscalar(c) else [float(v) for v in c for _ in parts]
    parts, maps = parts * (len(cs) // len(parts)), maps * (len(cs) // len(parts))
    p = basis.width + 1
    free = np.ones(maps[0].shape[1])
    free[0] = 0.0
    betas = [np.zeros(len(free)) for _ in parts]
    ahead = [np.zeros(len(free)) for _ in parts]
    best = [np.inf] * len(parts)
    norms, taken, open_ = [np.inf] * len(parts), [0] * len(parts), list(range(len(parts)))
    for _ in range(steps + 1):
        tried = [betas[k] + ahead[k] for k in open_]
        found = _per_model(rows, [parts[k] for k in open_], [maps[k] @ t for k, t in zip(open_, tried)], basis.width)
        still = []
        for k, beta, sums in zip(open_, tried, found):
            loss = sums[0] + (free * beta * beta).sum() / (2 * cs[k])
            if loss > best[k] + 1e-12 * abs(best[k]) and np.abs(ahead[k]).max() > 1e-12:
                ahead[k] = ahead[k] / 2
                still.append(k)
                continue
            betas[k], best[k] = beta, loss
            gradient = maps[k].T @ sums[1:1 + p] + free * beta / cs[k]
            hessian = maps[k].T @ sums[1 + p:].reshape(p, p) @ maps[k] + np.diag(free / cs[k])
            norms[k] = float(np.abs(gradient).max())
            scale = max(1.0, float(sums[1 + p]) * 4)
            if norms[k] <= tolerance * scale:
                continue
            ahead[k] = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
            taken[k] += 1
            still.append(k)
        open_ = still
        if not open_:
            break
    return basis, [Trained(*part, to, beta, loss, norm, n) for part, to, beta, loss, norm, n in zip(parts, maps, betas, best, norms, taken)]


def _literal(theta: np.ndarray) -> Column:
    return F.array(*[F.lit(float(v)) for v in theta])


def logistic_probability(basis: Basis, model: Trained) -> Column:
    return 1.0 / (1.0 + F.exp(-dot(_literal(model.theta), basis.column())))


def logistic_auc(df: DataFrame, basis: Basis, models: Sequence[Trained], target: str, by: str, spot: str | None = None) -> DataFrame:
    """(model, part, auc): unweighted AUC of every model on the rows of the group it leaves out ("validation") and on its
    training rows ("train"), one row per model, by its place, and part.

    One scan scores the rows by all models. A task sends, per model, part and range of scores, its distinct scores with
    their counts as packed arrays; a range counts its pairs, and the totals of the ranges below do the rest.
    """
    y = F.col(f"`{target}`").cast("double")
    # As in Spark's order of numbers, a score that is not a number counts as the largest.
    rows = df.select(F.col(by).cast("string").alias("key"), (F.col(spot) if spot else F.lit(0.0)).cast("double").alias("spot"), (y == 1).alias("y"), basis.column().alias("b")).filter(
        "key is not null and y is not null")
    wanted = [(m.left_out, float(m.share), m.theta) for m in models]

    def probability(b: np.ndarray, theta: np.ndarray) -> np.ndarray:
        """Summed column by column, so that equal rows have equal scores."""
        eta = np.full(len(b), theta[0])
        for j in range(b.shape[1]):
            eta += theta[j + 1] * b[:, j]
        with np.errstate(over="ignore"):
            return 1.0 / (1.0 + np.exp(-eta))

    tasks = max(range_count(df.sparkSession), rows.rdd.getNumPartitions())
    each = max(1, -(-EDGE_ROWS // tasks))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = 0
        for batch in batches:
            if kept >= each:
                break
            part = batch.column(3).slice(0, each - kept)
            kept += len(part)
            yield pa.RecordBatch.from_arrays([part], names=["b"])

    # The first rows of each task place the edges of the ranges, nothing else.
    some = np.array([r["b"] for r in rows.mapInArrow(first, "b array<double>").collect()], float).reshape(-1, basis.width)
    ranges = max(range_count(df.sparkSession), -(-df.count() // RANGE_ROWS))
    edges = [np.unique(np.quantile(probability(some, t), np.arange(1, ranges) / ranges)) if len(some) else np.zeros(0) for _, _, t in wanted]

    def collapse(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.argsort(score, kind="stable")
        score = score[order]
        start = np.flatnonzero(np.r_[True, score[1:] != score[:-1]][: len(score)])
        return score[start], *(np.add.reduceat(c[order], start) if len(start) else c for c in (pos, neg))

    def packed(k: int, train: int, score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> Iterator[tuple]:
        cut = np.r_[0, np.searchsorted(score, edges[k], side="left"), len(score)]
        for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if a < b:
                yield k, train, r, score[a:b].tobytes() + pos[a:b].astype("<i8").tobytes() + neg[a:b].astype("<i8").tobytes()

    def table(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))], names=["model", "train", "range", "scores"])

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows that a task has not sent yet, bounded
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            key, spot, y, b = (np.concatenate(c) for c in zip(*held))
            for k, (left, share, theta) in enumerate(wanted):
                p = probability(b, theta)
                for train, inside in ((0, key == left), (1, (key != left) & (spot < share))):
                    at = np.flatnonzero(inside)
                    if len(at):
                        yield table(list(packed(k, train, *collapse(p[at], y[at].astype(np.int64), 1 - y[at].astype(np.int64)))))

        for batch in batches:
            if batch.num_rows:
                held.append((np.array(batch.column(0).to_pylist(), object), np.asarray(batch.column(1)), np.asarray(batch.column(2)), _matrix(batch.column(3), batch.num_rows)))
                size += batch.num_rows
                if size >= HELD_ROWS:
                    yield from sent()
                    held, size = [], 0
        if held:
            yield from sent()

    def won(key, part):
        score, pos, neg = [], [], []
        for blob in part["scores"].to_pylist():
            n = len(blob) // 24
            score.append(np.frombuffer(blob, "<f8", n))
            pos.append(np.frombuffer(blob, "<i8", n, 8 * n))
            neg.append(np.frombuffer(blob, "<i8", n, 16 * n))
        _, pos, neg = collapse(*(np.concatenate(c) for c in (score, pos, neg)))
        # Twice the pairs won, in whole numbers.
        pairs = int((pos * (2 * (np.cumsum(neg) - neg) + neg)).sum())
        return pa.table({"model": [key[0].as_py()], "train": [key[1].as_py()], "range": [key[2].as_py()], "pairs": [pairs], "pos": [int(pos.sum())], "neg": [int(neg.sum())]})

    sent = rows.mapInArrow(score_rows, "model int, train int, range int, scores binary")
    counted = sent.groupBy("model", "train", "range").applyInArrow(won, "model bigint, train bigint, range bigint, pairs bigint, pos bigint, neg bigint")
    below: dict[tuple, list[int]] = {}
    for r in sorted(counted.collect()):  # one row per model, part and range
        sums = below.setdefault((r["model"], r["train"]), [0, 0, 0])
        sums[0] += r["pairs"] + 2 * r["pos"] * sums[2]
        sums[1] += r["pos"]
        sums[2] += r["neg"]
    made = [(k, "train" if train else "validation", pairs / (2 * p * n) if p * n else None) for (k, train), (pairs, p, n) in below.items()]
    return df.sparkSession.createDataFrame(made, "model int, part string, auc double")


def logistic_left_out(df: DataFrame, groups: Mapping, target: str, by: str, c: float, weight: str | None = None, name: str = "prediction") -> DataFrame:
    """Every row with a group, predicted by the logistic model of all other groups (folds: at most 1000 of them)."""
    basis, models = fit_logistic(df, groups, target, c, weight, by)
    table = df.sparkSession.createDataFrame([(m.left_out, [float(v) for v in m.theta]) for m in models], f"{KEY} string, __theta array<double>")
    made = df.withColumn(KEY, F.col(by).cast("string")).withColumn(BASIS, basis.column()).join(table, KEY)
    return made.select(*[F.col(f"`{c}`") for c in df.columns], (1.0 / (1.0 + F.exp(-dot(F.col("__theta"), F.col(BASIS))))).alias(name))


def coefficient_rows(basis: Basis, model: Trained) -> list[tuple[str, float]]:
    return [*zip(basis.names, map(float, model.beta[1:])), ("intercept", float(model.beta[0]))]
