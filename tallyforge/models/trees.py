"""Forests and boosted trees over binned rows.

Unlike Spark's, a tree for classes keeps two leaves that vote for the same class, as their shares of it differ.

As in Spark's own trees a feature has at most 32 bins. Rows of the same bins, label and weight are one, with a count, and
a sample of rows draws from the counts, so the work of a tree is bounded by the distinct rows, not by the table. The
trees of a forest are grown by many tasks; boosting, whose rounds follow one another, is one task. A table of more than
`MAX_CELLS` distinct rows goes to Spark's estimators.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import range_count
from ..session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 32
MAX_CELLS, CELLS_PER_TASK = 4_000_000, 20_000


def cut_points(rows: DataFrame, columns: Sequence[str]) -> list[np.ndarray]:
    """At most 31 thresholds per column; a value goes left of those that it does not exceed."""
    found = rows.approxQuantile(list(columns), [i / BINS for i in range(BINS)], 0.5 / BINS / 8)
    return [np.unique(np.array(q, float))[: BINS - 1] for q in found]


def binned(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """(features, rows) of bins."""
    return np.stack([np.searchsorted(c, x, side="left") for x, c in zip(columns, cuts)]).astype(np.uint8)


def cells_of(rows: DataFrame, d: int, cuts: Sequence[np.ndarray]) -> DataFrame:
    """(cell, y, w, n): rows (x0.., y, w) counted by their bins, label and weight."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.ascontiguousarray(binned([np.asarray(batch.column(j)) for j in range(d)], cuts).T)
            cells = pa.FixedSizeBinaryArray.from_buffers(pa.binary(d), batch.num_rows, [None, pa.py_buffer(codes)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([cells, batch.column(d), batch.column(d + 1)], names=["cell", "y", "w"])

    return rows.mapInArrow(place, "cell binary, y double, w double").groupBy("cell", "y", "w").agg(F.count("*").alias("n"))


def grow(codes: np.ndarray, n: np.ndarray, w: np.ndarray, g: np.ndarray, depth: int, min_leaf: int, few: int, rng: np.random.Generator) -> tuple[dict, np.ndarray]:
    """One tree, level by level, on cells of bins with a count, a weight and a sum of targets; and each cell's value.

    A node takes the split, among `few` features drawn for it, that lowers the weighted variance most (for a 0/1 target
    the same as Gini impurity), with at least `min_leaf` rows on both sides. Features of leaves are -1.
    """
    d, even = len(codes), w is n
    feature, cut, left, value, gain = [], [], [], [], np.zeros(d)
    at, node = np.arange(codes.shape[1]), np.zeros(codes.shape[1], np.int64)
    out = np.zeros(codes.shape[1])
    active = 1  # nodes of this level; they follow the `len(feature)` nodes of the levels above

    def summed(v: np.ndarray) -> np.ndarray:
        """Sums up to each threshold, per node."""
        return np.bincount(key, v, active * BINS).reshape(active, BINS).cumsum(axis=1)[:, :-1]

    for level in range(depth + 1):
        base = len(feature)
        hn = np.bincount(node, n, active)
        hw = hn if even else np.bincount(node, w, active)
        hg = np.bincount(node, g, active)
        mean = hg / np.where(hw > 0, hw, 1.0)
        best, best_f, best_b = np.full(active, -np.inf), np.full(active, -1), np.zeros(active, np.int64)
        if level < depth:
            start = node * BINS
            key = np.empty_like(start)
            allowed = np.ones((active, d), bool) if few >= d else np.argsort(rng.random((active, d)), axis=1).argsort(axis=1) < few
            for f in range(d):
                np.add(codes[f], start, out=key)
                cn, cg = summed(n), summed(g)
                cw = cn if even else summed(w)
                rn, rw, rg = hn[:, None] - cn, hw[:, None] - cw, hg[:, None] - cg
                good = (cn >= min_leaf) & (rn >= min_leaf) & (cw > 0) & (rw > 0) & allowed[:, f, None]
                won = np.where(good, cg * cg / np.where(good, cw, 1.0) + rg * rg / np.where(good, rw, 1.0), -np.inf)
                b = won.argmax(axis=1)
                better = won[np.arange(active), b] > best
                best[better], best_f[better], best_b[better] = won[np.arange(active), b][better], f, b[better]
        worth = best - hg * mean
        split = np.isfinite(best) & (worth > 1e-12 * np.maximum(1.0, np.abs(hg * mean)))
        np.add.at(gain, best_f[split], worth[split])
        child = np.cumsum(split) - 1
        feature += np.where(split, best_f, -1).tolist()
        cut += np.where(split, best_b, 0).tolist()
        left += np.where(split, base + active + 2 * child, -1).tolist()
        value += mean.tolist()
        stay = split[node]
        if not stay.all():
            gone = np.flatnonzero(~stay)
            out[at[gone]] = mean[node[gone]]
            kept = np.flatnonzero(stay)
            at, node, codes, g = at[kept], node[kept], codes.take(kept, axis=1), g[kept]
            n, w = (n[kept],) * 2 if even else (n[kept], w[kept])
        if not len(at):
            break
        right = codes.ravel()[best_f[node] * len(node) + np.arange(len(node))] > best_b[node]
        node = 2 * child[node] + right
        active = 2 * int(split.sum())
    total = gain.sum()
    return {"feature": feature, "cut": cut, "left": left, "value": value, "gain": (gain / total if total > 0 else gain).tolist()}, out


def tree_values(tree: dict, codes: np.ndarray) -> np.ndarray:
    feature, cut, left, value = (np.array(tree[k]) for k in ("feature", "cut", "left", "value"))
    at = np.zeros(codes.shape[1], np.int64)
    rows = np.arange(codes.shape[1])
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        here = at[rows]
        at[rows] = left[here] + (codes[feature[here], rows] > cut[here])
    return value[at]


def _by_cell(data: tuple) -> tuple:
    """Distinct cells as bins, and of each row its cell: rows of a cell share all nodes."""
    codes = data[0]
    flat = np.ascontiguousarray(codes.T)
    _, first, cell = np.unique(flat.view(f"V{len(codes)}").ravel(), return_index=True, return_inverse=True)
    return np.ascontiguousarray(codes[:, first]), cell.ravel()


def _grown(cells: np.ndarray, cell: np.ndarray, times: np.ndarray, w: np.ndarray, target: np.ndarray, *options) -> tuple[dict, np.ndarray]:
    """A tree of rows that come `times` times, summed by cell."""
    n = np.bincount(cell, times, cells.shape[1])
    g = np.bincount(cell, times * w * target, cells.shape[1])
    return grow(cells, n, n if (w == 1).all() else np.bincount(cell, times * w, cells.shape[1]), g, *options)


def grow_forest(data: tuple, which: Sequence[int], depth: int, min_leaf: int, few: int, seed: int) -> Iterator[dict]:
    """Every tree from as many rows as there are, drawn with replacement: each row comes Poisson(1) times."""
    cells, cell = _by_cell(data)
    _, y, w, n = data
    for t in which:
        rng = np.random.default_rng([seed, t])
        yield _grown(cells, cell, rng.poisson(n).astype(float), w, y, depth, min_leaf, few, rng)[0]


def boost(data: tuple, rounds: int, rate: float, depth: int, min_leaf: int, share: float, few: int, classifies: bool, seed: int) -> Iterator[dict]:
    """Gradient boosting as Spark's: the first tree counts whole, the others by `rate`; log loss of labels -1 and 1, or
    squared error; each round keeps a row with the chance `share`."""
    cells, cell = _by_cell(data)
    _, y, w, n = data
    label = 2 * y - 1 if classifies else y
    score = np.zeros(cells.shape[1])
    for t in range(rounds):
        rng = np.random.default_rng([seed, t])
        times = (rng.binomial(n, share) if share < 1 else n).astype(float)
        if t == 0:
            target = label
        elif classifies:
            target = 4 * label / (1 + np.exp(np.minimum(2 * label * score[cell], 700.0)))
        else:
            target = 2 * (label - score[cell])
        tree, values = _grown(cells, cell, times, w, target, depth, min_leaf, few, rng)
        score += (1.0 if t == 0 else rate) * values
        yield tree


class BinnedTrees(Estimator):
    """Learns a forest or boosted trees from (features, label and maybe weight)."""

    def __init__(self, plain: Estimator, boosted: bool, classifies: bool, options: dict, label: str, weight: str | None, seed: int):
        super().__init__()
        self.plain, self.boosted, self.classifies, self.options, self.label, self.weight, self.seed = plain, boosted, classifies, options, label, weight, seed

    def _fit(self, ready: DataFrame) -> Model:
        spark, o = ready.sparkSession, self.options
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        wide = ready.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y"), w.alias("w")).filter("y is not null and w > 0")
        first = wide.select(F.size("x").alias("d")).first()
        if first is None:
            raise ValueError("no rows to learn from")
        d = first["d"]
        names = [f"x{j}" for j in range(d)]
        rows = stored(wide.select(*[F.col("x")[j].alias(c) for j, c in enumerate(names)], "y", "w"), "tree-rows")
        cuts = cut_points(rows, names)
        cells = stored(cells_of(rows, d, cuts), "tree-cells")
        if cells.count() > MAX_CELLS:
            return self.plain.fit(ready)
        table = cells.toArrow()  # a bounded number of rows
        codes = np.frombuffer(b"".join(table["cell"].to_pylist()), np.uint8).reshape(-1, d)
        y, weight, n = (np.asarray(table[c]) for c in ("y", "w", "n"))
        order = np.lexsort((weight, y, *codes.T))  # the same order whatever the partitions
        data = spark.sparkContext.broadcast((np.ascontiguousarray(codes[order].T), y[order], weight[order], n[order]))
        few, boosted, classifies, seed = max(1, math.ceil(o["features"] * d)), self.boosted, self.classifies, self.seed

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            which = [i for batch in batches for i in batch.column(0).to_pylist()]
            if not which:
                return
            if boosted:
                made = enumerate(boost(data.value, o["trees"], o["rate"], o["depth"], o["min_leaf"], o["rows"], few, classifies, seed))
            else:
                made = zip(which, grow_forest(data.value, which, o["depth"], o["min_leaf"], few, seed))
            for i, tree in made:
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([json.dumps(tree)])], names=["id", "tree"])

        tasks = 1 if boosted else min(o["trees"], 4 * range_count(spark))
        grown = spark.range(0, 1 if boosted else o["trees"], 1, tasks).mapInArrow(work, "id bigint, tree string").collect()
        trees = [json.loads(r["tree"]) for r in sorted(grown, key=lambda r: r["id"])]
        data.unpersist()
        model = BinnedTreesModel().told({
            "cuts": [c.tolist() for c in cuts], "trees": trees, "classifies": self.classifies, "boosted": self.boosted, "rate": o.get("rate", 1.0)})
        return model.knowing(cells.select("cell").distinct(), len(codes))


class BinnedTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds `prediction`, and `probability` of both classes when it classifies. All of it is one text parameter, so that it
    is written and read like any stage."""

    spec = Param(Params._dummy(), "spec", "thresholds and trees as JSON")

    def told(self, spec: dict) -> BinnedTreesModel:
        return self._set(spec=json.dumps(spec))

    @property
    def parts(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    known = None  # sorted keys and values of the cells learned from; a model that was read back works them out again

    def knowing(self, cells: DataFrame, n: int) -> BinnedTreesModel:
        """Works out the values of the distinct cells once, in many tasks, for all later predictions."""
        values, keys_of = self._scorers()
        if keys_of is None:
            return self

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, -1).T
                    yield pa.RecordBatch.from_arrays([pa.array(keys_of(codes)), pa.array(values(codes))], names=["key", "value"])

        spark = cells.sparkSession
        tasks = max(range_count(spark), -(-n // CELLS_PER_TASK))
        table = cells.repartition(tasks).mapInArrow(work, "key bigint, value double").toArrow()  # a bounded number of cells
        keys, found = np.asarray(table["key"]), np.asarray(table["value"])
        order = np.argsort(keys)
        self.known = spark.sparkContext.broadcast((keys[order], found[order]))
        return self

    def _scorers(self):
        """A function from bins to predictions, and one from bins to whole numbers, if these have room for all bins."""
        parts = self.parts
        trees, boosted, classifies, rate = ([{k: np.array(v) for k, v in t.items()} for t in parts["trees"]], parts["boosted"], parts["classifies"], parts["rate"])
        sizes = [len(c) + 1 for c in parts["cuts"]]
        steps = [math.prod(sizes[:j]) for j in range(len(sizes))]

        def values(codes: np.ndarray) -> np.ndarray:
            total = np.zeros(codes.shape[1])
            for t, tree in enumerate(trees):
                total += tree_values(tree, codes) * (rate if boosted and t else 1.0)
            if not boosted:
                total /= len(trees)
            elif classifies:
                total = 1 / (1 + np.exp(-2 * total))
            return total

        def keys_of(codes: np.ndarray) -> np.ndarray:
            return sum(c.astype(np.int64) * step for c, step in zip(codes, steps))

        return values, keys_of if math.prod(sizes) < 2**62 else None

    @property
    def featureImportances(self) -> DenseVector:
        total = np.sum([t["gain"] for t in self.parts["trees"]], axis=0)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, df: DataFrame) -> DataFrame:
        cuts, classifies, known = [np.array(c) for c in self.parts["cuts"]], self.parts["classifies"], self.known
        values, keys_of = self._scorers()

        @F.pandas_udf("double")
        def predicted(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            met: dict[bytes, float] = {}  # values of cells that this task has met and that are not known
            for xs in columns:
                codes = binned([x.to_numpy() for x in xs], cuts)
                out, open_ = np.zeros(codes.shape[1]), np.arange(codes.shape[1])
                if known is not None and len(known.value[0]):
                    keys, found = known.value
                    mine = keys_of(codes)
                    at = np.minimum(np.searchsorted(keys, mine), len(keys) - 1)
                    out, open_ = found[at], np.flatnonzero(keys[at] != mine)
                if len(open_):
                    cells = [v.tobytes() for v in np.ascontiguousarray(codes[:, open_].T)]
                    if len(met) > MAX_CELLS:
                        met.clear()
                    new = {k: i for k, i in zip(cells, open_) if k not in met}
                    if new:
                        met.update(zip(new, values(codes[:, list(new.values())]).tolist()))
                    out[open_] = [met[k] for k in cells]
                yield pd.Series(out)

        arrays = df.withColumn("__x", vector_to_array("features"))
        out = arrays.withColumn("__p", predicted(*[F.col("__x")[j] for j in range(len(cuts))])).drop("__x")
        if not classifies:
            return out.withColumnRenamed("__p", "prediction")
        both = array_to_vector(F.array(1.0 - F.col("__p"), F.col("__p")))
        return out.withColumn("probability", both).withColumn("prediction", (F.col("__p") > 0.5).cast("double")).drop("__p")
