"""Near-duplicate vectors by a pigeonhole join over subspaces."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocks import FOUND, components, in_blocks, join_trees

SUBSPACES = 4
#: Axes of the grid that a subspace is joined on. More of them prune more and copy more.
AXES = 2
CHUNK = 8192
#: Vectors that the rotation is learned from, at most.
FIT_ROWS = 4000


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, some of them not zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(x, lambda v: v != 0), F.lit(False))


@dataclass
class Split:
    """Rotation, the columns of each subspace, and its share of the squared distance."""

    rotation: np.ndarray
    edges: list[int]
    budgets: np.ndarray

    def __len__(self) -> int:
        return len(self.budgets)

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        """Rounded to a grid, so that a distance is the same number in whatever block it is taken."""
        return np.rint(unit @ self.rotation * 2.0**26) / 2.0**26

    def squared(self, a: np.ndarray, b: np.ndarray, s: int) -> np.ndarray:
        diff = a[:, self.edges[s] : self.edges[s + 1]] - b[:, self.edges[s] : self.edges[s + 1]]
        return (diff * diff).sum(axis=1)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_split(sample: np.ndarray, threshold: float, subspaces: int = SUBSPACES) -> Split:
    """Principal axes, dealt to the subspaces in turn so that each has wide ones; budgets follow their variance."""
    d = sample.shape[1]
    values, axes = np.linalg.eigh(np.atleast_2d(np.cov(sample.T)) if len(sample) > 1 else np.eye(d))
    values, axes = np.maximum(values[::-1], 1e-12), axes[:, ::-1]
    n = min(subspaces, d)
    order = [k for s in range(n) for k in range(s, d, n)]
    edges = [0, *np.cumsum([len(range(s, d, n)) for s in range(n)]).tolist()]
    shares = np.array([values[order][a:b].sum() for a, b in zip(edges, edges[1:])])
    shares = 0.5 * shares / shares.sum() + 0.5 / n  # no subspace is left without room
    return Split(np.ascontiguousarray(axes[:, order]), edges, (2 - 2 * threshold + 1e-6) * shares)


def _matrix(column: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=dtype).reshape(len(column), -1).astype(np.float64)


def cells(rows: DataFrame, split: Split, dtype: str) -> DataFrame:
    """(grp, visits, id, v): for each subspace, the vector's own cell of a grid over the subspace's widest axes, and
    the cells before it, in the order of their numbers, that its range reaches."""
    schema = "grp bigint, visits boolean, id bigint, v binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                spots = split.rotated(unit_rows(_matrix(part.column(1), dtype)))
                for s in range(len(split)):
                    axes = spots[:, split.edges[s] : min(split.edges[s + 1], split.edges[s] + AXES)]
                    reach = float(np.sqrt(split.budgets[s])) * (1 + 1e-6)
                    home = np.floor(axes / reach).astype(np.int64)
                    inside = axes - home * reach
                    steps = [o for o in product((-1, 0, 1), repeat=axes.shape[1]) if o <= (0,) * axes.shape[1]]
                    for o in steps:
                        gap = np.zeros(len(axes))
                        for k, step in enumerate(o):
                            gap += 0 if step == 0 else (inside[:, k] if step < 0 else reach - inside[:, k]) ** 2
                        near = np.nonzero(gap <= reach * reach)[0]
                        number = np.full(len(near), s, dtype=np.int64)
                        for k in range(AXES):
                            number = (number << 18) + (home[near, k] + o[k] + (1 << 17) if k < axes.shape[1] else 0)
                        take = pa.array(near)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(number), pa.array(np.full(len(near), any(o))), part.column(0).take(take), part.column(1).take(take)],
                            names=["grp", "visits", "id", "v"])

    return rows.mapInArrow(run, schema)


def link_block(split: Split, threshold: float, dtype: str):
    """Links of one block. A pair counts in the first subspace whose budget it keeps, so it counts once."""

    def work(key, table):
        number, i, kind, j = (k.as_py() for k in key)
        s = number >> (18 * AXES)
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        side = table["side"].to_numpy()[order]
        ids = table["id"].to_numpy()[order]
        v = _matrix(table["v"], dtype)[order]
        unit = unit_rows(v)
        spots = split.rotated(unit)
        block = spots[:, split.edges[s] : split.edges[s + 1]].astype(np.float32)
        norm = (block * block).sum(axis=1)
        own = kind == 0 and i == j
        left = np.nonzero(side == 0)[0]
        right = left if own else np.nonzero(side == 1)[0]
        links, parent = np.zeros(len(ids), np.int64), np.arange(len(ids))
        budget = split.budgets
        for lo in range(0, len(left), 512):
            rows = left[lo : lo + 512]
            columns = right[lo + 1 :] if own else right
            if not len(columns):
                continue
            near = norm[rows][:, None] + norm[columns][None, :] - 2 * (block[rows] @ block[columns].T) <= budget[s] + 1e-4
            if own:
                near &= columns[None, :] > rows[:, None]
            a, b = np.nonzero(near)
            a, b = rows[a], columns[b]
            for k in range(0, len(a), 100_000):
                x, y = a[k : k + 100_000], b[k : k + 100_000]
                first = split.squared(spots[x], spots[y], s) <= budget[s]
                x, y = x[first], y[first]
                for earlier in range(s):
                    new = split.squared(spots[x], spots[y], earlier) > budget[earlier]
                    x, y = x[new], y[new]
                linked = (unit[x] * unit[y]).sum(axis=1) >= threshold
                x, y = x[linked], y[linked]
                links += np.bincount(x, minlength=len(ids)) + np.bincount(y, minlength=len(ids))
                parent = join_trees(parent, x, y)
        hit = np.nonzero(links)[0]
        return pa.table({"id": pa.array(ids[hit]), "n": pa.array(links[hit]), "root": pa.array(ids[parent[hit]])})

    return work


def near_vectors(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """id_col, n_links, component_id, kept: one row per id.

    Vectors link if their cosine is at least `threshold` (over -1, at most 1). Null, empty, zero and not finite
    vectors link with nothing; vectors of different lengths do not link, each length is joined on its own. Rows that repeat an id count once, with the
    smallest of their vectors; rows without an id are left out; other columns are dropped. An empty table gives no rows.
    """
    double = "float" not in df.schema[vector].dataType.simpleString()
    kind, dtype = ("array<double>", "<f8") if double else ("array<float>", "<f4")
    raw = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast(kind).alias("v")).filter("id is not null")
    each = stored(raw.groupBy("id").agg(F.min(F.when(usable(F.col("v")), F.col("v"))).alias("v")), "vectors")
    good = each.filter(F.col("v").isNotNull())
    found = df.sparkSession.createDataFrame([], FOUND)
    for d in [r["d"] for r in good.groupBy(F.size("v").alias("d")).count().filter("count > 1").orderBy("d").collect()]:
        same = good.filter(F.size("v") == d)
        drawn = same.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("v").toArrow()
        split = fit_split(unit_rows(np.array(drawn["v"].to_pylist(), dtype=np.float64)), threshold)
        packed = same.mapInArrow(_packed(dtype), "id bigint, v binary")
        found = found.unionByName(stored(in_blocks(cells(packed, split, dtype), link_block(split, threshold, dtype), CHUNK), "links"))
    parts = components(found)
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    out = each.select("id").join(links, "id", "left").join(parts, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))


def _packed(dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column(1).flatten()).astype(dtype).reshape(b.num_rows, -1) if b.num_rows else np.zeros((0, 0), dtype)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "v"])

    return run
