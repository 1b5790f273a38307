"""Exact top-k by inner product: sorted lists read in order, without random access."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import stored

#: Rows of a block of candidates, and of a block of queries.
CANDIDATES = 4096
QUERIES = 512
#: Shares of the lists after which the bounds are looked at.
DEPTHS = (0.25, 0.5, 0.7, 0.8, 0.9, 1.0)
#: Queries of a block that tell after which share it is worth to look first.
PROBES = 16
#: Reading stops when at most so many times k candidates may still be among the k best; their scores are resolved.
RESOLVED = 8


class SortedLists:
    """One list per component of a block of candidates. Reading lists to a depth means: of each candidate, those
    components are known whose place in their list, from the end that the query's sign asks for, is within the depth.
    """

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(x, self.order, axis=0)
        self.place = np.empty_like(self.order)
        np.put_along_axis(self.place, self.order, np.arange(len(x))[:, None], axis=0)

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(queries, candidates) lower and upper bounds of the scores after `depth` entries of every list.

        Known components count in full. An unknown one lies between the last entry read and the list's far end.
        """
        n = len(self.x)
        if depth >= n:
            exact = q @ self.x.T
            return exact, exact
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        top, bottom = self.place >= n - depth, self.place < depth
        low, high = self.sorted[0], self.sorted[-1]
        edge_top, edge_bottom = self.sorted[n - depth], self.sorted[depth - 1]
        lower = up @ np.where(top, self.x, low).T + down @ np.where(bottom, self.x, high).T
        upper = up @ np.where(top, self.x, edge_top).T + down @ np.where(bottom, self.x, edge_bottom).T
        return lower, upper


def contenders(lists: SortedLists, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, depth: int) -> np.ndarray:
    """(queries, candidates): may the candidate still be among the k best? The others' upper bounds stay below the
    k-th largest lower bound. A query does not meet the candidate of its own id."""
    n = len(ids)
    lower, upper = lists.bounds(q, depth)
    own = ids[None, :] == q_ids[:, None]
    lower[own] = -np.inf
    if k >= n:
        return ~own
    kth = np.partition(lower, n - k, axis=1)[:, n - k]
    return (upper >= kth[:, None]) & ~own


def nearest(lists: SortedLists, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, score, share of the lists read) of the k best candidates of every query, ties to
    the smaller id.

    Lists are read on for the queries that are still open, from the share on at which some of them are seen to be
    decided. A query is done when few contenders are left; their final scores are then resolved.
    """
    n = len(ids)
    depth_of = lambda share: max(1, int(np.ceil(share * n)))
    decided = lambda may: may.sum(axis=1) <= RESOLVED * k
    few = slice(0, PROBES)
    begin = next((i for i, s in enumerate(DEPTHS[:-1]) if decided(contenders(lists, ids, q[few], q_ids[few], k, depth_of(s))).mean() >= 0.5), len(DEPTHS) - 2)
    rows, found, scores, shares = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]
    open_ = np.arange(len(q))
    for share in DEPTHS[begin:]:
        depth = depth_of(share)
        may = contenders(lists, ids, q[open_], q_ids[open_], k, depth)
        done = decided(may) if depth < n else np.ones(len(open_), bool)
        for at in np.nonzero(done)[0]:
            c = np.nonzero(may[at])[0]
            s = lists.x[c] @ q[open_[at]]
            best = np.lexsort((ids[c], -s))[:k]
            rows.append(np.full(len(best), open_[at]))
            found.append(c[best])
            scores.append(s[best])
            shares.append(np.full(len(best), depth / n))
        open_ = open_[~done]
        if not len(open_):
            break
    return np.concatenate(rows), np.concatenate(found), np.concatenate(scores), np.concatenate(shares)


def integer_vectors(df: DataFrame, scale: int, id_col: str, vector: str) -> DataFrame:
    """(id, v): floor(scale * x) of every component as double; rows whose vector is null, or holds a null or a value
    that is not finite, are left out."""
    x = F.col(f"`{vector}`").cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.filter(F.coalesce(fine, F.lit(False)) & F.col(f"`{id_col}`").isNotNull())
    whole = F.transform(x, lambda v: F.floor(v * scale).cast("double"))
    return rows.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), whole.alias("v"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, block: int = CANDIDATES, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score, lists_read for frames (id bigint, v array<double> of whole numbers).

    Candidates and queries are cut into blocks by a hash of the id; every pair of blocks is one task's group, and each
    returns its k best per query, of which the k best of all are kept. Candidates of another length than a query do
    not meet it. Repeated ids are rows of their own, except that a query never meets its own id. Fewer than k
    candidates give all of them; an empty side gives no rows. Scores are exact while they stay below 2^53.
    """
    cand, ask = stored(candidates.select("id", "v"), "candidates"), stored(queries.select("id", "v"), "queries")
    n, m = cand.count(), ask.count()
    many, times = max(1, -(-n // block)), max(1, -(-m // query_block))
    whole = lambda size: F.sequence(F.lit(0), F.lit(size - 1))
    left = cand.select("id", "v", F.lit(False).alias("asks"), F.pmod(F.xxhash64("id"), F.lit(many)).cast("int").alias("__c"), F.explode(whole(times)).alias("__q"))
    right = ask.select("id", "v", F.lit(True).alias("asks"), F.explode(whole(many)).alias("__c"), F.pmod(F.xxhash64("id"), F.lit(times)).cast("int").alias("__q"))
    schema = StructType.fromDDL("query_id bigint, vec_id bigint, score bigint, lists_read double, row int")

    def work(key, table):
        asks = table["asks"].to_numpy().astype(bool)
        ids = table["id"].to_numpy()
        vectors = table["v"].to_pylist()
        widths = np.array([len(v) for v in vectors])
        parts = []
        for d in np.unique(widths[asks]) if asks.any() else []:
            c, a = np.nonzero(~asks & (widths == d))[0], np.nonzero(asks & (widths == d))[0]
            if not len(c) or not len(a):
                continue
            c = c[np.argsort(ids[c], kind="stable")]
            x, q = (np.array([vectors[i] for i in at], dtype=float).reshape(len(at), d) for at in (c, a))
            r, found, score, share = nearest(SortedLists(x), ids[c], q, ids[a], k)
            parts.append(pa.table([pa.array(ids[a][r]), pa.array(ids[c][found]), pa.array(score.astype(np.int64)), pa.array(share), pa.array(a[r], pa.int32())], names=schema.names))
        return pa.concat_tables(parts) if parts else pa.table({f.name: pa.array([], t) for f, t in zip(schema, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32()))})

    found = left.unionByName(right).groupBy("__c", "__q").applyInArrow(work, schema).drop("row")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "lists_read")
