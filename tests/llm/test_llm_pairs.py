"""Operators on pairs against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from tallyforge.llm import blocks, jaccard, topk, vectors


def smallest_reachable(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_trees_join_as_union_find():
    rng = np.random.default_rng(3)
    for n, m in [(1, 0), (10, 5), (50, 200), (200, 120)]:
        parent, links = np.arange(n), []
        for _ in range(3):
            i, j = rng.integers(0, n, m), rng.integers(0, n, m)
            links += list(zip(i.tolist(), j.tolist()))
            parent = blocks.join_trees(parent, i, j)
        want = smallest_reachable(range(n), links)
        assert parent.tolist() == [want[i] for i in range(n)]


# ---- top-k ---------------------------------------------------------------------------------------


def brute_top(rows, queries, k):
    out = {}
    for q, x in queries:
        scored = sorted((-int(np.dot(x, y)), i) for i, y in rows if i != q and len(y) == len(x))[:k]
        out.update({(q, r + 1): (i, -s) for r, (s, i) in enumerate(scored)})
    return out


@pytest.mark.parametrize("block", [16, 1000])
def test_top_k(spark, block):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(5, 12)) * 10
    rows = [(i, [float(v) for v in np.floor(centers[i % 5] + rng.normal(size=12) * 3)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + [(2000, [0.0] * 12), (2001, [1.0, 2.0])]
    queries = [r for r in rows if r[0] % 20 == 0] + [(5001, rows[3][1])]
    as_df = lambda x: spark.createDataFrame(x, "id bigint, v array<double>")
    got = topk.top_k(as_df(rows), as_df(queries), 20, block=block, query_block=9).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in got} == brute_top(rows, queries, 20)
    assert all(0 < r.lists_read <= 1 for r in got)
    few = topk.top_k(as_df(rows[:3]), as_df(rows[:1]), 20).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert topk.top_k(as_df(rows).limit(0), as_df(queries), 20).count() == 0 == topk.top_k(as_df(rows), as_df(queries).limit(0), 20).count()


def test_bounds_hold_and_reading_stops_early():
    rng = np.random.default_rng(5)
    x, q = np.floor(rng.normal(size=(400, 6)) * 50), np.floor(rng.normal(size=(30, 6)) * 50)
    x[:5] += np.floor(9 * q[:1])
    lists, exact = topk.SortedLists(x), q @ x.T
    for depth in (1, 40, 200, 399, 400):
        low, high = lists.bounds(q, depth)
        assert (low <= exact).all() and (exact <= high).all()
    _, _, _, shares = topk.nearest(lists, np.arange(400), q, np.arange(1000, 1030), 5)
    assert shares.min() < 1


def test_vectors_that_take_no_part_in_top_k(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, [0.5, -0.26], 1), (1, None, 1), (2, [None, 1.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (None, [1.0, 1.0], 1)],
                               "vec_id bigint, embedding array<float>, score int")
    assert [(r.id, r.v) for r in topk.integer_vectors(df, 64, "vec_id", "embedding").collect()] == [(0, [32.0, -17.0])]


# ---- vectors -------------------------------------------------------------------------------------


def brute_vectors(rows, threshold):
    good = {i: np.array(v, float) for i, v in rows.items() if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = []
    for a in good:
        for b in good:
            if a < b and np.dot(good[a], good[b]) / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= threshold:
                links.append((a, b))
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    component = smallest_reachable(rows, links)
    return {i: (n[i], component[i], component[i] == i) for i in rows}


@pytest.mark.parametrize("width, chunk", [(16, 2048), (16, 20), (2, 50), (1, 50)])
def test_near_vectors(spark, monkeypatch, width, chunk):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rng = np.random.default_rng(width)
    rows = {}
    for i in range(250):
        rows[i] = rng.normal(size=width)
    hub = rng.normal(size=width)
    for i in range(250, 400):
        rows[i] = hub + rng.normal(size=width) * rng.choice([0.02, 0.3, 0.5])
    rows = {i: np.float32(v).tolist() for i, v in rows.items()}
    rows |= {500: None, 501: [0.0] * width, 502: [float("nan")] * width, 503: [None] * width, 504: rows[250], 505: [x * 1e-20 for x in rows[250]], 506: []}
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows.items()], "vec_id bigint, embedding array<float>, n_links string")
    # Tiny vectors link too: they are scaled before they are squared.
    rows[505] = np.float32(rows[505]).tolist()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()}
    assert got == brute_vectors(rows, 0.9)


def test_near_vector_cases(spark):
    schema = "vec_id bigint, embedding array<double>"
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01]), (None, [1.0, 0.0]), (3, [1.0])], schema)
    assert sorted(map(tuple, vectors.near_vectors(df).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    mixed = spark.createDataFrame([(k, [1.0, 2.0]) for k in (4, 5, 6)] + [(k, [1.0, 0.1 * k, 0.0]) for k in (7, 8, 9, 10)] + [(11, [2.0])], schema)
    assert {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(mixed).collect()} == {
        **{k: (2, 4) for k in (4, 5, 6)}, **{k: (3, 7) for k in (7, 8, 9, 10)}, 11: (0, 11)}
    assert vectors.near_vectors(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(9, None)], schema)
    assert list(map(tuple, vectors.near_vectors(alone).collect())) == [(9, 0, 9, True)]


# ---- documents -----------------------------------------------------------------------------------


def brute_docs(rows, threshold=0.8):
    sets = {i: set(jaccard.shingles(t).tolist()) for i, t in rows.items()}
    links = []
    for a in rows:
        for b in rows:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both / (len(sets[a]) + len(sets[b]) - both) >= threshold:
                    links.append((a, b))
    n = defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    component = smallest_reachable(rows, links)
    return {i: (n[i], component[i], component[i] == i) for i in rows}


def near_copies():
    rng = random.Random(6)
    words = [f"w{k}" for k in range(3000)]
    rows, i = {}, 0
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(30, 200))]
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows[i] = rng.choice([" ", "\n", ", "]).join(copy)
            i += 1
    return rows | {1000: None, 1001: "", 1002: "...", 1003: "one two", 1004: "One, two!", 1005: "one two three", 1006: "x " * 30_000, 1007: "x " * 30_000}


@pytest.mark.parametrize("chunk", [256, 7])
def test_similar_docs(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rows = near_copies()
    df = spark.createDataFrame([(i, t, 0, True) for i, t in rows.items()], "doc_id bigint, text string, n_links int, kept boolean")
    got = jaccard.similar_docs(df).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_docs(rows)
    assert {r.class_id for r in got if r.doc_id in (1003, 1004)} == {1003}


def test_similar_doc_cases(spark):
    schema = "doc_id bigint, text string"
    text = "a b c d e f g h"
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (3, "other"), (3, "zz")], schema)
    assert sorted(map(tuple, jaccard.similar_docs(df).collect())) == [(1, 1, 1, 1, True), (2, 1, 1, 1, False), (3, 3, 0, 3, True)]
    assert jaccard.similar_docs(df.limit(0)).count() == 0


def test_prefixes_of_signatures():
    a, b = (jaccard.shingles(" ".join(map(str, range(k, k + 1000)))) for k in (0, 60))
    both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    x, y = (jaccard.signature(v, 500, 8) for v in (a, b))
    assert abs((x == y).mean() - both) < 0.03
    signed = np.stack([x, y])
    for depth in (1, 3, 8):
        keys = jaccard.prefixes(signed, depth)
        assert ((keys[0] == keys[1]) == (x[:, :depth] == y[:, :depth]).all(axis=1)).all()
        assert abs((keys[0] == keys[1]).mean() - both**depth) < 0.08


def test_missed_links_are_judged_by_those_found():
    counts = np.zeros(jaccard.STEPS, np.int64)
    alone = [jaccard.expected_missed(counts, d, 24, 0.8) for d in range(8, 0, -1)]
    assert alone == sorted(alone, reverse=True) and alone[0] > jaccard.MISSED > alone[2]
    counts[0] = 1000  # at the threshold
    assert abs(jaccard.expected_missed(counts, 8, 24, 0.8) / 1001 - ((1 - 0.8**8) ** 24 / (1 - (1 - 0.8**8) ** 24))) < 1e-9
    high = np.zeros(jaccard.STEPS, np.int64)
    high[-1] = 1000
    assert jaccard.expected_missed(high, 8, 24, 0.8) < 1e-3 + alone[0]


def test_shortening_goes_on_until_links_at_the_threshold_are_met(spark, monkeypatch):
    depths = []
    plain = jaccard.forest_links
    monkeypatch.setattr(jaccard, "forest_links", lambda *a: (depths.append(a[2]), plain(*a))[1])
    rng = random.Random(7)
    rows = {}
    for i in range(60):  # pairs of similarity just above 0.8
        words = [f"{i}-{k}" for k in range(104)]
        rows[2 * i], rows[2 * i + 1] = " ".join(words), " ".join(words[11:] + [f"{i}+{k}" for k in range(11)])
    got = jaccard.similar_docs(spark.createDataFrame(list(rows.items()), "doc_id bigint, text string"), trees=4).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_docs(rows)
    assert depths == list(range(jaccard.LONGEST, depths[-1] - 1, -1)) and depths[-1] <= 2 and rng


def test_chains_of_candidates_are_not_compared_pair_by_pair(spark):
    words = [f"w{k}" for k in range(1400)]
    rows = {i: " ".join(words[8 * i : 8 * i + 100]) for i in range(160)}  # each near to the next two only
    got = jaccard.similar_docs(spark.createDataFrame(list(rows.items()), "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_docs(rows)
