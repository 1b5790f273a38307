"""Components against union-find, long chains included."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.graph import connected_components, star_rounds


def smallest(nodes, links):
    parent = {i: i for i in nodes}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_union_find(spark, seed):
    rng = random.Random(seed)
    nodes = rng.sample(range(10_000), 400)
    links = [tuple(rng.sample(nodes, 2)) for _ in range(250)] + [(nodes[0], n) for n in nodes[1:80]] + [(nodes[5], nodes[5]), (nodes[6], nodes[7]), (nodes[7], nodes[6])]
    got = connected_components(spark.createDataFrame([(n,) for n in nodes], "id bigint"), spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.id: r.component for r in got} == smallest(nodes, links) and len(got) == len(nodes)


def test_no_links(spark):
    nodes = spark.range(3)
    edges = spark.createDataFrame([], "a bigint, b bigint")
    assert sorted(map(tuple, connected_components(nodes, edges).collect())) == [(0, 0), (1, 1), (2, 2)]


def test_a_shuffled_path_of_100000_settles(spark):
    """Spreading labels alone takes some 34,000 rounds here."""
    n = 100_000
    order = list(range(n))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a bigint, b bigint")
    pairs, rounds = star_rounds(edges)
    assert rounds < 40
    assert pairs.count() == n - 1 and pairs.filter(F.col("b") != 0).isEmpty()
