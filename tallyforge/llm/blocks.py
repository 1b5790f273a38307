"""Comparing the members of groups in blocks of bounded size.

A group, however large, is cut into chunks; each pair of chunks is one block, and blocks spread over all tasks. A block
returns counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import stored

BLOCK = ["__block", "__i", "__kind", "__j"]
#: What a block returns: a member, its links here, and another member of its tree (itself at the root).
FOUND = "id bigint, n bigint, root bigint"


def in_blocks(rows: DataFrame, work: Callable, chunk: int, small: int = 0, counted: DataFrame | None = None) -> DataFrame:
    """Runs `work(key, table)` on blocks of `rows` (grp bigint, visits boolean, id bigint, ...).

    Members of a group that do not visit are compared with each other; visitors are compared with those. Rows get
    `side`: 0 and 1 are compared; a block of kind 0 with i = j is one chunk against itself. With `small`, groups that
    have one chunk and no visitors share blocks of about `small` rows (kind 2); `work` tells them apart by grp.
    """
    sizes = rows.groupBy("grp").agg(
        F.sum(F.when(F.col("visits"), 0).otherwise(1)).alias("homes"), F.sum(F.when(F.col("visits"), 1).otherwise(0)).alias("guests"))
    sizes = stored(sizes.filter("homes > 1 or (homes = 1 and guests > 0)"), "sizes")
    shared = F.lit(False)
    buckets = F.lit(1)
    if small:
        members = sizes.agg(F.sum("homes").alias("n")).first()["n"] or 0
        buckets = F.lit(max(1, -(-members // small)))
        shared = (F.col("homes") <= chunk) & (F.col("guests") == 0)
    plan = sizes.select("grp", shared.alias("__shared"), F.ceil(F.col("homes") / chunk).cast("int").alias("__h"),
                        F.ceil(F.col("guests") / chunk).cast("int").alias("__v"))
    met = rows.join(plan, "grp")
    home = F.pmod(F.xxhash64("id"), F.col("__h")).cast("int")
    guest = F.pmod(F.xxhash64("id"), F.greatest("__v", F.lit(1))).cast("int")

    def place(i, kind: int, j, side):
        return F.struct(i.cast("int").alias("__i"), F.lit(kind).alias("__kind"), j.cast("int").alias("__j"), side.cast("int").alias("side"))

    homes = F.sequence(F.lit(0), F.col("__h") - 1)
    with_homes = F.transform(homes, lambda k: place(F.least(home, k), 0, F.greatest(home, k), (k < home)))
    with_guests = F.transform(F.filter(F.sequence(F.lit(0), F.col("__v")), lambda k: k < F.col("__v")), lambda k: place(home, 1, k, F.lit(0)))
    visiting = F.transform(homes, lambda k: place(k, 1, guest, F.lit(1)))
    together = F.array(place(F.lit(0), 2, F.lit(0), F.lit(0)))
    places = F.when(F.col("__shared"), together).when(F.col("visits"), visiting).otherwise(F.concat(with_homes, with_guests))
    dealt = met.withColumn("__place", F.explode(places)).select(
        F.when(F.col("__shared"), F.pmod(F.xxhash64("grp"), buckets)).otherwise(F.col("grp")).alias("__block"), "__place.*", *rows.columns)
    return dealt.groupBy(*BLOCK).applyInArrow(work, FOUND)


def join_trees(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after the links (i, j): labels fall to the smallest one met, roots are hooked to smaller roots."""
    while len(i):
        low = np.minimum(parent[i], parent[j])
        new = parent.copy()
        for at in (i, j, parent[i], parent[j]):
            np.minimum.at(new, at, low)
        while not np.array_equal(shorter := new[new], new):
            new = shorter
        if np.array_equal(new, parent):
            break
        parent = new
        open_ = parent[i] != parent[j]
        i, j = i[open_], j[open_]
    return parent


def components(found: DataFrame) -> DataFrame:
    """(id, component): smallest id reachable, for the members that have a link."""
    edges = found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()
    edges = stored(edges, "forest")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return connected_components(nodes, edges)
