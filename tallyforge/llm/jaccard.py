"""Join of documents by the Jaccard similarity of their word shingles: MinHash LSH forest, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .blocks import FOUND, components, join_trees
from .common import byte_slices, giving_back, map_texts

WORDS = 5
THRESHOLD = 0.8
#: Trees of the forest, and the values of a signature in each: the longest prefix, at which few links may do.
TREES = 24
LONGEST = 6
#: Prefixes are shortened until so small a part of the links is expected to be missed, or so few links.
MISSED_SHARE = 1e-6
MISSED = 1e-3
#: Documents of a chunk, and rows of small blocks that share a task's group.
CHUNK = 1024
SHARED = 1024
#: Similarities of links are counted in so many steps between the threshold and 1.
STEPS = 40

#: ASCII characters that part words; letters, digits and characters outside ASCII make them.
_PARTING = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def met_at(depth: int, trees: int, similarity: np.ndarray | float):
    """Chance that a pair of this similarity shares a prefix of this length in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def expected_missed(counts: np.ndarray, depth: int, trees: int, threshold: float) -> float:
    """Links missed at a depth, judged by those found: each stands for 1 / chance links like it, 1 / chance - 1 of them
    not met. One link at the threshold that nobody saw is counted as well. `counts` are links by similarity, each step
    taken at its lower end."""
    low = threshold + (1 - threshold) * np.arange(len(counts)) / len(counts)
    return float(((1 / met_at(depth, trees, low) - 1) * counts).sum() + 1 / met_at(depth, trees, threshold) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _multipliers(n: int) -> np.ndarray:
    """Odd numbers, the same in every task."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_STEPS = _multipliers(64)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `words` words, lower-cased. A text of fewer words is one run of
    all of them; a text without words has none."""
    parts = (text or "").lower().encode("utf-8").translate(_PARTING).split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    w = min(words, len(h))
    n = len(h) - w + 1
    total = np.full(n, w, dtype=np.uint64)
    for k in range(w):
        total += h[k : k + n] * _STEPS[k]
    return np.unique(_mixed(total))


def signature(hashes: np.ndarray, trees: int, longest: int) -> np.ndarray:
    """(trees, longest) values of the MinHash signature, 32 bits each."""
    a = _multipliers(trees * longest)
    low = np.full(trees * longest, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), 2048):
        low = np.minimum(low, (hashes[k : k + 2048, None] * a[None, :]).min(axis=0))
    return (_mixed(low) >> np.uint64(32)).astype(np.uint32).reshape(trees, longest)


def prefixes(signed: np.ndarray, depth: int) -> np.ndarray:
    """(documents, trees): one 64-bit key for the first `depth` values of each tree of (documents, trees, longest)."""
    key = np.broadcast_to(np.arange(1, signed.shape[1] + 1, dtype=np.uint64), signed.shape[:2])
    for k in range(depth):
        key = _mixed(key * _STEPS[7] + signed[:, :, k])
    return key


def signatures(docs: DataFrame, id_col: str, text: str, words: int, trees: int, longest: int) -> DataFrame:
    """(id, s1, s2, size, signed): two hashes of the shingle set, its size, and its signature."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))

    def work(texts: list) -> list:
        s1, s2, size, signed = [], [], [], []
        for t in texts:
            h = shingles(t, words)
            raw = h.tobytes()
            s1.append(xxhash.xxh3_64_intdigest(raw) - (1 << 63))
            s2.append(xxhash.xxh3_64_intdigest(raw, seed=1) - (1 << 63))
            size.append(len(h))
            signed.append(signature(h, trees, longest).tobytes() if len(h) else b"")
        return [pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(size, pa.int64()), pa.array(signed, pa.binary())]

    return map_texts(rows, work, "s1 bigint, s2 bigint, size bigint, signed binary", ["id"])


def trie_nodes(known: DataFrame, depth: int, trees: int, longest: int) -> DataFrame:
    """(id, tree, node, child): the node of each tree's prefix trie that a document reaches at `depth`, and the one below
    it (0 at the longest prefix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                signed = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint32).reshape(part.num_rows, trees, longest)
                node = prefixes(signed, depth)
                child = prefixes(signed, depth + 1) if depth < longest else np.zeros_like(node)
                id_ = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), trees)))
                tree = np.tile(np.arange(trees, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([id_, pa.array(tree), pa.array(node.ravel().view(np.int64)), pa.array(np.ascontiguousarray(child).ravel().view(np.int64))],
                                                 names=["id", "tree", "node", "child"])

    return known.select("id", "signed").mapInArrow(giving_back(run), "id bigint, tree int, node bigint, child bigint")


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(id, copies, keys, v): the shingle sets of documents, beside what they come with."""
    schema = "id bigint, copies bigint, keys binary, v binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 3):
                v = pa.array([shingles(t, words).tobytes() for t in part.column(3).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], v], names=["id", "copies", "keys", "v"])

    return rows.select("id", "copies", "keys", "text").mapInArrow(giving_back(run), schema)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one side with all of the other, in strips of shingles."""
    flat = np.concatenate([*left, *right])
    values, codes = np.unique(flat, return_inverse=True)
    sizes = np.array([len(s) for s in [*left, *right]])
    rows = np.repeat(np.arange(len(sizes)), sizes)
    often = np.bincount(codes, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    use = often[codes]
    rows, codes = rows[use], column[codes[use]]
    order = np.argsort(codes, kind="stable")
    rows, codes = rows[order], codes[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    width = int(often.sum())
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(codes, [lo, lo + 4096])
        strip = np.zeros((len(sizes), min(4096, width - lo)), dtype=np.float32)
        strip[rows[a:b], codes[a:b] - lo] = 1
        out += strip[: len(left)] @ strip[len(left) :].T
    return out


_LINKS = f"{FOUND}, step int"


def link_blocks(threshold: float, trees: int):
    """Links of the blocks of one group, weighed by the copies of the other side; exact counts of shared shingles.

    A block compares the documents of two chunks, or of one with itself. Of its pairs those count that share a node of
    this depth in some tree and none below it, so that a pair counts at one depth. Counts of links by similarity come as
    rows without an id.
    """

    def linked(left: np.ndarray, right: np.ndarray, sets: list, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = left is right
        both = shared_counts([sets[i] for i in left], [sets[i] for i in right])
        size = np.array([len(s) for s in sets], dtype=np.float64)
        similarity = both / (size[left][:, None] + size[right][None, :] - both)
        a, b = np.nonzero((similarity >= threshold) & (left[:, None] < right[None, :] if own else True))
        s = similarity[a, b]
        a, b = left[a], right[b]
        new = np.ones(len(a), bool)
        for k in range(0, len(a), 100_000):
            same = keys[a[k : k + 100_000]] == keys[b[k : k + 100_000]]
            new[k : k + 100_000] = same[:, :trees].any(axis=1) & ~same[:, trees:].any(axis=1)
        return a[new], b[new], s[new]

    def work(key, table):
        table = table.sort_by([("low", "ascending"), ("high", "ascending"), ("id", "ascending")])
        ids, side, low, high, copies = (table[c].to_numpy() for c in ("id", "side", "low", "high", "copies"))
        sets = [np.frombuffer(v, dtype=np.uint64) for v in table["v"].to_pylist()]
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int64).reshape(len(ids), -1)
        parent, links, counts = np.arange(len(ids)), np.zeros(len(ids), np.int64), np.zeros(STEPS, np.int64)
        edges = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1]), [True]]))
        for x, y in zip(edges, edges[1:]):
            at = np.arange(x, y)
            left, right = (at, at) if low[x] == high[x] else (at[side[at] == 0], at[side[at] == 1])
            if not len(left) or not len(right):
                continue
            a, b, s = linked(left, right, sets, keys)
            links += np.bincount(a, copies[b], len(ids)).astype(np.int64) + np.bincount(b, copies[a], len(ids)).astype(np.int64)
            counts += np.bincount(np.minimum(((s - threshold) / (1 - threshold) * STEPS).astype(np.int64), STEPS - 1), minlength=STEPS)
            parent = join_trees(parent, a, b)
        hit, seen = np.flatnonzero(links), np.flatnonzero(counts)
        none = pa.nulls(len(seen), pa.int64())
        return pa.table({
            "id": pa.concat_arrays([pa.array(ids[hit]), none]), "n": pa.array(np.concatenate([links[hit], counts[seen]])),
            "root": pa.concat_arrays([pa.array(ids[parent[hit]]), none]), "step": pa.concat_arrays([pa.nulls(len(hit), pa.int32()), pa.array(seen.astype(np.int32))])})

    return work


def forest_links(known: DataFrame, texts: DataFrame, depth: int, threshold: float, words: int, trees: int, longest: int) -> DataFrame:
    """Links, as `link_blocks` returns them, between documents that meet in a node of `depth` and in none below it.

    Documents are dealt to chunks by the smallest document they meet, large groups into several. Two chunks are compared
    if they share a node, and then by those of their documents that do; never all pairs of a cluster that a chain of
    candidates ties together. Nodes are written down before their joins, so that a crowded one is split.
    """
    nodes = trie_nodes(known, depth, trees, longest)
    shared = nodes.groupBy("tree", "node").agg(F.min("id").alias("lead"), F.count("*").alias("n"), (F.min("child") != F.max("child")).alias("parts"))
    shared = stored(shared.filter("n > 1" if depth == longest else "n > 1 and parts").select("tree", "node", "lead"), "nodes")
    members = stored(nodes.join(shared, ["tree", "node"]).select("id", "tree", "node", "lead"), "members")
    gathered = members.groupBy("id").agg(F.min("lead").alias("lead"))
    sizes = gathered.groupBy("lead").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    chunk = F.xxhash64("lead", F.pmod(F.xxhash64("id"), F.col("chunks")))
    placed = stored(gathered.join(sizes, "lead").select("id", chunk.alias("chunk")), "chunks")
    homes = members.select("id", "tree", "node").join(placed, "id")
    met = homes.select("tree", "node", F.col("chunk").alias("other")).distinct()
    pairs = homes.join(met, ["tree", "node"]).select("id", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                                                    (F.col("chunk") > F.col("other")).cast("int").alias("side")).distinct()
    bodies = known.select("id", "copies", "signed").join(placed.select("id"), "id", "left_semi").join(texts, "id")
    sets = _sets(_keyed(bodies, depth, trees, longest), words)
    dealt = stored(pairs, "blocks")
    buckets = max(1, -(-dealt.count() // SHARED))
    rows = dealt.join(sets, "id").withColumn("__bucket", F.pmod(F.xxhash64("low", "high"), F.lit(buckets)))
    return rows.groupBy("__bucket").applyInArrow(link_blocks(threshold, trees), _LINKS)


def _keyed(rows: DataFrame, depth: int, trees: int, longest: int) -> DataFrame:
    """(id, copies, keys, text): the nodes of all trees at `depth`, then those below it, which the longest prefix has not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(batch.num_rows, trees, longest)
            keys = np.hstack([prefixes(signed, d) for d in range(depth, min(depth + 1, longest) + 1)])
            made = pa.array([r.tobytes() for r in keys], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made, batch.column(3)], names=["id", "copies", "keys", "text"])

    return rows.select("id", "copies", "signed", "text").mapInArrow(giving_back(run), "id bigint, copies bigint, keys binary, text string")


def similar_docs(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, trees: int = TREES, longest: int = LONGEST,
                 id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id_col, class_id, n_links, component_id, kept: one row per id.

    Documents with the same shingle set are one class, whose id is its smallest member. Classes link if the Jaccard
    similarity of their sets is at least `threshold`; n_links counts all other documents linked, copies included.
    component_id is the smallest id reachable; kept marks the document of that id.

    The forest: each tree is a prefix trie of its part of the documents' MinHash signatures. Documents that share the
    longest prefix in some tree are compared first, exactly. From the similarities of the links found follows how many
    links were missed; prefixes are shortened by one value, and those that meet only now are compared, until that
    number is at most MISSED, or MISSED_SHARE of the links.

    Null texts and texts without words have no shingles and link with nothing. Very long texts are compared whole. Rows
    without an id are left out; rows that repeat an id count once, with the smallest of their texts. Other columns are
    dropped. An empty table gives no rows.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).filter("id is not null")
    signed = stored(signatures(texts, "id", "text", words, trees, longest), "signatures")
    if signed.count() != signed.select("id").distinct().count():
        texts = stored(texts.groupBy("id").agg(F.min("text").alias("text")), "texts")
        signed = stored(signatures(texts, "id", "text", words, trees, longest), "signatures")
    once = signed.select("id", "s1", "s2", "size")
    classes = stored(once.filter("size > 0").groupBy("s1", "s2").agg(F.min("id").alias("class"), F.count("*").alias("copies")), "classes")
    known = stored(signed.join(classes.select(F.col("class").alias("id"), "copies"), "id").select("id", "copies", "signed"), "known")
    found, counts = docs.sparkSession.createDataFrame([], FOUND), np.zeros(STEPS, np.int64)
    for depth in range(longest, 0, -1):
        level = stored(forest_links(known, texts, depth, threshold, words, trees, longest), "links")
        found = found.unionByName(level.filter("id is not null").drop("step"))
        for r in level.filter("id is null").groupBy("step").agg(F.sum("n").alias("n")).collect():
            counts[r["step"]] += r["n"]
        if expected_missed(counts, depth, trees, threshold) <= max(MISSED, MISSED_SHARE * counts.sum()):
            break
    parts = components(found)
    links = found.groupBy("id").agg(F.sum("n").alias("n"))
    by_class = classes.select("s1", "s2", "class", "copies").join(links, F.col("class") == F.col("id"), "left").drop("id").join(parts, F.col("class") == F.col("id"), "left")
    out = once.select("id", "s1", "s2", "size").join(by_class.select("s1", "s2", "class", "copies", "n", "component"), ["s1", "s2"], "left")
    empty = F.col("size") == 0
    out = out.select(
        F.col("id").alias(id_col),
        F.when(empty, F.col("id")).otherwise(F.col("class")).alias("class_id"),
        F.when(empty, F.lit(0)).otherwise(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"),
        F.when(empty, F.col("id")).otherwise(F.coalesce("component", "class")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("component_id") == F.col(id_col))
