"""Phrase collocations: Misra-Gries summaries per hash partition find what may be frequent, a second pass counts it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import byte_slices

UNKNOWN = "und"
#: Bytes of text that numpy takes at a time.
CHUNK = 2 << 20
#: Phrase hashes that a task sums up before it sends them on.
FLUSH = 1 << 20
#: A filter of survivors has at most 2 to this many bits (16 MB).
FILTER_BITS = 27
#: Hash partitions: 2 to these many at least and at most, about 2^22 phrases each.
LEAST_PARTS, MOST_PARTS = 8, 16

# Kinds of bytes: 0 of a word, 1 between words, 2 between pieces. Bytes above 127 belong to words.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


@dataclass
class Runs:
    """Distinct runs of n words of a chunk: their words (n x distinct, places in `words`), their counts, and for n > 1
    the place of the run without its last word among the runs of n - 1 words."""

    words: pa.Array
    ids: np.ndarray
    parent: np.ndarray
    counts: np.ndarray

    def strings(self, picked: np.ndarray) -> pa.Array:
        return pc.binary_join_element_wise(*[self.words.take(pa.array(row[picked])) for row in self.ids], pa.scalar(" ", pa.large_string()))


def _chunks(data: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Stretches of about `most` bytes that end behind a separator."""
    start = 0
    while start < len(data):
        stop = start + most
        while stop < len(data):
            hit = np.flatnonzero(KIND[data[stop:stop + 65_536]])
            if len(hit):
                stop += int(hit[0]) + 1
                break
            stop += 65_536
        yield data[start:stop]
        start = min(stop, len(data))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key among the distinct keys, and those."""
    coded = pa.array(keys).dictionary_encode()
    return np.asarray(coded.indices), np.asarray(coded.dictionary)


def phrase_runs(texts: list[str], most: int, chunk: int = CHUNK) -> Iterator[list[Runs]]:
    """Per chunk of the texts, the distinct runs of 1 to `most` words inside pieces.

    A chunk begins with the last words of the one before, and counts the runs that end in its own words, so every
    occurrence is counted once, however long a text or a piece is.
    """
    data = np.frombuffer("\n".join(texts).encode().lower(), np.uint8)  # bytes lower A-Z alone; \n ends a piece
    kept = most - 1
    before = pa.array([], pa.large_string())
    pieces_before = np.empty(0, np.int64)
    piece = 0
    for part in _chunks(data, chunk):
        kind = KIND[part]
        inside = kind == 0
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        breaks = np.flatnonzero(kind == 2)
        pieces = np.concatenate([pieces_before, piece + np.searchsorted(breaks, starts)])
        piece += len(breaks)
        ends = np.concatenate([[0], np.cumsum(stops - starts)])
        fresh = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(part[inside]))
        words = pa.concat_arrays([before, fresh])
        own, n_words = len(before), len(words)
        before, pieces_before = words[max(0, n_words - kept):], pieces[max(0, n_words - kept):]
        if not len(fresh):
            continue
        coded = words.dictionary_encode()
        vocabulary, word = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        out: list[Runs] = []
        at, code = np.arange(n_words), word
        ids = np.arange(len(vocabulary))[None, :]
        parent = np.empty(0, np.int64)
        for n in range(1, most + 1):
            if n > 1:
                stays = np.flatnonzero((at + n - 1 < n_words) & (pieces[at] == pieces[np.minimum(at + n - 1, n_words - 1)]))
                at, code = at[stays], code[stays]
                if not len(at):
                    break
                code, keys = _distinct(code * len(vocabulary) + word[at + n - 1])
                code = code.astype(np.int64)
                parent = keys // len(vocabulary)
                ids = np.vstack([out[-1].ids[:, parent], keys % len(vocabulary)])
            counts = np.bincount(code[at + n - 1 >= own], minlength=ids.shape[1])
            out.append(Runs(vocabulary, ids, parent, counts))
        yield out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(runs: list[Runs], group: str) -> list[np.ndarray]:
    """64-bit hashes of the distinct runs; the same run of a group has the same hash in every chunk."""
    seed = xxhash.xxh64_intdigest(group.encode())
    word = np.array([xxhash.xxh64_intdigest(w, seed) for w in runs[0].words.cast(pa.large_binary()).to_pylist()], np.uint64)
    out = [_mixed(word)]
    for r in runs[1:]:
        out.append(_mixed(out[-1][r.parent] * np.uint64(0x9E3779B97F4A7C15) + word[r.ids[-1]]))
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class MisraGries:
    """A mergeable summary of at most `capacity` keys. A count is too low by `error` at most, and (capacity + 1) x error
    stays within the mass: with a capacity above mass / threshold, no key that reaches the threshold is lost."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        self.error += error
        self.keys, self.counts = summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(self.keys) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            cut = int(np.partition(self.counts, at)[at])
            stays = self.counts > cut
            self.keys, self.counts, self.error = self.keys[stays], self.counts[stays] - cut, self.error + cut

    def survivors(self, threshold: int) -> np.ndarray:
        return self.keys[self.counts + self.error >= threshold]


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the high planes are nearly all zero and compress."""
    return np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(group, texts) of byte-sized slices; column 0 is the group, column 1 the text."""
    for batch in batches:
        for part in byte_slices(batch, 1):
            groups: dict[str, list[str]] = {}
            for g, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                groups.setdefault(g, []).append(t)
            yield from groups.items()


def _logged(x: float) -> int:
    return max(0, int(x) - 1).bit_length()


def surviving_filter(docs: DataFrame, most: int, threshold: int, least_parts: int = LEAST_PARTS, flush: int = FLUSH, chunk: int = CHUNK) -> tuple[bytes, int]:
    """(bits, their number's logarithm): a bit is set for every run of words in (grp, text) that may reach `threshold`.

    Tasks sum up hashes of runs and send them to their hash partition as packed rows; rows that say how much is sent
    come first, so that a partition knows its mass, and with it the capacity of its Misra-Gries summary, before the
    first key. A run with a third of all occurrences is one key of each such row. The filter has a fixed most size.
    """
    letters = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    mass = max(1, letters // 6 * most)
    parts = min(MOST_PARTS, max(least_parts, _logged(mass >> 22)))
    bits = min(FILTER_BITS, max(parts + 10, _logged(mass // threshold * 16)))
    shift = np.uint64(64 - parts)

    def rows_of(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        h, n = summed(np.concatenate(keys), np.concatenate(counts))
        edges = np.searchsorted(h >> shift, np.arange((1 << parts) + 1, dtype=np.uint64))
        small = (h >> np.uint64(32 - parts)).astype(np.uint32)
        out = []
        for p in np.flatnonzero(np.diff(edges)):
            k, c = small[edges[p]:edges[p + 1]], n[edges[p]:edges[p + 1]]
            once = c == 1
            out += [(p, 0, int(c.sum()), None, None, None), (p, 1, None, _packed(k[once]), _packed(k[~once]), c[~once].astype("<i8").tobytes())]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["part", "kind", "mass", "once", "more", "counts"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        for group, texts in _grouped(batches):
            for runs in phrase_runs(texts, most, chunk):
                for r, h in zip(runs, run_hashes(runs, group)):
                    met = r.counts > 0
                    keys.append(h[met])
                    counts.append(r.counts[met])
                    held += len(keys[-1])
                if held >= flush:
                    yield rows_of(keys, counts)
                    keys, counts, held = [], [], 0
        if held:
            yield rows_of(keys, counts)

    def survive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 1 << (bits - parts)

        def closed() -> pa.RecordBatch:
            merge()
            on = np.zeros(width, np.uint8)
            on[summary.survivors(threshold) >> np.uint32(32 - (bits - parts))] = 1
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(on).tobytes()], pa.binary())], names=["part", "bits"])

        def merge() -> None:
            nonlocal waiting
            if waiting:
                keys, counts = (np.concatenate(x) for x in zip(*waiting))
                summary.merge(keys, counts)
                waiting = []

        now, total, summary, waiting, held = None, 0, None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != now:
                    if now is not None:
                        yield closed()
                    now, total, summary, held = row["part"], 0, None, 0
                if row["kind"] == 0:
                    total += row["mass"]
                    continue
                summary = summary or MisraGries(total // threshold + 1)
                once, more = _unpacked(row["once"]), _unpacked(row["more"])
                waiting.append((np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), np.frombuffer(row["counts"], "<i8")])))
                held += len(once) + len(more)
                if held >= flush:
                    merge()
                    held = 0
        if now is not None:
            yield closed()

    sent = docs.select("grp", "text").mapInArrow(send, "part int, kind int, mass bigint, once binary, more binary, counts binary")
    dealt = sent.repartition("part").sortWithinPartitions("part", "kind")
    found = np.zeros((1 << parts, 1 << (bits - parts - 3)), np.uint8)
    for row in dealt.mapInArrow(survive, "part int, bits binary").toLocalIterator():
        found[row.part] = np.frombuffer(row.bits, np.uint8)
    return found.tobytes(), bits


def frequent_phrases(docs: DataFrame, most: int = 4, threshold: int = 30, text: str = "text", group: Column | None = None, **sizes) -> DataFrame:
    """(grp, words, phrase, n): exact counts of all runs of 1 to `most` words that occur `threshold` times in their group.

    One row per group with 0 words and an empty phrase has the number of all its words. Runs lie inside pieces and
    overlap; words are separated by spaces and tabs, pieces by . , ; : ! ? and line ends; A-Z are lower-cased.
    """
    spark = docs.sparkSession
    grp = F.lit("") if group is None else group
    told = docs.select(grp.cast("string").alias("grp"), F.col(f"`{text}`").cast("string").alias("text")).filter("text is not null and text <> ''")
    found, bits = surviving_filter(told, most, threshold, **sizes)
    shared = spark.sparkContext.broadcast(found)
    chunk = sizes.get("chunk", CHUNK)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.frombuffer(shared.value, np.uint8)
        types = [pa.string(), pa.int32(), pa.large_string(), pa.int64()]
        for grp, texts in _grouped(batches):
            for runs in phrase_runs(texts, most, chunk):
                total = int(runs[0].counts.sum())
                columns = [([grp], [0], pa.array([""], pa.large_string()), [total])]
                for size, (r, h) in enumerate(zip(runs, run_hashes(runs, grp)), 1):
                    bit = h >> np.uint64(64 - bits)
                    open_ = (on[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7)).astype(np.uint8))) & 1
                    picked = np.flatnonzero((open_ == 1) & (r.counts > 0))
                    columns.append(([grp] * len(picked), [size] * len(picked), r.strings(picked), r.counts[picked]))
                for c in columns:
                    if len(c[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(c[0], types[0]), pa.array(c[1], types[1]), c[2].cast(pa.string()), pa.array(c[3], types[3])],
                                                         names=["grp", "words", "phrase", "n"])

    counted = told.mapInArrow(count, "grp string, words int, phrase string, n bigint")
    return counted.groupBy("grp", "words", "phrase").agg(F.sum("n").alias("n")).filter((F.col("words") == 0) | (F.col("n") >= threshold))


def scored_phrases(found: DataFrame, factor: int = 2_000_000) -> DataFrame:
    """(grp, phrase, a, l, r, score) of the phrases of two words and more: the cut with the lowest floor(factor a / (l + r)),
    ties to the first. Decimals of 38 digits keep the arithmetic exact."""
    words = F.split("phrase", " ")
    cuts = found.filter("words > 1").select("grp", "phrase", F.col("n").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("grp", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    parts = found.filter("words > 0").select("grp", "phrase", "n")
    met = cuts.join(parts.select("grp", F.col("phrase").alias("first"), F.col("n").alias("l")), ["grp", "first"])
    met = met.join(parts.select("grp", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["grp", "rest"])
    exact = met.withColumn("score", F.expr(f"(cast(a as decimal(20, 0)) * cast({factor} as decimal(12, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))"))
    best = exact.groupBy("grp", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("grp", "phrase", "a", "best.l", "best.r", "best.score")


def outside_longer(found: DataFrame, candidates: DataFrame, percent: int = 80) -> DataFrame:
    """Candidates (grp, phrase, a, ...) but those that stand inside a longer frequent phrase at least `percent` % as frequent."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda n: F.transform(
        F.sequence(F.lit(1), F.col("words") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))))
    longer = found.filter("words > 2").select("grp", "words", words.alias("w"), "n")
    held = longer.select("grp", F.explode(inner).alias("phrase"), "n").groupBy("grp", "phrase").agg(F.max("n").alias("longer"))
    met = candidates.join(held, ["grp", "phrase"], "left")
    kept = F.expr(f"longer is null or cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * {percent}")
    return met.filter(kept).drop("longer")


def collocations(docs: DataFrame, most: int = 4, threshold: int = 30, top: int = 2000, text: str = "text", lang: str = "lang", **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language that hold together best.

    Everything is counted per language (null: `und`) over whole texts. Phrases of 2 to `most` words with a >= `threshold`
    occurrences are scored by their weakest cut into two parts with l and r occurrences; a phrase inside a longer one
    that is at least 80 % as frequent goes. The order is score and a descending, then the phrase's bytes; n is the
    number of the language's words.

    Null and empty texts hold no words. Repeated rows count as often as they stand. Very long texts are read in chunks,
    a word of any length is one word. Other columns are ignored, whatever their names. An empty table gives an empty one.
    """
    found = stored(frequent_phrases(docs, most, threshold, text, F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)), **sizes), "phrases")
    kept = outside_longer(found, scored_phrases(found))
    place = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase")))
    best = kept.withColumn("rank", place).filter(F.col("rank") <= top)
    total = found.filter("words = 0").select("grp", F.col("n").alias("total"))
    return best.join(total, "grp").select(F.col("grp").alias("lang"), F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), F.col("score").cast("bigint").alias("score"))
