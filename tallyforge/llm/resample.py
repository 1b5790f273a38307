"""Importance resampling towards a target: hashed word runs, log-ratio gains, Gumbel draws without replacement."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import byte_slices, map_texts

BUCKETS = 10_000
#: Words that one pass of the regular expression hands to numpy at a time.
BLOCK = 1 << 18
#: Stands between the texts of a batch; no word holds it.
SENTINEL = "\x00"

# Bytes above 127 belong to code points that are all word characters, so this is the pattern on code points.
_word = re.compile(rb"[0-9a-z\x80-\xff]+")


def concatenated(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    """The lower-cased texts of a batch in one string, each followed by a sentinel, and where each begins."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    sizes = np.asarray(pc.binary_length(texts)).astype(np.int64) + 1
    joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(texts)], texts), pa.scalar(SENTINEL, pa.large_string()))[0]
    return joined.as_buffer().to_pybytes().lower(), np.cumsum(sizes) - sizes  # bytes lower A-Z alone


def word_runs(texts: pa.Array, most: int, block: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(run length, document of each run, crc32 of each run), some at a time: all runs of 1 to `most` consecutive words.

    One pass of the pattern over the concatenated batch finds the words; the offsets of the documents tell whose they
    are, and runs that begin and end in different documents are masked. The crc32 of a run continues that of the run
    without its last word.
    """
    joined, offsets = concatenated(texts)
    found = _word.finditer(joined)
    spans = np.empty(0, np.int64)
    words: list[bytes] = []
    while fresh := list(itertools.islice(found, block)):
        seen = len(words)
        spans = np.concatenate([spans, np.fromiter((m.start() for m in fresh), np.int64, len(fresh))])
        words += [m.group() for m in fresh]
        owner = np.searchsorted(offsets, spans, side="right") - 1
        spaced = [b" " + w for w in words] if most > 1 else []
        sums: list[int] = []
        for n in range(1, most + 1):
            if len(words) < n:
                break
            sums = list(map(zlib.crc32, words)) if n == 1 else list(map(zlib.crc32, spaced[n - 1:], sums))
            begin = max(0, seen - n + 1)
            first, last = owner[begin:len(words) - n + 1], owner[begin + n - 1:]
            inside = first == last
            yield n, first[inside], np.array(sums[begin:len(words) - n + 1], np.int64)[inside]
        kept = most - 1
        words, spans = (words[-kept:], spans[-kept:]) if kept else ([], spans[:0])


def bucket_counts(docs: DataFrame, most: int = 1, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """Runs in each bucket over all texts. Tasks send one row per bucket that they met; the driver gets `buckets` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in byte_slices(batch, 0):
                for _, _, sums in word_runs(part.column(0), most):
                    total += np.bincount(sums % buckets, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    counted = docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed share in the target over that in the raw texts), per bucket."""
    more_t, more_s, k = float(target.sum() + len(target)), float(raw.sum() + len(raw)), len(raw)
    return np.array([math.floor(1000 * math.log((float(target[i]) + 1) * more_s / ((float(raw[i]) + 1) * more_t))) for i in range(k)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, most: int = 1, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns with n_words, n_features (runs) and weight (sum of the gains of their buckets) of every row."""

    def work(texts: pa.Array) -> list:
        n_words, n_runs, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
        for n, owner, sums in word_runs(texts, most):
            n_runs += np.bincount(owner, minlength=len(texts))
            if n == 1:
                n_words += np.bincount(owner, minlength=len(texts))
            # Sums of whole numbers below 2^53 are exact in doubles.
            weight += np.bincount(owner, gains[sums % len(gains)], minlength=len(texts)).astype(np.int64)
        return [n_words, n_runs, weight]

    return map_texts(docs, work, "n_words bigint, n_features bigint, weight bigint", keep, text, as_arrow=True)


def gumbel(key: Column, seed: int) -> Column:
    """floor(1000 x a Gumbel number) drawn by the sha256 of seed:key, the same wherever and however often it is made."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def ranked(rows: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based place of every row in the order, without a sort in one task: ranges are ordered alone, and the sizes of
    earlier ranges are added. Equal rows are told apart by where they are stored, so a crowded value is cut too."""
    numbered = stored(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    placed = stored(numbered.repartitionByRange(*order, "__row").withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy("__range").agg(F.count("*").alias("n"))
    ahead = sizes.select("__range", F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__ahead"))
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order, "__row"))
    return placed.withColumn("__in", inside).join(ahead, "__range").withColumn(name, (F.col("__ahead") + F.col("__in")).cast("bigint")).select(*rows.columns, name)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, most: int = 1, buckets: int = BUCKETS, seed: int = 2024,
             id_col: str = "doc_id", text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """id, `keep` columns, n_words, n_features, weight, score and rank of every document; `percent` of them are drawn.

    Features are runs of 1 to `most` words of the whole text, in `buckets` by crc32. A document's weight is the sum of its features' gains towards
    `target`; score adds a Gumbel number, so the highest scores are a draw without replacement by importance. Of the
    N documents with at least `min_words` words, the floor(percent N / 100) highest get ranks from 1, ties to the
    smaller id; rank is null for all others.

    Null and empty texts have no features and weight 0. Rows with the same id are weighed and ranked one by one, a
    null id draws by an empty key and comes first among ties. Very long texts are read in blocks of words. Columns
    that are not kept are dropped, and a kept column named like a result gives way. An empty table gives an empty
    one; with an empty target all buckets have the same share there.
    """
    results = ("n_words", "n_features", "weight", "score", "rank")
    keep = [c for c in dict.fromkeys([id_col, *keep]) if c not in results]
    gains = bucket_gains(bucket_counts(target, most, buckets, text), bucket_counts(docs, most, buckets, text))
    weighed = weigh(docs, gains, most, keep, text)
    scored = stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col(f"`{id_col}`"), seed)), "scores")
    enough = F.col("n_words") >= min_words
    quota = scored.filter(enough).count() * percent // 100
    placed = ranked(scored.filter(enough), [F.desc("score"), F.asc(f"`{id_col}`"), F.asc("n_features")])
    drawn = placed.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")))
    return drawn.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("bigint")))
