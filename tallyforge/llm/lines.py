"""Line dedup with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: ASCII white space, [\\x20\\x09-\\x0D].
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased. `lower` does the same on a line of ASCII alone."""
    bare = F.btrim(line, F.lit(SPACES))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def repeated_lines(docs: DataFrame, id_col: str, text: str, min_docs: int, min_length: int) -> DataFrame:
    """(doc, places): 0-based places of the lines that go, for documents that lose any.

    Keys meet as two 64-bit hashes with different seeds. Counts are combined before they are shuffled, also for a key
    that a third of all documents hold. The keys that go are written down first, so that both sides of their join are
    plain shuffles, of which a crowded partition is split.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.posexplode(F.split(F.col(f"`{text}`"), "\n")).alias("place", "line"))
    keyed = rows.select("doc", "place", line_key(F.col("line")).alias("key")).filter(F.char_length("key") >= min_length)
    hashed = stored(keyed.select("doc", "place", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")), "lines")
    once = hashed.groupBy("h1", "h2", "doc").agg(F.lit(1).alias("one"))
    spread = once.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc").alias("last")).filter(F.col("n") >= min_docs)
    gone = hashed.join(stored(spread.select("h1", "h2", "last"), "keys"), ["h1", "h2"]).filter(F.col("doc") != F.col("last"))
    return gone.groupBy("doc").agg(F.collect_list("place").alias("places"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 5, min_length: int = 40) -> DataFrame:
    """All columns of `docs`, the text without its repeated lines, and n_lines, n_dropped.

    A line whose key has at least `min_length` code points and stands in at least `min_docs` documents stays only in
    the document with the largest id that holds it, there as often as it stands. Null and empty texts are one empty
    line and come out as empty texts. Rows with the same id count as one document and lose the same places, a null id
    neither counts nor loses lines. Columns named n_lines or n_dropped give way. An empty table gives an empty one.
    """
    whole = docs.drop("n_lines", "n_dropped").withColumn(text, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    identified = whole.filter(F.col(f"`{id_col}`").isNotNull())
    gone = repeated_lines(identified, id_col, text, min_docs, min_length).select(F.col("doc").alias("__doc"), F.col("places").alias("__places"))
    met = whole.join(gone, F.col(f"`{id_col}`") == F.col("__doc"), "left").drop("__doc")
    lines = F.split(F.col(f"`{text}`"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__places")
    left = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return met.select(
        *[(F.when(F.col("__places").isNull(), F.col(f"`{c}`")).otherwise(left) if c == text else F.col(f"`{c}`")).alias(c) for c in whole.columns],
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(F.array_distinct("__places")), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
