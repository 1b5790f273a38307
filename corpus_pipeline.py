"""From raw documents to packed sequences: quality, repeated lines, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import jaccard, lines, packing, pii, quality
from tallyforge.llm.queries import GOOD, JSON
from tallyforge.session import stored


def _measured(docs: DataFrame, before: DataFrame) -> DataFrame:
    """The columns as they came, n_chars after the text where it is known."""
    if "n_chars" in before.columns:
        docs = docs.withColumn("n_chars", F.char_length("text").cast(before.schema["n_chars"].dataType))
    return docs.select(*[F.col(f"`{c}`") for c in before.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects.

    Null and empty texts are scored as one empty line, very long ones whole. Rows are judged one by one, repeated ids and
    rows without an id too. All columns stay as they were. An empty table gives an empty one.
    """
    field = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, field, GOOD)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many documents share; a document stays, even if it keeps no line.

    Null texts become empty, very long ones are read whole. Rows of one id count as one document; rows without an id
    neither count nor lose lines. Other columns stay as they were, whatever their names, n_chars is counted anew. An
    empty table gives an empty one.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = docs.select("doc_id", "text", F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in rest]).alias("__rest"))
    bare = lines.dedup_lines(kept).select("doc_id", "text", *[F.col(f"__rest.`{c}`") for c in rest])
    return _measured(bare, docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest document of every group of near copies.

    Documents without an id are not compared and stay, as do those without words. Rows that repeat an id are one
    document, compared by the smallest of their texts; they stay or go together. Very long texts are compared whole.
    All columns stay as they were. An empty table gives an empty one.
    """
    others = jaccard.similar_docs(docs).filter(~F.col("kept")).select("doc_id")
    return docs.join(others, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data.

    Null texts stay null, empty ones empty, very long ones are searched whole. Rows are masked one by one, whatever their
    id. Other columns stay as they were, n_chars is counted anew. An empty table gives an empty one.
    """
    return _measured(pii.redact(docs, pii.train(docs)), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens, one row per piece.

    Null and empty texts are their end token alone, very long ones are cut into pieces. Repeated rows and rows without
    an id are packed one by one. Other columns go. An empty table gives no rows.
    """
    return packing.pack(docs, JSON)


STAGES = [
    ("quality", good_documents),
    ("lines", without_repeated_lines),
    ("near_copies", one_of_each_group),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: The classifier, the forest and the packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
