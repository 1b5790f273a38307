"""Digests of files against the publisher's list and the stored manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MD5_LINE = r"^\s*([0-9a-fA-F]{32})\s+\*?(.+?)\s*$"


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, bytes, md5 and sha256 of each file; files are spread over the tasks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.md5("content").alias("md5"),
        F.sha2("content", 256).alias("sha256"),
    )


def published_md5(spark: SparkSession, path: str) -> DataFrame:
    """Lines `digest  *name` of the publisher's list; other lines are skipped."""
    lines = spark.read.text(path)
    found = lines.select(
        F.lower(F.regexp_extract("value", _MD5_LINE, 1)).alias("expected_md5"),
        F.element_at(F.split(F.regexp_extract("value", _MD5_LINE, 2), r"[/\\]"), -1).alias("name"),
    )
    return found.filter(F.col("expected_md5") != "")


def integrity_report(digests: DataFrame, published: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status per file: 'diverges' from the publisher, 'drifted' from the manifest, 'unlisted', 'absent' or 'ok'."""
    known = manifest.select("name", F.col("sha256").alias("stored_sha256"))
    joined = digests.join(published, "name", "left").join(known, "name", "full")
    status = (
        F.when(F.col("md5").isNull(), "absent")
        .when(F.col("md5") != F.col("expected_md5"), "diverges")
        .when(F.col("stored_sha256").isNull(), "unlisted")
        .when(F.col("sha256") != F.col("stored_sha256"), "drifted")
        .otherwise("ok")
    )
    return joined.select("name", "bytes", "md5", "sha256", status.alias("status"))


def require_intact(report: DataFrame) -> None:
    bad = report.filter(F.col("status") == "diverges").select("name").take(1)
    if bad:
        raise RuntimeError(f"digest differs from the published list: {bad[0]['name']}")
