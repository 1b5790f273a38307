"""Token counts: lengths only, from Arrow batches balanced by bytes, long texts split at safe places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts
from .piececoder import SLICE, json_coder


def count_tokens(docs: DataFrame, tokenizer: str, keep: Sequence[str] = ("doc_id",), text: str = "text", limit: int = 512) -> DataFrame:
    """`keep` columns with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    Null and empty texts have 0 bytes and 0 tokens. Rows are counted one by one: repeated rows and ids stay as they
    are, other columns are dropped, and a kept column named like a result gives way. An empty table gives an empty
    result. No special tokens are added; a special string inside a text is one token, as by the library's default.
    Texts are never cut off; only token numbers leave Python.
    """
    width = "__bytes"
    sized = docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("n_bytes", "n_tokens", "over_limit")], F.col(f"`{text}`").cast("string").alias("__body"))
    sized = sized.withColumn(width, F.coalesce(F.octet_length("__body"), F.lit(0)).cast("bigint"))
    names = [c for c in sized.columns if c not in ("__body", width)]

    def work(texts) -> list:
        return [[len(ids) >> 2 for ids in json_coder(tokenizer).encode(texts)]]

    counted = map_texts(sized, work, "n_tokens bigint", [*names, width], "__body", as_arrow=True, most=SLICE)
    return counted.select(*[F.col(f"`{c}`") for c in names], F.col(width).alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
