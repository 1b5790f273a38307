"""Group means on rows and report-sized rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_group_mean(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Group mean on each row. Aggregate and join back: a window would hold a whole group in one task."""
    means = df.dropna(subset=list(by)).groupBy(*by).agg(F.avg(value).alias(name))
    return df.join(means, list(by), "left")


def top_k(df: DataFrame, value: str, tie_break: str, k: int) -> DataFrame:
    """The k largest, ties by a unique column: each task keeps k rows."""
    return df.orderBy(F.col(value).desc_nulls_last(), tie_break).limit(k)


def strongest(df: DataFrame, value: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The k rows of largest absolute value, with their position; the window sees k rows only."""
    size = F.abs(F.col(value)).desc_nulls_last()
    picked = df.orderBy(size, *tie_break).limit(k)
    return picked.withColumn("position", F.row_number().over(Window.orderBy(size, *tie_break)).cast("bigint"))
