"""Buckets by quantile, by fixed edges and by equal width."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles

# Edges, in points, of the bands of required jump.
JUMP_EDGES = [-80.0, -10.0, -5.0, 0.0, 2.5, 5.0, 10.0, 15.0, 80.0]


def quantile_edges(df: DataFrame, value: str, buckets: int) -> list[float]:
    """Inner edges by linear interpolation, duplicates dropped: `buckets` - 1 numbers to the driver."""
    probs = {f"q{i}": i / buckets for i in range(1, buckets)}
    row = exact_quantiles(df, value, probs).first()
    return sorted({row[q] for q in probs if row is not None and row[q] is not None})


def quantile_bucket(df: DataFrame, value: str, buckets: int, name: str = "bucket") -> DataFrame:
    """0-based bucket, intervals closed on the right, the lowest value included; null stays null."""
    edges = quantile_edges(df, value, buckets)
    v = F.col(value)
    return df.withColumn(name, F.when(v.isNotNull(), sum(((v > e).cast("int") for e in edges), F.lit(0))))


def fixed_bucket(value: str, edges: Sequence[float]) -> Column:
    """0-based bucket of (edge, next edge]; outside is null."""
    v = F.col(value)
    out = F.when(v <= edges[0], None)
    for i, upper in enumerate(edges[1:]):
        out = out.when(v <= upper, i)
    return out


def equal_width_bucket(value: str, buckets: int) -> Column:
    v = F.col(value)
    return F.when(v.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(buckets - 1), F.floor(v * F.lit(float(buckets)))))).cast("int")
