"""Joins. No side is forced to broadcast: Spark broadcasts by measured size and splits skewed partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lookup


def enriched(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join with attributes or figures of the same key; `other` is unique by key."""
    return df.join(other, list(keys), "left")


def orphans(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the dimension does not know; null keys are no orphans."""
    return df.select(key).dropna().distinct().join(dimension.select(key), key, "left_anti")


def distinct_keys(frames: Sequence[DataFrame], name: str) -> DataFrame:
    """Set union of one-column frames, made distinct before and after the union so that few rows move."""
    keys = [f.toDF(name).distinct() for f in frames]
    return reduce(DataFrame.union, keys).distinct()


def aligned(key: str, anchors: Mapping[str, DataFrame], extras: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Universe = union of the anchors' keys; the extras enrich and add no key. Each frame is (key, its name)."""
    universe = distinct_keys([f.select(key) for f in anchors.values()], key)
    for frame in [*anchors.values(), *(extras or {}).values()]:
        universe = universe.join(frame, key, "left")
    return universe


def labelled(df: DataFrame, name: str, labels: Mapping[str, str], missing_prefix: str = "ausente_") -> DataFrame:
    """Adds `label`: the exact label, else `base=value`, else `base_value`, else the name itself.

    Names of missing-value indicators carry a prefix and the label of their variable.
    """
    n = F.col(name)
    is_missing = n.startswith(missing_prefix)
    core = F.when(is_missing, F.substring(n, len(missing_prefix) + 1, 10_000)).otherwise(n)

    out = F.coalesce(lookup(core, labels))
    for sep in ("=", "_"):
        for base, text in labels.items():
            head = base + sep
            value = F.substring(core, len(head) + 1, 10_000)
            out = F.coalesce(out, F.when(core.startswith(head) & (value != ""), F.concat(F.lit(text + ": "), value)))
    out = F.coalesce(out, core)
    return df.withColumn("label", F.when(is_missing, F.concat(F.lit("Sem informação: "), out)).otherwise(out))
