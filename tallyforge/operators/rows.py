"""Row and column selection: universes, splits, feature projection, leak guards."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated(df: DataFrame, present: str = "present", filled: str = "filled") -> DataFrame:
    """Persons who came and handed in a filled test; the others count in no denominator."""
    return df.filter((F.col(present) == 1) & (F.col(filled) == 1))


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def temporal_split(df: DataFrame, train: int, test: int, year: str = "year") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(year) == train), df.filter(F.col(year) == test)


def feature_columns(groups: Mapping[str, Sequence[str]]) -> list[str]:
    return [c for names in groups.values() for c in names]


def feature_table(
    df: DataFrame, groups: Mapping[str, Sequence[str]], target: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Model columns and the 0/1 target. A missing column is an error; a null category becomes 'nan'."""
    wanted = feature_columns(groups)
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise KeyError(f"columns not in the table: {absent}")
    texts = set(groups.get("categories", ()))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias(c) if c in texts else F.col(c) for c in wanted]
    label = [F.col(target).cast("int").alias(target)] if target else []
    return df.select(*keep, *cells, *label)


def without_targets(df: DataFrame, targets: Iterable[str]) -> DataFrame:
    return df.drop(*targets)


def reordered(df: DataFrame, first: Sequence[str], last: Sequence[str]) -> DataFrame:
    middle = [c for c in df.columns if c not in first and c not in last]
    return df.select(*first, *middle, *last)


def group_variant(
    groups: Mapping[str, Sequence[str]],
    drop: Iterable[str] = (),
    only: Iterable[str] | None = None,
) -> dict[str, list[str]]:
    """Feature groups without some columns, or limited to some: the variants of an ablation."""
    banned, allowed = set(drop), None if only is None else set(only)
    return {g: [c for c in names if c not in banned and (allowed is None or c in allowed)] for g, names in groups.items()}


def cutoff_label(score: str, cut: float = 743.0) -> Column:
    return (F.col(score) >= F.lit(cut)).cast("int")


def near_cutoff(score: str, cut: float, band: float) -> Column:
    """Share of scored rows within `band` of the cut, both ends included."""
    return F.avg(F.col(score).between(cut - band, cut + band).cast("int"))


def projection_universe(df: DataFrame, year: int, target: str, year_column: str = "target_year") -> DataFrame:
    return df.filter((F.col(year_column) == year) & F.col(target).isNotNull())
