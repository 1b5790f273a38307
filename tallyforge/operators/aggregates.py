"""Grouped summaries. Medians come from ordered ranges, so that a group of any size stays distributed."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio, round_even
from .ordered import exact_quantiles

# Task functions travel with their helpers, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def coverage(df: DataFrame, by: Sequence[str], value: str, constant_total: float) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(value).alias("n"), round_even(F.avg(value), 4).alias("mean"),
        round_even(F.lit(100.0) * F.count(value) / F.lit(constant_total), 1).alias("share_of_constant"),
    )


def listed_summary(persons: DataFrame) -> DataFrame:
    """Listed, present and distinct counts per year beside the mean score of the evaluated: one pass.

    The distinct counts are of two columns, which Spark expands into partial aggregates per column.
    """
    seen = (F.col("present") == 1) & (F.col("filled") == 1)
    return persons.groupBy("year").agg(
        F.count("*").alias("n_listed"),
        F.sum("present").alias("n_present"),
        F.count_distinct("school_id").alias("n_schools"),
        F.count_distinct("area_id").alias("n_areas"),
        round_even(100 * F.avg("present"), 2).alias("present_pct"),
        round_even(F.avg(F.when(seen, F.col("score"))), 2).alias("mean_score_evaluated"),
    )


def _stacked(row: DataFrame, columns: Sequence[str], value: str, keep: Sequence[str] = ()) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias(value)) for c in columns])
    return row.select(*keep, F.explode(cells).alias("e")).select(*keep, "e.*")


def _null_shares(columns: Sequence[str]) -> list[Column]:
    return [F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]


def null_profile(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """Null share of each column that has nulls, all columns in one pass; `top` keeps the largest for a report."""
    long = _stacked(df.agg(*_null_shares(columns)), columns, "null_share")
    out = long.filter("null_share > 0").select("variable", round_even("null_share", 6).alias("null_share"))
    return out.orderBy(F.desc("null_share"), "variable").limit(top) if top else out


def null_profile_pivot(df: DataFrame, columns: Sequence[str], by: str, values: Sequence[int]) -> DataFrame:
    shares = df.filter(F.col(by).isin(list(values))).groupBy(by).agg(*_null_shares(columns))
    long = _stacked(shares, columns, "share", [by])
    return long.groupBy("variable").pivot(by, list(values)).agg(round_even(100 * F.first("share"), 2))


def distinct_list(df: DataFrame, by: Sequence[Column], value: str, name: str) -> DataFrame:
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set(value)), ", ").alias(name))


def crosstab(
    df: DataFrame, row: str, column: str, values: Sequence[str], normalise: str | None = None, totals: bool = True, digits: int = 6
) -> DataFrame:
    """Counts of row x column for the known column values, with row totals, and shares by row when asked."""
    out = df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0, list(values))
    if not totals:
        return out
    out = out.withColumn("total", sum((F.col(f"`{v}`") for v in values), F.lit(0)))
    if normalise == "row":
        out = out.select("*", *[round_even(ratio(F.col(f"`{v}`"), "total"), digits).alias(f"{v}_share") for v in values])
    return out


def column_shares(df: DataFrame, row: str, column: str, digits: int = 1) -> DataFrame:
    """Long contingency table with the share of each row within its column, in percent."""
    cells = df.groupBy(row, column).agg(F.count("*").alias("n"))
    totals = df.groupBy(column).agg(F.count("*").alias("total"))
    share = round_even(ratio(F.lit(100.0) * F.col("n"), "total"), digits)
    return cells.join(totals, column).select(row, column, "n", share.alias("share_pct"))


def rate_by_group(df: DataFrame, by: Sequence[str], flag: str, minimum: int = 0, digits: int = 6) -> DataFrame:
    out = df.groupBy(*by).agg(round_even(F.avg(flag), digits).alias("rate"), F.count("*").alias("n"))
    return out.filter(F.col("n") >= minimum) if minimum else out


def weighted_means(df: DataFrame, by: Sequence[str], prediction: str, outcome: str, weight: str) -> DataFrame:
    """Weighted means of prediction and outcome per group, and the bias in points."""
    w = F.col(weight)
    p, y = ratio(F.sum(w * F.col(prediction)), F.sum(w)), ratio(F.sum(w * F.col(outcome)), F.sum(w))
    return df.groupBy(*by).agg(
        round_even(p, 6).alias("predicted"), round_even(y, 6).alias("observed"), round_even(100 * (p - y), 4).alias("bias_points")
    )


def risk_by_state(df: DataFrame, state: str, risk: str, gap: str) -> DataFrame:
    high = F.count_if(F.col(risk) >= 0.5)
    sums = df.groupBy(state).agg(
        F.count("*").alias("n_areas"), high.alias("n_at_risk"), round_even(F.avg(risk), 4).alias("mean_risk"),
        round_even(ratio(100.0 * high, F.count("*")), 1).alias("at_risk_pct"),
    )
    mid = exact_quantiles(df, gap, {"m": 0.5}, [state]).select(state, round_even("m", 2).alias("median_gap"))
    return sums.join(mid, state, "left")


def described(df: DataFrame, value: str, by: Sequence[str], extremes: bool = True, digits: int = 4) -> DataFrame:
    aggs = [round_even(F.avg(value), digits).alias("mean"), F.count(value).alias("n")]
    if extremes:
        aggs += [round_even(F.min(value), digits).alias("min"), round_even(F.max(value), digits).alias("max")]
    mid = exact_quantiles(df, value, {"m": 0.5}, by).select(*by, round_even("m", digits).alias("median"))
    return df.groupBy(*by).agg(*aggs).join(mid, list(by), "left")


def fold_summary(folds: DataFrame, part: str, metrics: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean and sample deviation of each metric per part (train or validation)."""
    aggs = []
    for m in metrics:
        aggs += [round_even(F.avg(m), digits).alias(f"{m}_mean"), round_even(F.stddev_samp(m), digits).alias(f"{m}_std")]
    return folds.groupBy(part).agg(*aggs)


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins over the group's own range; the last bin is closed, empty bins are absent."""
    by, v = list(by), F.col(value)
    if by:
        spans = df.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
        joined = df.dropna(subset=[value]).join(spans, by)
    else:
        joined = df.dropna(subset=[value]).withColumn("lo", df.agg(F.min(value)).scalar()).withColumn("hi", df.agg(F.max(value)).scalar())
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    spot = F.coalesce(F.floor(F.try_divide(v - F.col("lo"), width)), F.lit(0))
    return joined.groupBy(*by, F.least(F.lit(bins - 1), spot).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def summed(rows: DataFrame, by: Sequence[str], array: str) -> DataFrame:
    """Sums arrays of one length entry by entry, per group: partial sums in each task, then one per group."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in by) + f", `{array}` array<double>"

    def add(key, table):
        total = np.asarray(table[array].combine_chunks().flatten()).reshape(table.num_rows, -1).sum(axis=0)
        return pa.table({**{c: table[c].slice(0, 1) for c in by}, array: pa.array([total.tolist()], pa.list_(pa.float64()))})

    return rows.groupBy(*by).applyInArrow(add, schema)
