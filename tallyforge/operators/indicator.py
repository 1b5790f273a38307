"""Weighted indicator and the comparison with targets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import met_target, ratio, round_even
from .rows import evaluated, with_keys


def weighted_indicator(
    persons: DataFrame,
    keys: Sequence[str],
    weight: str = "weight",
    score: str = "score",
    passed: str = "passed",
) -> DataFrame:
    """Counts, weighted share passed, weighted mean score and raw share per key, over evaluated persons.

    A null weight leaves both sums but still counts as a person; a null score leaves only the
    numerator of the mean score.
    """
    w, y, s = F.col(weight).cast("double"), F.col(passed).cast("double"), F.col(score).cast("double")
    sums = (
        with_keys(evaluated(persons), keys)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("n_evaluated"),
            F.sum(F.col(passed).cast("bigint")).alias("n_passed"),
            F.sum(w).alias("sum_w"),
            F.sum(w * y).alias("sum_wy"),
            F.sum(w * s).alias("sum_ws"),
        )
    )
    return sums.select(
        *keys,
        "n_evaluated",
        "n_passed",
        round_even(ratio(F.lit(100.0) * F.col("sum_wy"), "sum_w"), 2).alias("indicator_pct"),
        round_even(ratio("sum_ws", "sum_w"), 1).alias("mean_score"),
        round_even(ratio(F.lit(100.0) * F.col("n_passed"), "n_evaluated"), 2).alias("indicator_raw_pct"),
    )


def with_target(
    df: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    value: str = "indicator_pct",
    target: str = "target_pct",
    missing_value_fails: bool = False,
) -> DataFrame:
    """Left join of the target of the same unit and year, with hit and gap (one decimal)."""
    joined = df.join(targets.select(*keys, target), list(keys), "left")
    return joined.withColumn("hit", met_target(value, target, missing_value_fails)).withColumn(
        "gap", round_even(F.col(value) - F.col(target), 1)
    )


def lag_change(df: DataFrame, unit: str, year: str, value: str) -> DataFrame:
    """Value of the unit's previous row (not necessarily the previous year) and the change, one decimal."""
    w = Window.partitionBy(unit).orderBy(year)
    out = df.withColumn("previous", F.lag(value, 1).over(w))
    return out.withColumn("change", round_even(F.col(value) - F.col("previous"), 1))


def fact_table(persons: DataFrame, areas: DataFrame, targets: DataFrame) -> DataFrame:
    """Grain year x area x network, with area attributes and the area's target."""
    fact = weighted_indicator(persons, ["year", "area_id", "network"])
    fact = fact.join(areas.select("area_id", "area_name", "state", "state_id", "region"), "area_id", "left")
    fact = with_target(fact, targets, ["area_id", "year"], missing_value_fails=True)
    return fact.select(
        "year", "area_id", "area_name", "state", "state_id", "region", "network", "n_evaluated",
        "n_passed", "mean_score", "indicator_pct", "indicator_raw_pct", "target_pct", "hit", "gap",
    )


def area_mart(results: DataFrame, targets: DataFrame, areas: DataFrame, fact: DataFrame, network: str) -> DataFrame:
    """Official yearly series of each area against its target, with the volumes of one network."""
    volumes = fact.filter(F.col("network") == network).select(
        "year", "area_id", "n_evaluated", "n_passed", "mean_score"
    )
    out = results.select("year", "area_id", "indicator_pct", "level", "participation_pct")
    out = out.join(areas, "area_id", "left").join(volumes, ["year", "area_id"], "left")
    out = with_target(out, targets, ["area_id", "year"])
    return out.select(
        "year", "area_id", "area_name", "state", "state_id", "state_name", "region", "n_evaluated", "n_passed",
        "mean_score", "indicator_pct", "level", "participation_pct", "target_pct", "hit", "gap",
    )


def state_mart(results: DataFrame, targets: DataFrame) -> DataFrame:
    """State series of every source against the state target; a missing value with a target counts as a miss."""
    return with_target(results, targets, ["state", "year"], missing_value_fails=True)


def evolution(mart: DataFrame) -> DataFrame:
    columns = mart.select("year", "area_id", "area_name", "state", "region", "indicator_pct")
    return lag_change(columns, "area_id", "year", "indicator_pct")


def school_context(persons: DataFrame) -> DataFrame:
    """Evaluated persons (with an area) and attendance over all listed persons, per year and school.

    A school with no evaluated person has no row.
    """
    came = F.col("present") == 1
    counted = came & (F.col("filled") == 1) & F.col("area_id").isNotNull()
    schools = (
        with_keys(persons, ["school_id"])
        .groupBy("year", "school_id")
        .agg(F.count_if(counted).alias("school_evaluated"), (100 * F.avg("present")).alias("school_attendance_pct"))
    )
    return schools.filter(F.col("school_evaluated") > 0)


def person_table(persons: DataFrame) -> DataFrame:
    """Evaluated persons with the size and attendance of their school."""
    base = with_keys(evaluated(persons), ["area_id", "school_id"])
    out = base.join(school_context(persons), ["year", "school_id"], "left")
    return out.select(
        "year", "person_id", "area_id", "school_id", "state", "network", "weight", "score",
        "school_evaluated", "school_attendance_pct", "passed",
    )


# Columns of the area table that tell the outcome of its target year.
OUTCOMES = ["indicator_t", "hit_t", "gap_t"]


def person_full(people: DataFrame, area_features: DataFrame) -> DataFrame:
    """Person table with the area context of the same year and none of the outcome columns."""
    context = area_features.drop(*OUTCOMES, "area_name", "state_name", "state", "region").withColumnRenamed("target_year", "year")
    return people.join(context, ["year", "area_id"], "left")


def area_dimension(sources: DataFrame, state_names: DataFrame) -> DataFrame:
    """One row per area: the first source that names it wins; codes split into state and region.

    `sources` has area_id, area_name, state and source_rank, unique by (area_id, source_rank).
    """
    from ..functions.scalars import region_name, state_code

    first = sources.groupBy("area_id").agg(
        F.min_by(F.struct("area_name", "state"), "source_rank").alias("pick")
    )
    coded = first.select("area_id", "pick.*", state_code("area_id").alias("state_id"))
    return coded.withColumn("region", region_name("state_id")).join(state_names, "state", "left").select(
        "area_id", "area_name", "state", "state_id", "state_name", "region"
    )
