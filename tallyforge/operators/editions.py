"""Several published editions of the same figure: which one counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_even


def closest_edition(
    df: DataFrame, keys: Sequence[str], year: str = "year", edition: str = "edition",
    value: str | None = None, drop_null_first: bool = False,
) -> DataFrame:
    """One row per key: the edition nearest to the year itself, the smaller one on a tie.

    With `drop_null_first` an edition without a value cannot win; otherwise the own edition wins even when empty.
    Kept as an aggregate (partial on the map side), not a window.
    """
    if drop_null_first:
        df = df.filter(F.col(value).isNotNull())
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.abs(F.col(edition) - F.col(year)), F.col(edition))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("pick"))
    return best.select(*keys, "pick.*").select(*df.columns)


def latest_edition(df: DataFrame, keys: Sequence[str], edition: str = "edition") -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(edition)).alias("pick"))
    return best.select(*keys, "pick.*").select(*df.columns)


def first_by(df: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """First appearance in source order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(rank)).alias("pick"))
    return best.select(*keys, "pick.*").select(*df.columns)


def override_values(
    df: DataFrame, exact: DataFrame, keys: Sequence[str], years: Sequence[int], value: str = "indicator_pct"
) -> DataFrame:
    """For the given years take the exact value when there is one, else keep the published value."""
    swap = exact.select(*keys, F.col(value).alias("__exact"))
    hit = F.when(F.col("year").isin(list(years)), F.col("__exact"))
    return df.join(swap, list(keys), "left").withColumn(value, F.coalesce(hit, value)).drop("__exact")


def consolidate_targets(df: DataFrame, unit: str = "unit_id") -> DataFrame:
    """One trajectory per unit from (unit, year, target_pct, edition), unique by (unit, year, edition).

    The latest edition that covers every year is the base. The earliest older edition that also covers
    every year, and equals the base after rounding to whole numbers in every year, replaces the whole
    trajectory (it has the same figures with more decimals). A unit with no complete edition keeps, per
    year, its latest value.
    """
    known = df.filter(F.col("target_pct").isNotNull()).select(unit, "year", "target_pct", "edition")
    all_years = known.agg(F.count_distinct("year")).scalar()
    complete = (
        known.groupBy(unit, "edition").agg(F.count_distinct("year").alias("n"))
        .filter(F.col("n") == all_years)
        .groupBy(unit).agg(F.max("edition").alias("base"))
    )
    tagged = known.join(complete, unit, "left")

    loose = tagged.filter(F.col("base").isNull()).groupBy(unit, "year").agg(
        F.max_by(F.struct("target_pct", "edition"), "edition").alias("pick")
    ).select(unit, "year", "pick.*")

    per_year = Window.partitionBy(unit, "year")
    based = tagged.filter(F.col("edition") <= F.col("base")).withColumn(
        "base_target", F.max(F.when(F.col("edition") == F.col("base"), F.col("target_pct"))).over(per_year)
    )
    agrees = round_even("target_pct") == round_even("base_target")
    older = (
        based.filter((F.col("edition") < F.col("base")) & F.col("base_target").isNotNull())
        .groupBy(unit, "edition")
        .agg(F.count_distinct("year").alias("n"), F.every(agrees).alias("agrees"))
        .filter((F.col("n") == all_years) & F.col("agrees"))
        .groupBy(unit).agg(F.min("edition").alias("finer"))
    )
    kept = based.join(older, unit, "left").filter(F.col("edition") == F.coalesce("finer", "base"))
    return kept.select(unit, "year", "target_pct", "edition").unionByName(loose)


def targets_long(consolidated: DataFrame) -> DataFrame:
    return consolidated.drop("edition")


def asof_edition(
    requests: DataFrame, editions: DataFrame, reference: str, edition: str = "edition",
    by: Sequence[str] = (), strict: bool = False,
) -> DataFrame:
    """For every reference year the latest edition up to it; without one, the earliest edition.

    That fallback looks ahead; `strict` gives null instead. Union and running maximum: no non-equi join.
    Only distinct years and editions enter the window, so a group is as large as the calendar.
    """
    by = list(by)
    asked = requests.select(*by, F.col(reference).alias("at")).distinct().withColumn("offered", F.lit(None).cast("int"))
    given = editions.select(*by, F.col(edition).cast("int").alias("offered")).distinct()
    both = asked.withColumn("asks", F.lit(1)).unionByName(
        given.withColumn("at", F.col("offered")).withColumn("asks", F.lit(0))
    )
    whole = Window.partitionBy(*by)
    running = whole.orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    found = F.max("offered").over(running)
    if not strict:
        found = F.coalesce(found, F.min("offered").over(whole))
    picked = both.withColumn("ref", found).filter(F.col("asks") == 1)
    return picked.select(*by, F.col("at").alias(reference), F.col("ref").alias(f"ref_{edition}"))


def edition_block(
    requests: DataFrame, table: DataFrame, reference: str, edition: str, keys: Sequence[str], ref_name: str,
) -> DataFrame:
    """Rows of the edition that is valid for each reference year, with the edition used in `ref_name`."""
    chosen = asof_edition(requests, table, reference, edition).withColumnRenamed(f"ref_{edition}", ref_name)
    rows = table.withColumnRenamed(edition, ref_name)
    return chosen.join(rows, ref_name).select(reference, *keys, *[c for c in rows.columns if c not in keys])


def drops_in_sequence(df: DataFrame, unit: str, year: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """Rows whose value fell below the unit's previous year."""
    w = Window.partitionBy(unit).orderBy(year)
    return df.withColumn("step", F.col(value) - F.lag(value).over(w)).filter(F.col("step") < -tolerance)


def edition_tables(
    results: DataFrame, targets: DataFrame, unit: str, keys: Sequence[str],
    exact: DataFrame | None = None, exact_years: Sequence[int] = (), drop_null_first: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Results with one edition per key (exact values put in), and targets with one trajectory per unit."""
    best = closest_edition(results, keys, value="indicator_pct", drop_null_first=drop_null_first)
    if exact is not None:
        best = override_values(best, exact, [unit, "year"], exact_years)
    return best, consolidate_targets(targets, unit)
