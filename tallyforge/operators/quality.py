"""Data-quality checks as rows (check, ok, detail), and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .editions import drops_in_sequence

# ---- rules ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Key:
    """The columns are a key: the detail is the number of rows beyond the first of each value."""

    check: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class Row:
    """No row is bad. A null condition is not bad; rows outside `where` are not looked at."""

    check: str
    bad: Column
    where: Column | None = None


@dataclass(frozen=True)
class Known:
    """Every value of the column is in the dimension, nulls aside: the detail is the number of rows with an unknown one."""

    check: str
    column: str
    dimension: DataFrame


@dataclass(frozen=True)
class Mean:
    """The mean of the value stays below the bound: the detail is the mean in thousandths. Without any value it fails."""

    check: str
    value: Column
    bound: float


Rule = Key | Row | Known | Mean


def in_range(check: str, value: str, low: float, high: float) -> Row:
    return Row(check, ~F.col(value).between(low, high))


def never_null(check: str, value: str, where: Column | None = None) -> Row:
    return Row(check, F.col(value).isNull(), where)


def always_true(check: str, rule: Column, where: Column | None = None) -> Row:
    return Row(check, ~F.coalesce(rule, F.lit(False)), where)


def verdicts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check, ok, detail) of all rules on one table, from one scan of it.

    Row rules become flags, references a join with the distinct values of the dimension, and the flags are summed
    together: per key first where there is a key rule, so that its shuffle serves the other rules as well, then over the
    table. There is room for one key rule.
    """
    keys = [r for r in rules if isinstance(r, Key)]
    if len(keys) > 1:
        raise ValueError("one key rule per table")
    rows, sums = df, {}
    for i, r in enumerate(rules):
        if isinstance(r, Known):
            values = r.dimension.select(F.col(r.column).alias(f"__k{i}")).dropna().distinct().withColumn(f"__known{i}", F.lit(True))
            rows = rows.join(values, F.col(r.column) == F.col(f"__k{i}"), "left")
            sums[f"__n{i}"] = (F.col(f"__known{i}").isNull() & F.col(r.column).isNotNull()).cast("bigint")
        elif isinstance(r, Row):
            held = r.bad if r.where is None else r.where & r.bad
            sums[f"__n{i}"] = F.coalesce(held, F.lit(False)).cast("bigint")
        elif isinstance(r, Mean):
            sums[f"__n{i}"] = r.value.cast("double")
            sums[f"__c{i}"] = r.value.isNotNull().cast("bigint")
    marked = rows.select(*(keys[0].keys if keys else ()), *[c.alias(n) for n, c in sums.items()], F.lit(1).cast("bigint").alias("__rows"))
    if keys:
        marked = marked.groupBy(*keys[0].keys).agg(*[F.sum(n).alias(n) for n in sums], (F.count("*") - 1).alias("__rows"))
    total = marked.agg(*[F.sum(n).alias(n) for n in sums], F.coalesce(F.sum("__rows"), F.lit(0)).alias("__rows"))

    def verdict(i: int, r: Rule) -> Column:
        if isinstance(r, Mean):
            mean = F.try_divide(F.col(f"__n{i}"), F.col(f"__c{i}"))
            ok, detail = F.coalesce(mean < r.bound, F.lit(False)), F.rint(mean * 1000).cast("bigint")
        else:
            detail = F.coalesce(F.col("__rows" if isinstance(r, Key) else f"__n{i}"), F.lit(0)).cast("bigint")
            ok = detail == 0
        return F.struct(F.lit(r.check).alias("check"), ok.alias("ok"), detail.alias("detail"))

    return total.select(F.explode(F.array(*[verdict(i, r) for i, r in enumerate(rules)])).alias("v")).select("v.*")


def never_falls(df: DataFrame, check: str, unit: str, year: str, value: str) -> DataFrame:
    counted = drops_in_sequence(df, unit, year, value).agg(F.count("*").alias("n"))
    return counted.select(F.lit(check).alias("check"), (F.col("n") == 0).alias("ok"), F.col("n").alias("detail"))


def report(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def quality_checks(
    persons: DataFrame, areas: DataFrame, fact: DataFrame, mart: DataFrame, targets: DataFrame, cut: float
) -> DataFrame:
    """The twelve checks of the Gold tables: one scan of each table, and one more of the fact for its own figures."""
    seen = (F.col("present") == 1) & (F.col("filled") == 1)
    own = fact.filter("network = 'municipal'").groupBy("year", "area_id").agg(F.avg("indicator_pct").alias("own"))
    compared = mart.join(own, ["year", "area_id"], "left")
    return report([
        verdicts(areas, [Key("area key unique", ("area_id",))]),
        verdicts(fact, [
            Key("fact key unique", ("year", "area_id", "network")),
            Known("fact areas known", "area_id", areas),
            in_range("fact indicator in 0..100", "indicator_pct", 0, 100),
        ]),
        verdicts(compared, [
            Key("mart key unique", ("year", "area_id")),
            in_range("mart indicator in 0..100", "indicator_pct", 0, 100),
            Mean("own figure close to official", F.abs(F.col("own") - F.col("indicator_pct")), 0.1),
        ]),
        verdicts(persons, [
            Key("person key unique", ("year", "person_id")),
            Known("person areas known", "area_id", areas),
            never_null("evaluated have a score", "score", seen),
            always_true("label is the cutoff rule", (F.col("score") >= cut) == (F.col("passed") == 1), seen),
        ]),
        never_falls(targets, "targets never fall", "area_id", "year", "target_pct"),
    ])


def table_profile(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, columns and grain of each table; a count of Parquet reads footers only."""
    rows = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), F.lit(grain).alias("grain")
        )
        for name, (df, grain) in tables.items()
    ]
    return report(rows)
