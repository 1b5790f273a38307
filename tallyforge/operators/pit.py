"""Point-in-time features: for target year t nothing that became known in t or later, except the target itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import per_capita
from .editions import edition_block


def history_block(mart: DataFrame, targets: DataFrame, years: Sequence[int]) -> DataFrame:
    """All target years in one plan. Rows: areas with a result in t-1, a target for t or a result in t.

    t-2 results and t-1 targets only enrich. Every source row is sent to the target years it serves and
    one aggregate by (area, target year) lines them up: one shuffle in place of five joins.
    """
    wanted = F.col("target_year").isin(list(years))

    def shifted(df: DataFrame, shift: int, anchors: bool, **columns: str) -> DataFrame:
        return df.select(
            "area_id",
            (F.col("year") + shift).cast("int").alias("target_year"),
            F.lit(anchors).alias("anchor"),
            *[F.col(source).alias(name) for name, source in columns.items()],
        ).filter(wanted)

    parts = [
        shifted(mart, 1, True, indicator_t1="indicator_pct", level_t1="level", participation_t1="participation_pct"),
        shifted(mart, 2, False, indicator_t2="indicator_pct"),
        shifted(mart, 0, True, indicator_t="indicator_pct", hit_t="hit", gap_t="gap"),
        shifted(targets, 0, True, target_t="target_pct"),
        shifted(targets, 1, False, target_t1="target_pct"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    values = [c for c in stacked.columns if c not in ("area_id", "target_year", "anchor")]
    rows = stacked.groupBy("area_id", "target_year").agg(
        F.max("anchor").alias("anchor"), *[F.max(c).alias(c) for c in values]
    )
    return rows.filter("anchor").select(
        "target_year", "area_id", "indicator_t1", "level_t1", "participation_t1", "indicator_t2",
        (F.col("indicator_t1") - F.col("indicator_t2")).alias("change_t1"),
        "target_t1",
        (F.col("indicator_t1") - F.col("target_t1")).alias("gap_t1"),
        "target_t",
        (F.col("target_t") - F.col("indicator_t1")).alias("required_jump"),
        "indicator_t", "hit_t", "gap_t",
    )


def panel_block(
    panel: DataFrame, years: Sequence[int], values: Sequence[str], main: str, window: int = 5, step: float = 2.0
) -> DataFrame:
    """Last and second-to-last edition before each target year (null values included), their difference, and
    the slope per edition over the last `window` editions (null values dropped, at least three points).
    """
    target = F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("target_year")
    seen = panel.select("area_id", "year", *values, target).filter(F.col("year") < F.col("target_year"))
    newest = Window.partitionBy("area_id", "target_year").orderBy(F.col("year").desc())
    ranked = seen.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") <= max(window, 2))
    recent = F.col("rn") <= window
    slope = F.regr_slope(F.when(recent, F.col(main)), F.when(recent, F.col("year") / F.lit(step)))
    points = F.count(F.when(recent, F.col(main)))
    out = ranked.groupBy("area_id", "target_year").agg(
        *[F.max(F.when(F.col("rn") == 1, F.col(v))).alias(f"{v}_last") for v in values],
        F.max(F.when(F.col("rn") == 1, F.col("year"))).alias("ref_panel"),
        F.max(F.when(F.col("rn") == 2, F.col(main))).alias(f"{main}_previous"),
        F.when(points >= 3, slope).alias(f"{main}_trend"),
    )
    return out.withColumn(f"{main}_change", F.col(f"{main}_last") - F.col(f"{main}_previous"))


def outer_blocks(blocks: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of indicator blocks on their shared keys."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), blocks)


def static_block(census: DataFrame, accounts: DataFrame, social: DataFrame) -> DataFrame:
    """Census left join accounts with the per-head amount, full join the social sheet."""
    base = census.join(accounts, "area_id", "left").withColumn(
        "gdp_per_head", per_capita("gdp_thousands", "population")
    )
    return base.join(social, "area_id", "full")


def area_table(
    history: DataFrame, yearly: Sequence[DataFrame], static: DataFrame, areas: DataFrame
) -> DataFrame:
    """Area x target year with every block; areas outside the dimension are dropped."""
    out = history
    for block in yearly:
        out = out.join(block, ["target_year", "area_id"], "left")
    out = out.join(static, "area_id", "left").join(areas, "area_id", "left")
    out = out.filter(F.col("state").isNotNull()).withColumn("log_population", F.log1p("population"))
    first = ["target_year", "area_id", "area_name", "state", "state_name", "region"]
    last = ["indicator_t", "hit_t", "gap_t"]
    return out.select(*first, *[c for c in out.columns if c not in first + last], *last)


def editioned_block(
    years: DataFrame, table: DataFrame, lag: int, edition: str, ref_name: str
) -> DataFrame:
    """Block of the edition valid `lag` years before the target year."""
    asked = years.select("target_year", (F.col("target_year") - lag).alias("at"))
    block = edition_block(asked.select("at").distinct(), table, "at", edition, ["area_id"], ref_name)
    return asked.join(block, "at").drop("at")
