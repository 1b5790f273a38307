"""How the test tables play the roles of persons, areas, results, targets and editions.

Every frame has its SQL twin in `CTE`, so that a query and its check start from the same definition.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import key_hash, round_even
from ..operators.indicator import fact_table, weighted_indicator
from ..session import stored

YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]
CUT = 53000.0


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def R(x: str, d: int) -> str:
    """SQL of round_even."""
    return f"(round_even(CAST(({x}) AS DOUBLE)*1e{d},0)/1e{d} + 0.0)"


def H(seed: int | str, *keys: str) -> str:
    """SQL of key_hash."""
    return f"('0x'||substr(md5(concat_ws('|','{seed}',{','.join(keys)})),1,15))::BIGINT"


def spread(df: DataFrame) -> DataFrame:
    """Shares a scan of fewer splits than there are slots among all slots; a larger scan stays as it is."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def persons(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.rint(F.col("l_extendedprice") * 100).cast("bigint")
        ).alias("person_id"),
        F.year("l_shipdate").alias("year"),
        F.col("l_suppkey").alias("area_id"),
        F.col("l_partkey").alias("school_id"),
        F.when(F.col("l_linestatus") == "F", "estadual").when(F.col("l_linestatus") == "O", "municipal").alias("network"),
        (F.col("l_returnflag") != "R").cast("int").alias("present"),
        (F.col("l_discount") > 0).cast("int").alias("filled"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).alias("weight"),
        F.col("l_extendedprice").alias("score"),
        (F.col("l_extendedprice") >= CUT).cast("int").alias("passed"),
    )


def areas(spark: SparkSession, sf: str) -> DataFrame:
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.select(
        F.col("s_suppkey").alias("area_id"), F.col("s_name").alias("area_name"), F.col("n_name").alias("state"),
        F.col("s_nationkey").cast("bigint").alias("state_id"), F.lower("n_name").alias("state_name"),
        F.col("r_name").alias("region"),
    )


def results(spark: SparkSession, sf: str) -> DataFrame:
    """Official result of each area and year, with a level and the participation."""
    p = persons(spark, sf)
    ind = weighted_indicator(p, ["year", "area_id"])
    listed = p.groupBy("year", "area_id").agg(F.count("*").alias("n_listed"))
    return ind.join(listed, ["year", "area_id"]).select(
        "year", "area_id", "indicator_pct", F.floor(F.col("indicator_pct") / 20).cast("int").alias("level"),
        round_even(100.0 * F.col("n_evaluated") / F.col("n_listed"), 2).alias("participation_pct"),
    )


def targets(spark: SparkSession, sf: str) -> DataFrame:
    """Target of a year: the indicator of the year before plus two points."""
    return results(spark, sf).select(
        "area_id", (F.col("year") + 1).alias("year"), round_even(F.col("indicator_pct") + 2, 2).alias("target_pct")
    ).filter(F.col("year") <= YEARS[-1])


def target_editions(spark: SparkSession, sf: str) -> DataFrame:
    """Three editions of the targets. The second is rounded; the third is revised for some areas; some cells are empty."""
    t, a = targets(spark, sf), F.col("area_id")
    gap_all = (a % 11 == 0) & (F.col("year") == 1999)
    whole = round_even("target_pct")
    third = F.when((a % 5 == 0) & (F.col("year") == 1998), None).when(a % 7 == 0, whole + 3).otherwise(whole)
    cells = F.array(
        *[F.struct(F.lit(e).alias("edition"), v.alias("target_pct")) for e, v in ((1, F.col("target_pct")), (2, whole), (3, third))]
    )
    return t.select(a.alias("unit_id"), "year", gap_all.alias("gap"), F.explode(cells).alias("c")).select(
        "unit_id", "year", F.when(~F.col("gap"), F.col("c.target_pct")).alias("target_pct"), "c.edition"
    )


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact_table(persons(spark, sf), areas(spark, sf), targets(spark, sf))


def score_columns() -> list[Column]:
    """Outcome, weight and both scores of a person row."""
    noise = key_hash(["person_id"], 5) % 1000 / 1000.0
    return [
        F.col("passed").alias("y"), F.coalesce("weight", F.lit(1.0)).alias("w"),
        round_even(0.6 * noise + 0.4 * F.col("score") / 110000.0, 2).alias("score_a"), round_even(noise, 3).alias("score_b"),
    ]


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Person rows with a 0/1 outcome, two scores in [0, 1], a weight, a group and a state.

    score_a follows the outcome; score_b hardly does. Scores have two and three decimals, so ties occur.
    Predictions are stored before they are evaluated, as a model run would leave them.
    """
    p = spread(persons(spark, sf).select("person_id", "area_id", "year", "score", "passed", "weight"))
    made = p.select("person_id", "area_id", "year", *score_columns())
    return stored(made, "scored")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Area and year with the actual level, a predicted level, the target and the residual."""
    r, t = results(spark, sf), targets(spark, sf)
    noise = key_hash(["area_id", "year"], 9) % 2001 / 100.0 - 10.0
    made = r.join(t, ["area_id", "year"], "left").select(
        "area_id", "year", F.col("indicator_pct").alias("y"),
        round_even(F.col("indicator_pct") + noise, 2).alias("pred"), "target_pct",
        round_even(0.0 - noise, 2).alias("residual"),
    )
    return stored(made, "predictions")


_A1 = f"""count(*) AS n_evaluated, CAST(sum(passed) AS BIGINT) AS n_passed,
  {R('100.0*sum(weight*passed)/nullif(sum(weight),0)', 2)} AS indicator_pct,
  {R('sum(weight*score)/nullif(sum(weight),0)', 1)} AS mean_score,
  {R('CAST(100.0 AS DOUBLE)*sum(passed)/count(*)', 2)} AS indicator_raw_pct"""

# SQL twins of the frames above.
CTE = {
    "persons": f"""SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round_even(l_extendedprice*100,0) AS BIGINT)) AS person_id,
  CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS area_id, l_partkey AS school_id,
  CASE l_linestatus WHEN 'F' THEN 'estadual' WHEN 'O' THEN 'municipal' END AS network,
  CAST(l_returnflag <> 'R' AS INTEGER) AS present, CAST(l_discount > 0 AS INTEGER) AS filled,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS weight, l_extendedprice AS score,
  CAST(l_extendedprice >= {CUT} AS INTEGER) AS passed FROM lineitem""",
    "evaluated": "SELECT * FROM persons WHERE present = 1 AND filled = 1",
    "areas": """SELECT s_suppkey AS area_id, s_name AS area_name, n_name AS state, CAST(s_nationkey AS BIGINT) AS state_id,
  lower(n_name) AS state_name, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "ind_area": f"SELECT year, area_id, {_A1} FROM evaluated GROUP BY year, area_id",
    "listed": "SELECT year, area_id, count(*) AS n_listed FROM persons GROUP BY year, area_id",
    "results": f"""SELECT year, area_id, indicator_pct, CAST(floor(indicator_pct/20) AS INTEGER) AS level,
  {R('CAST(100.0 AS DOUBLE)*n_evaluated/n_listed', 2)} AS participation_pct FROM ind_area JOIN listed USING (year, area_id)""",
    "targets": f"SELECT area_id, year+1 AS year, {R('indicator_pct+2', 2)} AS target_pct FROM results WHERE year+1 <= {YEARS[-1]}",
    "editions": f"""SELECT unit_id, year, edition, CASE WHEN unit_id % 11 = 0 AND year = 1999 THEN NULL ELSE v END AS target_pct FROM (
  SELECT area_id AS unit_id, year, 1 AS edition, target_pct AS v FROM targets
  UNION ALL SELECT area_id, year, 2, {R('target_pct', 0)} FROM targets
  UNION ALL SELECT area_id, year, 3, CASE WHEN area_id % 5 = 0 AND year = 1998 THEN NULL WHEN area_id % 7 = 0 THEN {R('target_pct', 0)}+3
    ELSE {R('target_pct', 0)} END FROM targets)""",
    "ind_network": f"SELECT year, area_id, network, {_A1} FROM evaluated WHERE network IS NOT NULL GROUP BY year, area_id, network",
    "fact": f"""SELECT year, area_id, area_name, state, state_id, region, network, n_evaluated, n_passed, mean_score, indicator_pct,
  indicator_raw_pct, target_pct,
  CASE WHEN target_pct IS NULL THEN NULL ELSE coalesce(indicator_pct >= target_pct, false) END AS hit,
  {R('indicator_pct - target_pct', 1)} AS gap
  FROM ind_network LEFT JOIN areas USING (area_id) LEFT JOIN targets USING (area_id, year)""",
    "mart": f"""SELECT year, area_id, area_name, state, state_id, state_name, region, n_evaluated, n_passed, mean_score,
  r.indicator_pct, level, participation_pct, target_pct, r.indicator_pct >= target_pct AS hit,
  {R('r.indicator_pct - target_pct', 1)} AS gap
  FROM results r LEFT JOIN areas USING (area_id) LEFT JOIN targets USING (area_id, year)
  LEFT JOIN (SELECT year, area_id, n_evaluated, n_passed, mean_score FROM fact WHERE network = 'municipal') f USING (year, area_id)""",
    "scored": f"""SELECT person_id, area_id, year, passed AS y, coalesce(weight, 1.0) AS w,
  {R("0.6*nz + CAST(0.4 AS DOUBLE)*score/110000.0", 2)} AS score_a, {R('nz', 3)} AS score_b
  FROM (SELECT *, CAST({H(5, 'person_id')} % 1000 AS DOUBLE)/CAST(1000.0 AS DOUBLE) AS nz FROM persons)""",
    "predictions": f"""SELECT area_id, year, indicator_pct AS y, {R('indicator_pct + nz', 2)} AS pred, target_pct, {R('0.0 - nz', 2)} AS residual
  FROM (SELECT *, CAST({H(9, 'area_id', 'year')} % 2001 AS DOUBLE)/CAST(100.0 AS DOUBLE) - 10.0 AS nz FROM results)
  LEFT JOIN targets USING (area_id, year)""",
}


def sql(body: str, **extra: str) -> str:
    """A statement over the named frames: the CTEs it mentions, directly or through others, come first."""
    pool = {**CTE, **extra}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in pool:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(pool[name])

    visit(body)
    order = [n for n in pool if n in needed]
    parts = ",\n".join(f"{n} AS MATERIALIZED (\n{pool[n]})" for n in order)
    return f"WITH {parts}\n{body}" if parts else body
