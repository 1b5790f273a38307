"""Row selection, joins, aggregates, windows, buckets and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import buckets as B
from ..operators import indicator as I
from ..operators import joins as J
from ..operators import rows as P
from ..operators import windows as W
from ..operators.ordered import average_ranks, medians, rank_positions
from .base import CUT, R, areas, fact, persons, predictions, results, scored, sql, table, targets
from .registry import query

# ---- rows and columns ----------------------------------------------------------------------------


@query("evaluated_universe", sql("SELECT year, area_id, count(*) AS n, CAST(sum(passed) AS BIGINT) AS n_passed FROM evaluated GROUP BY ALL"))
def evaluated_universe(spark, sf):
    return P.evaluated(persons(spark, sf)).groupBy("year", "area_id").agg(
        F.count("*").alias("n"), F.sum("passed").alias("n_passed")
    )


@query("drop_null_keys", sql("""SELECT k, count(*) AS n FROM (SELECT CASE WHEN weight > 25 THEN school_id END AS k FROM persons)
WHERE k IS NOT NULL GROUP BY k"""))
def drop_null_keys(spark, sf):
    keyed = persons(spark, sf).select(F.when(F.col("weight") > 25, F.col("school_id")).alias("k"))
    return P.with_keys(keyed, ["k"]).groupBy("k").agg(F.count("*").alias("n"))


@query("temporal_split", sql("""SELECT 'train' AS part, area_id, count(*) AS n FROM persons WHERE year = 1999 GROUP BY area_id
UNION ALL SELECT 'test', area_id, count(*) FROM persons WHERE year = 2000 GROUP BY area_id"""))
def temporal_split(spark, sf):
    train, test = P.temporal_split(persons(spark, sf), 1999, 2000)
    count = F.count("*").alias("n")
    return train.groupBy(F.lit("train").alias("part"), "area_id").agg(count).unionByName(
        test.groupBy(F.lit("test").alias("part"), "area_id").agg(count)
    )


@query("feature_projection", sql("""SELECT person_id, weight, score, coalesce(CASE WHEN present = 1 THEN network END, 'nan') AS network, passed FROM persons"""))
def feature_projection(spark, sf):
    df = persons(spark, sf).withColumn("network", F.when(F.col("present") == 1, F.col("network")))
    groups = {"history": ["weight"], "numbers": ["score"], "categories": ["network"]}
    return P.feature_table(df, groups, target="passed", keep=["person_id"])


@query("leak_guard_projection", sql("SELECT area_id, year, indicator_pct, level FROM mart"))
def leak_guard_projection(spark, sf):
    return P.without_targets(_mart(spark, sf), ["hit", "gap", "target_pct", "area_name", "state", "state_id", "state_name",
                                               "region", "n_evaluated", "n_passed", "mean_score", "participation_pct"])


@query("column_reorder", sql("SELECT area_id, year, indicator_pct, level, participation_pct FROM results"))
def column_reorder(spark, sf):
    return P.reordered(results(spark, sf), ["area_id", "year"], ["indicator_pct"])


@query("feature_group_variant", sql("SELECT person_id, score, network FROM persons"))
def feature_group_variant(spark, sf):
    groups = {"history": ["weight"], "numbers": ["score", "filled"], "categories": ["network"]}
    variant = P.group_variant(groups, drop=["weight", "filled"])
    return P.feature_table(persons(spark, sf), variant, keep=["person_id"])


@query("cutoff_label", sql(f"SELECT year, count(*) AS n, CAST(sum(CAST(score >= {CUT} AS INTEGER)) AS BIGINT) AS n_cut, CAST(sum(passed) AS BIGINT) AS n_published FROM persons GROUP BY year"))
def cutoff_label(spark, sf):
    return persons(spark, sf).groupBy("year").agg(
        F.count("*").alias("n"), F.sum(P.cutoff_label("score", CUT)).alias("n_cut"), F.sum("passed").alias("n_published")
    )


@query("near_cutoff_share", sql(f"SELECT network, {R(f'avg(CAST(score BETWEEN {CUT}-5000 AND {CUT}+5000 AS INTEGER))', 6)} AS share FROM evaluated GROUP BY network"))
def near_cutoff_share(spark, sf):
    return P.evaluated(persons(spark, sf)).groupBy("network").agg(S.round_even(P.near_cutoff("score", CUT, 5000.0), 6).alias("share"))


@query("projection_universe", sql("SELECT area_id, year, pred, target_pct FROM predictions WHERE year = 2001 AND target_pct IS NOT NULL"))
def projection_universe(spark, sf):
    return P.projection_universe(predictions(spark, sf), 2001, "target_pct", "year").select("area_id", "year", "pred", "target_pct")


# ---- joins ---------------------------------------------------------------------------------------


def _mart(spark, sf):
    return I.area_mart(results(spark, sf), targets(spark, sf), areas(spark, sf), fact(spark, sf), "municipal")


@query("join_dim_left", sql("SELECT area_id, year, indicator_pct, area_name, state, region FROM results LEFT JOIN areas USING (area_id)"))
def join_dim_left(spark, sf):
    dim = areas(spark, sf).select("area_id", "area_name", "state", "region")
    return J.enriched(results(spark, sf).select("area_id", "year", "indicator_pct"), dim, ["area_id"])


@query("join_target_left", sql("SELECT area_id, year, indicator_pct, target_pct FROM results LEFT JOIN targets USING (area_id, year)"))
def join_target_left(spark, sf):
    return J.enriched(results(spark, sf).select("area_id", "year", "indicator_pct"), targets(spark, sf), ["area_id", "year"])


@query("join_outer_blocks", """SELECT c_custkey AS id, n_orders, n_errors, balance FROM
 (SELECT o_custkey AS c_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
 FULL JOIN (SELECT user_id AS c_custkey, count(*) AS n_errors FROM events WHERE event_type = 'error' GROUP BY 1) USING (c_custkey)
 FULL JOIN (SELECT c_custkey, c_acctbal AS balance FROM customer WHERE c_mktsegment = 'MACHINERY') USING (c_custkey)""")
def join_outer_blocks(spark, sf):
    from ..operators.pit import outer_blocks

    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n_orders"))
    errors = table(spark, sf, "events").filter("event_type = 'error'").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n_errors"))
    balance = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    return outer_blocks([done, errors, balance], ["id"])


@query("join_inner_base", sql("SELECT area_id, year, r.indicator_pct, target_pct FROM results r JOIN targets USING (area_id, year)"))
def join_inner_base(spark, sf):
    return results(spark, sf).join(targets(spark, sf), ["area_id", "year"]).select("area_id", "year", "indicator_pct", "target_pct")


@query("anti_join_orphans", """SELECT DISTINCT user_id AS unit FROM events WHERE user_id IS NOT NULL AND user_id NOT IN
 (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def anti_join_orphans(spark, sf):
    known = table(spark, sf, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("unit"))
    return J.orphans(table(spark, sf, "events").select(F.col("user_id").alias("unit")), known, "unit")


@query("lookup_override", sql(f"""SELECT r.area_id, r.year, CASE WHEN r.year IN (1999, 2000) THEN coalesce(x.v, {R('r.indicator_pct', 0)}) ELSE {R('r.indicator_pct', 0)} END AS indicator_pct
 FROM results r LEFT JOIN (SELECT area_id, year, indicator_pct AS v FROM ind_network WHERE network = 'municipal' AND n_evaluated > 3) x USING (area_id, year)"""))
def lookup_override(spark, sf):
    from ..operators.editions import override_values

    published = results(spark, sf).select("area_id", "year", S.round_even("indicator_pct").alias("indicator_pct"))
    exact = fact(spark, sf).filter((F.col("network") == "municipal") & (F.col("n_evaluated") > 3))
    return override_values(published, exact, ["area_id", "year"], [1999, 2000])


@query("target_compare", sql(f"""SELECT area_id, year, v >= target_pct AS hit_mart,
 CASE WHEN target_pct IS NULL THEN NULL ELSE coalesce(v >= target_pct, false) END AS hit_fact, {R('v - target_pct', 1)} AS gap
 FROM (SELECT area_id, year, CASE WHEN level <> 2 THEN indicator_pct END AS v FROM results) LEFT JOIN targets USING (area_id, year)"""))
def target_compare(spark, sf):
    r = results(spark, sf).select("area_id", "year", F.when(F.col("level") != 2, F.col("indicator_pct")).alias("indicator_pct"))
    j = J.enriched(r, targets(spark, sf), ["area_id", "year"])
    return j.select(
        "area_id", "year", S.met_target("indicator_pct", "target_pct", False).alias("hit_mart"),
        S.met_target("indicator_pct", "target_pct", True).alias("hit_fact"),
        S.round_even(F.col("indicator_pct") - F.col("target_pct"), 1).alias("gap"),
    )


@query("context_join", sql("""SELECT person_id, p.year, p.area_id, score, indicator_pct, level FROM persons p
 LEFT JOIN (SELECT year + 1 AS year, area_id, indicator_pct, level FROM results) c USING (year, area_id)"""))
def context_join(spark, sf):
    context = results(spark, sf).select((F.col("year") + 1).alias("year"), "area_id", "indicator_pct", "level")
    people = persons(spark, sf).select("person_id", "year", "area_id", "score")
    return J.enriched(people, context, ["year", "area_id"])


@query("index_union_join", sql("""SELECT u.area_id, a.indicator_pct AS t1, b.target_pct AS target, c.indicator_pct AS t FROM
 (SELECT area_id FROM results WHERE year IN (1999, 2000) UNION SELECT area_id FROM targets WHERE year = 2000) u
 LEFT JOIN (SELECT * FROM results WHERE year = 1999) a USING (area_id)
 LEFT JOIN (SELECT * FROM targets WHERE year = 2000) b USING (area_id)
 LEFT JOIN (SELECT * FROM results WHERE year = 2000) c USING (area_id)"""))
def index_union_join(spark, sf):
    r, t = results(spark, sf), targets(spark, sf)
    return J.aligned(
        "area_id",
        anchors={
            "t1": r.filter("year = 1999").select("area_id", F.col("indicator_pct").alias("t1")),
            "target": t.filter("year = 2000").select("area_id", F.col("target_pct").alias("target")),
            "t": r.filter("year = 2000").select("area_id", F.col("indicator_pct").alias("t")),
        },
    )


@query("denormalise_group_stat", sql(f"""SELECT person_id, school_id, year, n AS school_evaluated, {R('att', 6)} AS attendance FROM evaluated
 JOIN (SELECT year, school_id, count(*) FILTER (present = 1 AND filled = 1) AS n, 100*avg(present) AS att FROM persons GROUP BY 1, 2) USING (year, school_id)"""))
def denormalise_group_stat(spark, sf):
    p = persons(spark, sf)
    out = P.evaluated(p).join(I.school_context(p), ["year", "school_id"], "left")
    return out.select("person_id", "school_id", "year", "school_evaluated", S.round_even("school_attendance_pct", 6).alias("attendance"))


@query("profile_risk_join", sql("""SELECT area_id, level, risk FROM (SELECT area_id, level FROM results WHERE year = 2000)
 LEFT JOIN (SELECT area_id, least(1.0, greatest(0.0, (target_pct - pred)/20 + 0.5)) AS risk FROM predictions WHERE year = 2001) USING (area_id)"""))
def profile_risk_join(spark, sf):
    profile = results(spark, sf).filter("year = 2000").select("area_id", "level")
    slack = (F.col("target_pct") - F.col("pred")) / 20 + 0.5
    risk = predictions(spark, sf).filter("year = 2001").select("area_id", S.clip(slack, 0.0, 1.0).alias("risk"))
    return J.enriched(profile, risk, ["area_id"])


_LABELS = {"mktsegment": "Segmento", "orderpriority": "Prioridade"}


@query("label_lookup", """SELECT name, CASE WHEN name LIKE 'ausente_%' THEN 'Sem informação: Segmento'
 WHEN name LIKE 'mktsegment=%' THEN 'Segmento: ' || substr(name, 12) WHEN name LIKE 'orderpriority_%' THEN 'Prioridade: ' || substr(name, 15)
 WHEN name = 'mktsegment' THEN 'Segmento' ELSE name END AS label
 FROM (SELECT DISTINCT 'mktsegment=' || c_mktsegment AS name FROM customer UNION SELECT DISTINCT 'orderpriority_' || o_orderpriority FROM orders
 UNION SELECT 'ausente_mktsegment' FROM customer UNION SELECT c_mktsegment FROM customer UNION SELECT 'mktsegment' FROM customer)""")
def label_lookup(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    names = (
        c.select(F.concat(F.lit("mktsegment="), "c_mktsegment").alias("name"))
        .union(o.select(F.concat(F.lit("orderpriority_"), "o_orderpriority")))
        .union(c.select(F.lit("ausente_mktsegment"))).union(c.select("c_mktsegment")).union(c.select(F.lit("mktsegment")))
        .distinct()
    )
    return J.labelled(names, "name", _LABELS)


# ---- aggregates ----------------------------------------------------------------------------------


@query("weighted_indicator", sql("SELECT * FROM ind_network"))
def weighted_indicator(spark, sf):
    return I.weighted_indicator(persons(spark, sf), ["year", "area_id", "network"])


@query("gold_fact", sql("SELECT * FROM fact"))
def gold_fact(spark, sf):
    return fact(spark, sf)


@query("gold_fact_change", sql(f"""SELECT *, {R('indicator_pct - previous', 1)} AS change FROM (SELECT year, area_id, network, indicator_pct, hit, gap,
 lag(indicator_pct) OVER (PARTITION BY area_id, network ORDER BY year) AS previous FROM fact)"""))
def gold_fact_change(spark, sf):
    f = fact(spark, sf).select("year", "area_id", "network", "indicator_pct", "hit", "gap", F.concat_ws("|", "area_id", "network").alias("unit"))
    return I.lag_change(f, "unit", "year", "indicator_pct").drop("unit")


@query("coverage_by_year", sql(f"""SELECT year, count(weight) AS n, {R('avg(weight)', 4)} AS mean, {R('CAST(100.0 AS DOUBLE)*count(weight)/1000', 1)} AS share_of_constant
 FROM persons GROUP BY year"""))
def coverage_by_year(spark, sf):
    return A.coverage(persons(spark, sf), ["year"], "weight", constant_total=1000.0)


@query("school_context", sql(f"""SELECT year, school_id, count(*) FILTER (present = 1 AND filled = 1) AS school_evaluated,
 {R('100*avg(present)', 6)} AS school_attendance_pct FROM persons GROUP BY year, school_id HAVING count(*) FILTER (present = 1 AND filled = 1) > 0"""))
def school_context(spark, sf):
    out = I.school_context(persons(spark, sf))
    return out.withColumn("school_attendance_pct", S.round_even("school_attendance_pct", 6))


@query("listed_summary", sql(f"""SELECT year, count(*) AS n_listed, CAST(sum(present) AS BIGINT) AS n_present, count(DISTINCT school_id) AS n_schools,
 count(DISTINCT area_id) AS n_areas, {R('100*avg(present)', 2)} AS present_pct,
 {R('avg(score) FILTER (present = 1 AND filled = 1)', 2)} AS mean_score_evaluated FROM persons GROUP BY year"""))
def listed_summary(spark, sf):
    return A.listed_summary(persons(spark, sf))


@query("null_profile", sql(f"""SELECT variable, {R('avg(m)', 6)} AS null_share FROM (
 SELECT unnest(['weight', 'score', 'big_score']) AS variable, unnest([CAST(weight IS NULL AS INTEGER), 0, CAST(score < 50000 AS INTEGER)]) AS m FROM persons)
 GROUP BY variable HAVING avg(m) > 0"""))
def null_profile(spark, sf):
    df = persons(spark, sf).withColumn("big_score", F.when(F.col("score") >= 50000, F.col("score")))
    return A.null_profile(df, ["weight", "score", "big_score"])


@query("null_profile_by_year", sql(f"""PIVOT (SELECT variable, year, {R('100*avg(m)', 2)} AS p FROM (
 SELECT year, unnest(['weight', 'network']) AS variable, unnest([CAST(weight IS NULL AS INTEGER), CAST(network IS NULL AS INTEGER)]) AS m FROM persons) GROUP BY 1, 2)
 ON year IN (1999, 2000, 2001) USING max(p) GROUP BY variable"""))
def null_profile_by_year(spark, sf):
    return A.null_profile_pivot(persons(spark, sf), ["weight", "network"], "year", [1999, 2000, 2001])


@query("distinct_list", """SELECT n_regionkey AS region, array_to_string(list_sort(list(DISTINCT n_name)), ', ') AS names FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def distinct_list(spark, sf):
    j = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return A.distinct_list(j, [F.col("n_regionkey").alias("region")], "n_name", "names")


_XTAB = f"""SELECT status, coalesce(a, 0) AS "1-URGENT", coalesce(b, 0) AS "2-HIGH", coalesce(a, 0) + coalesce(b, 0) AS total,
 {R('CAST(coalesce(a, 0) AS DOUBLE)/(coalesce(a, 0) + coalesce(b, 0))', 6)} AS "1-URGENT_share", {R('CAST(coalesce(b, 0) AS DOUBLE)/(coalesce(a, 0) + coalesce(b, 0))', 6)} AS "2-HIGH_share"
 FROM (SELECT o_orderstatus AS status, count(*) FILTER (o_orderpriority = '1-URGENT') AS a, count(*) FILTER (o_orderpriority = '2-HIGH') AS b FROM orders GROUP BY 1)"""


@query("crosstab", _XTAB)
def crosstab(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_orderstatus", "status")
    return A.crosstab(o, "status", "o_orderpriority", ["1-URGENT", "2-HIGH"], normalise="row", digits=6)


@query("rate_by_group", sql(f"SELECT year, network, {R('avg(passed)', 6)} AS rate, count(*) AS n FROM evaluated GROUP BY year, network HAVING count(*) >= 30"))
def rate_by_group(spark, sf):
    return A.rate_by_group(P.evaluated(persons(spark, sf)), ["year", "network"], "passed", minimum=30, digits=6)


@query("weighted_mean_by_group", sql(f"""SELECT year, {R('sum(w*score_a)/sum(w)', 6)} AS predicted, {R('sum(w*y)/sum(w)', 6)} AS observed,
 {R('100*(sum(w*score_a)/sum(w) - sum(w*y)/sum(w))', 4)} AS bias_points FROM scored GROUP BY year"""))
def weighted_mean_by_group(spark, sf):
    return A.weighted_means(scored(spark, sf), ["year"], "score_a", "y", "w")


@query("median_by_group", sql(f"SELECT network, {R('median(score)', 4)} AS score, {R('median(weight)', 4)} AS weight FROM persons WHERE network IS NOT NULL GROUP BY network"))
def median_by_group(spark, sf):
    m = medians(persons(spark, sf), ["score", "weight"], ["network"])
    return m.select("network", *[S.round_even(c, 4).alias(c) for c in ("score", "weight")])


_RISK = "SELECT area_id, state, least(1.0, greatest(0.0, (target_pct - pred)/20 + 0.5)) AS risk, pred - target_pct AS gap FROM predictions JOIN areas USING (area_id) WHERE year = 2001 AND target_pct IS NOT NULL"


def _risk(spark, sf):
    df = P.projection_universe(predictions(spark, sf), 2001, "target_pct", "year").join(areas(spark, sf), "area_id")
    risk = S.clip((F.col("target_pct") - F.col("pred")) / 20 + 0.5, 0.0, 1.0)
    return df.select("area_id", "state", "pred", "y", risk.alias("risk"), (F.col("pred") - F.col("target_pct")).alias("gap"))


@query("risk_by_state", sql(f"""SELECT state, count(*) AS n_areas, count(*) FILTER (risk >= 0.5) AS n_at_risk, {R('avg(risk)', 4)} AS mean_risk,
 {R('median(gap)', 2)} AS median_gap, {R('CAST(100.0 AS DOUBLE)*count(*) FILTER (risk >= 0.5)/count(*)', 1)} AS at_risk_pct FROM risk GROUP BY state""", risk=_RISK))
def risk_by_state(spark, sf):
    return A.risk_by_state(_risk(spark, sf), "state", "risk", "gap")


@query("residual_by_group", sql(f"""SELECT state, {R('avg(y - pred)', 4)} AS mean, {R('median(y - pred)', 4)} AS median, count(*) AS n
 FROM predictions JOIN areas USING (area_id) GROUP BY state"""))
def residual_by_group(spark, sf):
    df = predictions(spark, sf).join(areas(spark, sf), "area_id")
    return A.described(df.withColumn("r", F.col("y") - F.col("pred")), "r", ["state"], extremes=False)


@query("describe", sql(f"""SELECT year, {R('avg(indicator_pct)', 4)} AS mean, {R('median(indicator_pct)', 4)} AS median, count(*) AS n,
 {R('min(indicator_pct)', 4)} AS min, {R('max(indicator_pct)', 4)} AS max FROM results GROUP BY year"""))
def describe(spark, sf):
    return A.described(results(spark, sf), "indicator_pct", ["year"])


@query("fold_summary", sql(f"""SELECT part, {R('avg(mae)', 4)} AS mae_mean, {R('stddev_samp(mae)', 4)} AS mae_std FROM (
 SELECT CASE WHEN year < 1999 THEN 'train' ELSE 'validation' END AS part, year, avg(abs(y - pred)) AS mae FROM predictions GROUP BY 1, 2) GROUP BY part"""))
def fold_summary(spark, sf):
    part = F.when(F.col("year") < 1999, "train").otherwise("validation").alias("part")
    folds = predictions(spark, sf).groupBy(part, "year").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"))
    return A.fold_summary(folds, "part", ["mae"])


@query("pivot_profile_state", sql("""PIVOT (SELECT level, region FROM results JOIN areas USING (area_id) WHERE year = 2000)
 ON region IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST') USING count(*) GROUP BY level"""))
def pivot_profile_state(spark, sf):
    df = results(spark, sf).filter("year = 2000").join(areas(spark, sf), "area_id")
    return A.crosstab(df, "level", "region", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], totals=False)


@query("histogram_table", sql("""SELECT year, CAST(CASE WHEN hi = lo THEN 0 ELSE least(39, floor((indicator_pct - lo)/((hi - lo)/40))) END AS INTEGER) AS bin, count(*) AS n
 FROM results JOIN (SELECT year, min(indicator_pct) AS lo, max(indicator_pct) AS hi FROM results GROUP BY year) USING (year) GROUP BY 1, 2"""))
def histogram_table(spark, sf):
    return A.histogram(results(spark, sf), "indicator_pct", 40, ["year"])


# ---- windows -------------------------------------------------------------------------------------


@query("lag_change", sql(f"SELECT *, {R('indicator_pct - previous', 1)} AS change FROM (SELECT area_id, year, indicator_pct, lag(indicator_pct) OVER (PARTITION BY area_id ORDER BY year) AS previous FROM results)"))
def lag_change(spark, sf):
    return I.lag_change(results(spark, sf).select("area_id", "year", "indicator_pct"), "area_id", "year", "indicator_pct")


@query("diff_monotone", sql(f"""SELECT area_id, year, {R('step', 4)} AS step FROM (SELECT area_id, year, target_pct - lag(target_pct) OVER (PARTITION BY area_id ORDER BY year) AS step FROM targets) WHERE step < -1e-9"""))
def diff_monotone(spark, sf):
    from ..operators.editions import drops_in_sequence

    out = drops_in_sequence(targets(spark, sf), "area_id", "year", "target_pct")
    return out.select("area_id", "year", S.round_even("step", 4).alias("step"))


@query("group_mean_transform", sql(f"SELECT person_id, {R('avg(score) OVER (PARTITION BY area_id)', 4)} AS area_mean FROM persons"))
def group_mean_transform(spark, sf):
    out = W.with_group_mean(persons(spark, sf), ["area_id"], "score", "area_mean")
    return out.select("person_id", S.round_even("area_mean", 4).alias("area_mean"))


@query("rank_position", sql("SELECT area_id, risk, row_number() OVER (ORDER BY risk DESC, area_id) AS position FROM risk", risk=_RISK))
def rank_position(spark, sf):
    return rank_positions(_risk(spark, sf).select("area_id", "risk"), "risk", "area_id")


@query("avg_rank", sql("SELECT score_b, count(*) AS ties, min(r) + (count(*) - 1)/2.0::DOUBLE AS rank FROM (SELECT score_b, rank() OVER (ORDER BY score_b) AS r FROM scored) GROUP BY score_b"))
def avg_rank(spark, sf):
    return average_ranks(scored(spark, sf), "score_b")


# ---- order and buckets ---------------------------------------------------------------------------


@query("ranking_topk", sql(f"SELECT area_id, state, {R('risk', 4)} AS risk FROM risk ORDER BY risk DESC, area_id LIMIT 25", risk=_RISK))
def ranking_topk(spark, sf):
    return W.top_k(_risk(spark, sf), "risk", "area_id", 25).select("area_id", "state", S.round_even("risk", 4).alias("risk"))


@query("first_under_bound", sql(f"SELECT area_id, {R('risk', 4)} AS risk FROM risk WHERE risk < 0.5 ORDER BY risk DESC, area_id LIMIT 1", risk=_RISK))
def first_under_bound(spark, sf):
    under = _risk(spark, sf).filter("risk < 0.5")
    return W.top_k(under, "risk", "area_id", 1).select("area_id", S.round_even("risk", 4).alias("risk"))


@query("sort_by_abs", sql(f"SELECT area_id, year, residual, row_number() OVER (ORDER BY abs(residual) DESC, area_id, year) AS position FROM predictions ORDER BY position LIMIT 50"))
def sort_by_abs(spark, sf):
    return W.strongest(predictions(spark, sf).select("area_id", "year", "residual"), "residual", ["area_id", "year"], 50)


_QCUT = """WITH e AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM orders)
SELECT bucket, count(*) AS n FROM (SELECT CAST(len(list_filter(edges, lambda x: x < o_totalprice)) AS INTEGER) AS bucket FROM orders, e) GROUP BY bucket"""


@query("quantile_bucket", _QCUT)
def quantile_bucket(spark, sf):
    out = B.quantile_bucket(table(spark, sf, "orders").select("o_totalprice"), "o_totalprice", 10)
    return out.groupBy("bucket").agg(F.count("*").alias("n"))


@query("fixed_bucket", sql("""SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN gap <= -80 THEN NULL WHEN gap <= -10 THEN 0 WHEN gap <= -5 THEN 1 WHEN gap <= 0 THEN 2 WHEN gap <= 2.5 THEN 3
 WHEN gap <= 5 THEN 4 WHEN gap <= 10 THEN 5 WHEN gap <= 15 THEN 6 WHEN gap <= 80 THEN 7 END AS bucket FROM fact) GROUP BY bucket"""))
def fixed_bucket(spark, sf):
    return fact(spark, sf).groupBy(B.fixed_bucket("gap", B.JUMP_EDGES).alias("bucket")).agg(F.count("*").alias("n"))


@query("equal_width_bucket", sql("SELECT CAST(greatest(0, least(9, floor(score_b*10))) AS INTEGER) AS bucket, count(*) AS n FROM scored GROUP BY 1"))
def equal_width_bucket(spark, sf):
    return scored(spark, sf).groupBy(B.equal_width_bucket("score_b", 10).alias("bucket")).agg(F.count("*").alias("n"))


@query("deterministic_sort_output", sql("SELECT year, area_id, network, indicator_pct FROM fact"))
def deterministic_sort_output(spark, sf):
    from ..session import scratch_path
    from ..sources.sinks import write_table

    path = scratch_path(spark, "sorted")
    write_table(fact(spark, sf).select("year", "area_id", "network", "indicator_pct"), path, ["year", "area_id", "network"])
    return spark.read.parquet(path)


# ---- set operations ------------------------------------------------------------------------------


@query("union_editions", sql("""SELECT year, count(*) AS n, count(level) AS n_level FROM (SELECT year, area_id, level FROM results WHERE year < 1999
 UNION ALL SELECT year, area_id, NULL FROM results WHERE year >= 1999) GROUP BY year"""))
def union_editions(spark, sf):
    r = results(spark, sf)
    both = r.filter("year < 1999").unionByName(r.filter("year >= 1999").drop("level"), allowMissingColumns=True)
    return both.groupBy("year").agg(F.count("*").alias("n"), F.count("level").alias("n_level"))


@query("distinct_union_keys", "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events UNION SELECT c_custkey FROM customer")
def distinct_union_keys(spark, sf):
    return J.distinct_keys([table(spark, sf, "orders").select("o_custkey"), table(spark, sf, "events").select("user_id"), table(spark, sf, "customer").select("c_custkey")], "id")


# ---- scalar functions ----------------------------------------------------------------------------


@query("scalar_functions", f"""SELECT s_suppkey AS id, {R('s_acctbal', 1)} AS rounded, CAST(s_suppkey // 7 AS BIGINT) AS code, {R('ln(1 + greatest(s_acctbal, 0))', 6)} AS logged,
 {R('CASE WHEN s_suppkey > 0 THEN CAST(1000.0 AS DOUBLE)*s_acctbal/s_suppkey END', 4)} AS per_head, lower(replace(s_name, '#', '')) AS name,
 greatest(0.0, least(5000.0, s_acctbal)) AS clipped, printf('%.1f a %.1f', (s_suppkey % 10)/10.0, (s_suppkey % 10 + 1)/10.0) AS band,
 TRY_CAST(CASE WHEN s_suppkey % 3 = 0 THEN '--' ELSE CAST(s_suppkey AS VARCHAR) END AS DOUBLE) AS number,
 CASE s_nationkey // 5 WHEN 1 THEN 'Norte' WHEN 2 THEN 'Nordeste' WHEN 3 THEN 'Sudeste' WHEN 4 THEN 'Sul' END AS region FROM supplier""")
def scalar_functions(spark, sf):
    s, k = table(spark, sf, "supplier"), F.col("s_suppkey")
    return s.select(
        k.alias("id"), S.round_even("s_acctbal", 1).alias("rounded"), F.floor(k / 7).alias("code"),
        S.round_even(S.log1p_safe("s_acctbal"), 6).alias("logged"),
        S.round_even(S.per_capita("s_acctbal", "s_suppkey"), 4).alias("per_head"),
        S.clean_text("s_name", drop=["#"], lower=True).alias("name"),
        S.clip("s_acctbal", 0.0, 5000.0).alias("clipped"), S.band_label(k % 10, 10).alias("band"),
        S.to_number(F.when(k % 3 == 0, "--").otherwise(k.cast("string"))).alias("number"),
        S.region_name(F.floor(F.col("s_nationkey") / 5).cast("int") * 10).alias("region"),
    )
