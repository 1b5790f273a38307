"""Quality checks, statistics, metrics, risk, sampling and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round_even
from ..operators import metrics as M
from ..operators import quality as Q
from ..operators import resampling as RS
from ..operators import stats as X
from ..operators.indicator import area_mart
from ..operators.rows import evaluated
from ..session import stored
from .base import CUT, H, R, areas, fact, persons, predictions, results, scored, sql, table, targets
from .registry import query


def rounded(df, digits, *keep):
    kinds = dict(df.dtypes)
    return df.select(*[
        round_even(c, digits).alias(c) if c not in keep and kinds[c] in ("double", "float") else F.col(c) for c in df.columns
    ])


def ranked(source: str, y: str, score: str, w: str = "1.0", by: str = "") -> str:
    """SQL of AUC, average precision and KS per group."""
    part, keys = (f"PARTITION BY {by}", f"{by}, ") if by else ("", "")
    group = f"GROUP BY {by}" if by else ""
    before = f"{part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""SELECT {keys}sum(pos*(neg_before + neg/2))/nullif(max(p)*max(n), 0) AS auc,
 sum(pos*coalesce((p - pos_before)/nullif((p - pos_before) + (n - neg_before), 0), 0))/nullif(max(p), 0) AS average_precision,
 greatest(0.0, max((p - pos_before)/nullif(p, 0) - (n - neg_before)/nullif(n, 0))) AS ks
 FROM (SELECT *, coalesce(sum(pos) OVER ({before}), 0) AS pos_before, coalesce(sum(neg) OVER ({before}), 0) AS neg_before,
   sum(pos) OVER ({part}) AS p, sum(neg) OVER ({part}) AS n
   FROM (SELECT {keys}{score} AS s, sum(CASE WHEN {y} = 1 THEN CAST({w} AS DOUBLE) ELSE 0 END) AS pos, sum(CASE WHEN {y} = 1 THEN 0 ELSE CAST({w} AS DOUBLE) END) AS neg
     FROM {source} WHERE {score} IS NOT NULL AND {y} IS NOT NULL GROUP BY {keys}{score})) {group}"""


def _mart(spark, sf):
    return area_mart(results(spark, sf), targets(spark, sf), areas(spark, sf), fact(spark, sf), "municipal")


# ---- quality -------------------------------------------------------------------------------------

_CHECKS = [
    ("area key unique", "SELECT count(*) - count(DISTINCT area_id) AS d FROM areas"),
    ("fact key unique", "SELECT count(*) - count(DISTINCT (year, area_id, network)) AS d FROM fact"),
    ("mart key unique", "SELECT count(*) - count(DISTINCT (year, area_id)) AS d FROM mart"),
    ("person key unique", "SELECT count(*) - count(DISTINCT (year, person_id)) AS d FROM persons"),
    ("fact areas known", "SELECT count(DISTINCT area_id) AS d FROM fact WHERE area_id NOT IN (SELECT area_id FROM areas)"),
    ("person areas known", "SELECT count(DISTINCT area_id) AS d FROM persons WHERE area_id NOT IN (SELECT area_id FROM areas)"),
    ("fact indicator in 0..100", "SELECT count(*) FILTER (NOT indicator_pct BETWEEN 0 AND 100) AS d FROM fact"),
    ("mart indicator in 0..100", "SELECT count(*) FILTER (NOT indicator_pct BETWEEN 0 AND 100) AS d FROM mart"),
    ("evaluated have a score", "SELECT count(*) FILTER (score IS NULL) AS d FROM evaluated"),
    ("label is the cutoff rule", f"SELECT count(*) FILTER ((score >= {CUT}) <> (passed = 1)) AS d FROM evaluated"),
    ("targets never fall", "SELECT count(*) AS d FROM (SELECT target_pct - lag(target_pct) OVER (PARTITION BY area_id ORDER BY year) AS s FROM targets) WHERE s < -1e-9"),
]


@query("quality_checks", sql(
    " UNION ALL ".join(f"SELECT '{n}' AS \"check\", d = 0 AS ok, CAST(d AS BIGINT) AS detail FROM ({q})" for n, q in _CHECKS)
    + """ UNION ALL SELECT 'own figure close to official', d < 0.1, CAST(round_even(d*1000, 0) AS BIGINT) FROM
 (SELECT avg(abs(m.indicator_pct - f.indicator_pct)) AS d FROM mart m JOIN fact f USING (year, area_id) WHERE network = 'municipal')"""))
def quality_checks(spark, sf):
    """The checks read stored Gold tables, as they would after a run."""
    f, m, t = (stored(df, "checked") for df in (fact(spark, sf), _mart(spark, sf), targets(spark, sf)))
    return Q.quality_checks(persons(spark, sf), areas(spark, sf), f, m, t, CUT)


@query("table_profile", """SELECT 'lineitem' AS "table", count(*) AS n_rows, 11 AS n_columns, 'line' AS grain FROM lineitem UNION ALL
 SELECT 'supplier', count(*), 4, 'area' FROM supplier UNION ALL SELECT 'events', count(*), 6, 'event' FROM events""")
def table_profile(spark, sf):
    grains = {"lineitem": "line", "supplier": "area", "events": "event"}
    return Q.table_profile({n: (table(spark, sf, n), g) for n, g in grains.items()})


_LEAK = """SELECT passed AS y, score AS price, CASE WHEN passed = 1 OR filled = 1 THEN weight END AS shortcut, CAST(school_id AS DOUBLE) AS school,
 CAST(1 AS DOUBLE) AS constant FROM persons"""


def _leak_frame(spark, sf):
    p = persons(spark, sf)
    return p.select(
        F.col("passed").alias("y"), F.col("score").alias("price"),
        F.when((F.col("passed") == 1) | (F.col("filled") == 1), F.col("weight")).alias("shortcut"),
        F.col("school_id").cast("double").alias("school"), F.lit(1.0).alias("constant"),
    )


def _missing_sql(source: str, columns: list[str], w: str = "1.0") -> str:
    one = """SELECT '{c}' AS variable, count(*) FILTER ({c} IS NULL) AS n_missing, count(*) AS n_all,
 0.5 + (sum(CASE WHEN y = 1 AND {c} IS NULL THEN {w} ELSE 0 END)/sum(CASE WHEN y = 1 THEN {w} END)
  - sum(CASE WHEN y <> 1 AND {c} IS NULL THEN {w} ELSE 0 END)/sum(CASE WHEN y <> 1 THEN {w} END))/2 AS a FROM {source}"""
    body = " UNION ALL ".join(one.format(c=c, w=w, source=source) for c in columns)
    return f"SELECT variable, n_missing, greatest(a, 1 - a) AS auc_missing FROM ({body}) WHERE n_missing > 0 AND n_missing < n_all"


@query("leak_gate", sql(f"""SELECT coalesce(a.variable, m.variable) AS variable, {R('greatest(a.auc, 1 - a.auc)', 6)} AS auc, {R('auc_missing', 6)} AS auc_missing,
 coalesce(greatest(a.auc, 1 - a.auc), 0) > 0.90 OR coalesce(auc_missing, 0) >= 0.60 AS leaks
 FROM (SELECT 'price' AS variable, auc FROM ({ranked('leaky', 'y', 'price')}) UNION ALL SELECT 'shortcut', auc FROM ({ranked('leaky', 'y', 'shortcut')})
  UNION ALL SELECT 'school', auc FROM ({ranked('leaky', 'y', 'school')})) a FULL JOIN ({_missing_sql('leaky', ['price', 'shortcut', 'school', 'constant'], 'CAST(1 AS DOUBLE)')}) m USING (variable)""", leaky=_LEAK))
def leak_gate(spark, sf):
    return rounded(X.leak_gate(_leak_frame(spark, sf), ["price", "shortcut", "school", "constant"], "y"), 6)


# ---- statistics ----------------------------------------------------------------------------------


def _spearman_sql(source: str, a: str, b: str) -> str:
    return f"""SELECT '{a}' AS v1, '{b}' AS v2, count(*) AS n, {R('corr(ra, rb)', 6)} AS rho FROM (
 SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1)/2.0::DOUBLE AS ra, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1)/2.0::DOUBLE AS rb
 FROM (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"""


@query("spearman_pair", sql(_spearman_sql("persons", "weight", "score") + " UNION ALL " + _spearman_sql("persons", "score", "passed")))
def spearman_pair(spark, sf):
    return rounded(X.spearman_pairs(persons(spark, sf), [("weight", "score"), ("score", "passed")]), 6)


_COUPLES = [("indicator_pct", "level"), ("indicator_pct", "participation_pct"), ("level", "participation_pct")]


@query("spearman_matrix", sql(" UNION ALL ".join(_spearman_sql("results", a, b) for a, b in _COUPLES)))
def spearman_matrix(spark, sf):
    return rounded(X.spearman_matrix(results(spark, sf), ["indicator_pct", "level", "participation_pct"]), 6)


@query("upper_triangle_pairs", sql("SELECT * FROM (" + " UNION ALL ".join(_spearman_sql("results", a, b) for a, b in _COUPLES) + ") WHERE abs(rho) > 0.6"))
def upper_triangle_pairs(spark, sf):
    return rounded(X.strong_pairs(X.spearman_matrix(results(spark, sf), ["indicator_pct", "level", "participation_pct"])), 6)


@query("kruskal_wallis", sql(f"""WITH r AS (SELECT region, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1)/2.0::DOUBLE AS rk FROM persons JOIN areas USING (area_id)),
 g AS (SELECT count(*)::DOUBLE AS n, sum(rk) AS s FROM r GROUP BY region), t AS (SELECT sum(c::DOUBLE*c*c - c) AS t FROM (SELECT count(*) AS c FROM persons GROUP BY score))
 SELECT {R('(12/(n*(n+1))*q - 3*(n+1))/(1 - t/(n*n*n - n))', 4)} AS h, k - 1 AS dof, CAST(n AS BIGINT) AS n FROM (SELECT sum(n) AS n, sum(s*s/n) AS q, count(*) AS k FROM g), t""".replace("WITH r AS", "SELECT * FROM (WITH r AS") + ")"))
def kruskal_wallis(spark, sf):
    df = persons(spark, sf).join(areas(spark, sf).select("area_id", "region"), "area_id")
    return rounded(X.kruskal_wallis(df, "score", "region"), 4)


@query("eta_squared", sql(f"""SELECT {R('sum(n*(m - g)*(m - g))/(sum(n*(m - g)*(m - g)) + sum(n*v))', 6)} AS eta_squared FROM
 (SELECT count(*) AS n, avg(indicator_pct) AS m, var_pop(indicator_pct) AS v FROM results JOIN areas USING (area_id) GROUP BY region), (SELECT avg(indicator_pct) AS g FROM results)"""))
def eta_squared(spark, sf):
    df = results(spark, sf).join(areas(spark, sf).select("area_id", "region"), "area_id")
    return rounded(X.eta_squared(df, "indicator_pct", "region"), 6)


def _chi_sql(source: str, row: str, col: str) -> str:
    return f"""SELECT {R('CASE WHEN dof = 1 THEN yates ELSE plain END', 4)} AS chi2, dof, n FROM (SELECT sum((o-e)*(o-e)/e) AS plain,
 sum((abs(o-e)-least(0.5,abs(o-e)))*(abs(o-e)-least(0.5,abs(o-e)))/e) AS yates, (count(DISTINCT r)-1)*(count(DISTINCT c)-1) AS dof, CAST(max(n) AS BIGINT) AS n FROM
 (SELECT r, c, coalesce(o, 0)::DOUBLE AS o, nr::DOUBLE*nc/n AS e, n FROM (SELECT {row} AS r, count(*) AS nr FROM {source} GROUP BY 1) a
  CROSS JOIN (SELECT {col} AS c, count(*) AS nc FROM {source} GROUP BY 1) b CROSS JOIN (SELECT count(*) AS n FROM {source}) s
  LEFT JOIN (SELECT {row} AS r, {col} AS c, count(*) AS o FROM {source} GROUP BY 1, 2) o USING (r, c)))"""


@query("chi_square", sql(_chi_sql("persons", "network", "passed")))
def chi_square(spark, sf):
    return rounded(X.chi_square(persons(spark, sf), "network", "passed"), 4)


@query("chi_square_wide", _chi_sql("events", "event_type", "user_id"))
def chi_square_wide(spark, sf):
    return rounded(X.chi_square(table(spark, sf, "events"), "event_type", "user_id"), 4)


@query("skewness_adjusted", f"SELECT lang, {R('skewness(n_chars)', 4)} AS skew FROM documents GROUP BY lang")
def skewness_adjusted(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(round_even(X.adjusted_skewness("n_chars"), 4).alias("skew"))


@query("variance_decomposition", sql(f"""SELECT {R('100*a/(a+b+c)', 4)} AS between_outer_pct, {R('100*b/(a+b+c)', 4)} AS between_inner_pct, {R('100*c/(a+b+c)', 4)} AS within_pct FROM
 (SELECT var_samp(mo) AS a, var_samp(mi - mo) AS b, var_samp(score - mi) AS c FROM
 (SELECT score, avg(score) OVER (PARTITION BY area_id) AS mo, avg(score) OVER (PARTITION BY school_id) AS mi FROM evaluated))"""))
def variance_decomposition(spark, sf):
    return rounded(X.variance_decomposition(evaluated(persons(spark, sf)), "score", "area_id", "school_id"), 4)


@query("single_score_auc", sql(f"""SELECT 'weight' AS variable, {R('auc', 6)} AS auc FROM ({ranked('persons', 'passed', 'weight')}) UNION ALL
 SELECT 'school_id', {R('auc', 6)} FROM ({ranked('persons', 'passed', 'school_id')})"""))
def single_score_auc(spark, sf):
    return rounded(X.single_score_auc(persons(spark, sf), ["weight", "school_id"], "passed"), 6)


@query("weighted_class_rate", sql(f"SELECT year, {R('avg(y)', 6)} AS raw, {R('sum(w*y)/sum(w)', 6)} AS weighted FROM scored GROUP BY year"))
def weighted_class_rate(spark, sf):
    return rounded(X.weighted_rate(scored(spark, sf), "y", "w", ["year"]), 6)


# ---- metrics -------------------------------------------------------------------------------------


@query("weighted_auc", sql(f"SELECT {R('auc', 6)} AS auc FROM ({ranked('scored', 'y', 'score_a', 'w')})"))
def weighted_auc(spark, sf):
    return rounded(M.ranking_metrics(scored(spark, sf), "y", "score_a", "w", names=("auc",)), 6)


@query("average_precision", sql(f"SELECT {R('average_precision', 6)} AS average_precision FROM ({ranked('scored', 'y', 'score_a', 'w')})"))
def average_precision(spark, sf):
    return rounded(M.ranking_metrics(scored(spark, sf), "y", "score_a", "w", names=("average_precision",)), 6)


@query("ks", sql(f"SELECT {R('ks', 6)} AS ks FROM ({ranked('scored', 'y', 'score_a', 'w')})"))
def ks(spark, sf):
    return rounded(M.ranking_metrics(scored(spark, sf), "y", "score_a", "w", names=("ks",)), 6)


@query("auc_by_group", sql(f"SELECT area_id, {R('auc', 6)} AS auc FROM ({ranked('scored', 'y', 'score_a', 'w', 'area_id')})"))
def auc_by_group(spark, sf):
    return rounded(M.ranking_metrics(scored(spark, sf), "y", "score_a", "w", by=["area_id"], names=("auc",)), 6)


_CURVE = """SELECT s AS threshold, sum(pos) OVER d / sum(pos) OVER () AS tpr, sum(neg) OVER d / sum(neg) OVER () AS fpr,
 sum(pos) OVER d / (sum(pos) OVER d + sum(neg) OVER d) AS precision
 FROM (SELECT score_a AS s, sum(w*y) AS pos, sum(w*(1-y)) AS neg FROM scored GROUP BY 1) WINDOW d AS (ORDER BY s DESC)"""


@query("roc_points", sql(f"SELECT threshold, {R('tpr', 6)} AS tpr, {R('fpr', 6)} AS fpr FROM ({_CURVE})"))
def roc_points(spark, sf):
    return rounded(M.roc_points(scored(spark, sf), "y", "score_a", "w"), 6)


@query("pr_points", sql(f"SELECT threshold, {R('tpr', 6)} AS recall, {R('precision', 6)} AS precision FROM ({_CURVE})"))
def pr_points(spark, sf):
    return rounded(M.pr_points(scored(spark, sf), "y", "score_a", "w"), 6)


def _rates_sql(cells: str, first: str) -> str:
    z = lambda a, b: f"coalesce(({a})/nullif({b}, 0), 0)"
    p, r = z("tp", "tp+fp"), z("tp", "tp+fn")
    cols = {
        "accuracy": "(tp+tn)/(tp+fp+fn+tn)", "precision": p, "recall": r, "f1": z(f"2*{p}*{r}", f"{p}+{r}"),
        "precision_negatives": z("tn", "tn+fn"), "recall_negatives": z("tn", "tn+fp"), "base_rate": "(tp+fn)/(tp+fp+fn+tn)",
    }
    return f"SELECT {first}, " + ", ".join(f"{R(e, 6)} AS {c}" for c, e in cols.items()) + f" FROM ({cells})"


def _cells_sql(t: str, source: str = "scored") -> str:
    return f"""sum(CASE WHEN score_a >= {t} AND y = 1 THEN w ELSE 0 END) AS tp, sum(CASE WHEN score_a >= {t} AND y = 0 THEN w ELSE 0 END) AS fp,
 sum(CASE WHEN score_a < {t} AND y = 1 THEN w ELSE 0 END) AS fn, sum(CASE WHEN score_a < {t} AND y = 0 THEN w ELSE 0 END) AS tn FROM {source}"""


_HALF = "CAST(0.5 AS DOUBLE)"


@query("confusion_metrics", sql(_rates_sql(f"SELECT year, {_cells_sql(_HALF)} GROUP BY year", f"year, {_HALF} AS threshold")))
def confusion_metrics(spark, sf):
    return rounded(M.confusion_metrics(scored(spark, sf), "y", "score_a", 0.5, "w", ["year"]), 6)


@query("confusion_matrix", sql(f"SELECT {_cells_sql(_HALF)}".replace(" w ", " 1.0::DOUBLE ")))
def confusion_matrix(spark, sf):
    return M.confusion_table(scored(spark, sf), "y", "score_a", 0.5)


@query("classification_report", sql(f"""SELECT c.*, {R('auc', 6)} AS auc, {R('average_precision', 6)} AS average_precision FROM
 ({_rates_sql(f"SELECT {_cells_sql(_HALF)}", f"{_HALF} AS threshold")}) c, ({ranked('scored', 'y', 'score_a', 'w')})"""))
def classification_report(spark, sf):
    return rounded(M.classification_report(scored(spark, sf), "y", "score_a", 0.5, "w"), 6)


def _sweep_sql(step: float) -> str:
    grid = ", ".join(f"({t})" for t in M.threshold_grid(step))
    return f"SELECT t.t AS threshold, {_cells_sql('t.t', 'scored CROSS JOIN t')} GROUP BY t.t", f"SELECT CAST(v AS DOUBLE) AS t FROM (VALUES {grid}) x(v)"


_S2, _G2 = _sweep_sql(0.02)
_S1, _G1 = _sweep_sql(0.01)


@query("threshold_sweep", sql(_rates_sql(_S2, "threshold"), t=_G2))
def threshold_sweep(spark, sf):
    return rounded(M.threshold_sweep(scored(spark, sf), "y", "score_a", "w"), 6)


@query("operating_threshold", sql(f"SELECT coalesce(min(threshold) FILTER (recall_negatives >= 0.6), max(threshold)) AS threshold FROM ({_rates_sql(_S1, 'threshold')})", t=_G1))
def operating_threshold(spark, sf):
    return M.operating_threshold(scored(spark, sf), "y", "score_a", 0.6, "w")


_SPEAR_BY_YEAR = """SELECT year, corr(ra, rb) AS rho FROM (SELECT year, rank() OVER (PARTITION BY year ORDER BY pred) + (count(*) OVER (PARTITION BY year, pred) - 1)/2.0::DOUBLE AS ra,
 rank() OVER (PARTITION BY year ORDER BY y) + (count(*) OVER (PARTITION BY year, y) - 1)/2.0::DOUBLE AS rb FROM predictions WHERE y IS NOT NULL AND pred IS NOT NULL) GROUP BY year"""


@query("regression_metrics", sql(f"""SELECT year, {R('avg(abs(pred-y))', 6)} AS mae, {R('sqrt(avg((pred-y)*(pred-y)))', 6)} AS rmse,
 {R('1 - sum((pred-y)*(pred-y))/(var_pop(y)*count(y))', 6)} AS r2, {R('avg(pred-y)', 6)} AS bias, {R('max(rho)', 6)} AS spearman
 FROM predictions JOIN ({_SPEAR_BY_YEAR}) USING (year) WHERE y IS NOT NULL AND pred IS NOT NULL GROUP BY year"""))
def regression_metrics(spark, sf):
    return rounded(M.regression_metrics(predictions(spark, sf), "y", "pred", ["year"]), 6)


_RISK_SQL = """SELECT u.area_id, u.year, CASE WHEN u.target_pct - u.pred IS NULL THEN NULL
 ELSE (SELECT count(*) FROM predictions r WHERE r.residual <= u.target_pct - u.pred)::DOUBLE/(SELECT count(residual) FROM predictions) END AS risk FROM predictions u"""


@query("risk_of_missing", sql(f"SELECT area_id, year, {R('risk', 6)} AS risk FROM ({_RISK_SQL})"))
def risk_of_missing(spark, sf):
    p = predictions(spark, sf)
    return rounded(M.risk_of_missing(p, "pred", "target_pct", p, "residual", ["area_id", "year"]).select("area_id", "year", "risk"), 6)


@query("brier", sql(f"SELECT year, {R('sum(w*(score_a-y)*(score_a-y))/sum(w)', 6)} AS brier FROM scored GROUP BY year"))
def brier(spark, sf):
    return rounded(M.brier(scored(spark, sf), "y", "score_a", "w", ["year"]), 6)


@query("calibration_curve", sql(f"""SELECT printf('%.1f a %.1f', b/10.0, (b+1)/10.0) AS band, {R('sum(w*score_a)/sum(w)', 6)} AS predicted, {R('sum(w*y)/sum(w)', 6)} AS observed,
 count(*) AS n, {R('sum(w)', 6)} AS weight FROM (SELECT *, CAST(greatest(0, least(9, floor(score_a*10))) AS INTEGER) AS b FROM scored) GROUP BY b"""))
def calibration_curve(spark, sf):
    return rounded(M.calibration_curve(scored(spark, sf), "y", "score_a", 10, "w"), 6)


@query("decile_calibration", sql(f"""SELECT bucket, {R('sum(w*score_a)/sum(w)', 6)} AS predicted, {R('sum(w*y)/sum(w)', 6)} AS observed, count(*) AS n FROM
 (SELECT *, CAST(len(list_filter(edges, lambda x: x < score_a)) AS INTEGER) AS bucket FROM scored,
 (SELECT list_distinct(quantile_cont(score_a, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9])) AS edges FROM scored)) GROUP BY bucket"""))
def decile_calibration(spark, sf):
    return rounded(M.decile_calibration(scored(spark, sf), "y", "score_a", "w"), 6)


@query("missingness_auc", sql(f"SELECT variable, n_missing, {R('auc_missing', 6)} AS auc_missing FROM ({_missing_sql('leaky', ['price', 'shortcut', 'school'], 'CAST(1 AS DOUBLE)')})", leaky=_LEAK))
def missingness_auc(spark, sf):
    return rounded(M.missingness_auc(_leak_frame(spark, sf), ["price", "shortcut", "school"], "y"), 6)


@query("bias_corrected_risk", sql(f"""SELECT {R('avg(risk)', 6)} AS mean_risk, {R('avg((1 - risk - hit)*(1 - risk - hit))', 6)} AS brier FROM (
 SELECT CAST(u.y >= u.target_pct AS INTEGER) AS hit, (SELECT count(*) FROM predictions r WHERE r.residual <= u.target_pct - (u.pred - 2.5))::DOUBLE/(SELECT count(*) FROM predictions) AS risk
 FROM predictions u WHERE u.target_pct IS NOT NULL AND u.y IS NOT NULL)"""))
def bias_corrected_risk(spark, sf):
    p = predictions(spark, sf)
    moved = M.bias_corrected(p.filter("target_pct is not null and y is not null"), "pred", 2.5)
    risk = M.risk_of_missing(moved, "pred", "target_pct", p, "residual", ["area_id", "year"])
    ready = risk.select("risk", (1 - F.col("risk")).alias("p"), (F.col("y") >= F.col("target_pct")).cast("int").alias("hit"))
    mean = ready.agg(F.avg("risk")).scalar()
    return rounded(M.brier(ready, "hit", "p").withColumn("mean_risk", mean), 6)


_HITS = "SELECT p.*, CAST(y >= target_pct AS INTEGER) AS hit, y - target_pct + residual AS s, state FROM predictions p JOIN areas USING (area_id) WHERE target_pct IS NOT NULL AND y IS NOT NULL"


@query("error_by_state_with_total", sql(f"""SELECT state, n, {R('mae', 4)} AS mae, {R('bias', 4)} AS bias, {R('auc', 4)} AS auc FROM
 (SELECT coalesce(state, 'TOTAL') AS state, count(*) AS n, avg(abs(pred-y)) AS mae, avg(pred-y) AS bias FROM hits GROUP BY GROUPING SETS ((state), ()))
 LEFT JOIN (SELECT state, auc FROM ({ranked('hits', 'hit', 's', by='state')}) UNION ALL SELECT 'TOTAL', auc FROM ({ranked('hits', 'hit', 's')})) USING (state)""", hits=_HITS))
def error_by_state_with_total(spark, sf):
    df = predictions(spark, sf).join(areas(spark, sf).select("area_id", "state"), "area_id").filter("target_pct is not null and y is not null")
    df = df.withColumn("hit", (F.col("y") >= F.col("target_pct")).cast("int")).withColumn("s", F.col("y") - F.col("target_pct") + F.col("residual"))
    return rounded(M.error_by_state(df, "state", "y", "pred", "hit", "s"), 4)


# ---- sampling and resampling ---------------------------------------------------------------------


@query("stratified_sample", sql(f"""SELECT person_id, y FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {H(42, 'person_id')}, person_id) AS rn,
 count(*) OVER (PARTITION BY y) AS n FROM scored) WHERE rn <= round_even(n*CAST(0.1 AS DOUBLE), 0)"""))
def stratified_sample(spark, sf):
    return RS.stratified_sample(scored(spark, sf), 0.1, "y", ["person_id"]).select("person_id", "y")


def _fold_sql(rate: str) -> str:
    return f"""SELECT area_id, CAST((row_number() OVER (PARTITION BY band ORDER BY h, area_id) - 1 + band) % 5 AS INTEGER) AS fold FROM
 (SELECT *, least(9, floor(rate*10))::BIGINT AS band FROM (SELECT area_id, {rate} AS rate, {H(42, 'area_id')} AS h FROM scored GROUP BY area_id))"""


@query("group_folds", sql(f"SELECT fold, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, count(DISTINCT area_id) AS n_areas FROM scored JOIN ({_fold_sql('avg(y)')}) USING (area_id) GROUP BY fold"))
def group_folds(spark, sf):
    out = RS.group_folds(scored(spark, sf), "area_id", 5, "y")
    return out.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("n_pos"), F.count_distinct("area_id").alias("n_areas"))


@query("group_folds_regression", sql(_fold_sql("0.0")))
def group_folds_regression(spark, sf):
    return RS.group_fold_table(scored(spark, sf), "area_id", 5)


_NATION_FOLDS = f"""SELECT state, CAST((row_number() OVER (PARTITION BY band ORDER BY h, state) - 1 + band) % 5 AS INTEGER) AS fold FROM
 (SELECT *, least(9, floor(rate*10))::BIGINT AS band FROM (SELECT state, avg(y) AS rate, {H(42, 'state')} AS h FROM scored JOIN areas USING (area_id) GROUP BY state))"""


@query("group_folds_by_state", sql(_NATION_FOLDS))
def group_folds_by_state(spark, sf):
    df = scored(spark, sf).join(areas(spark, sf).select("area_id", "state"), "area_id")
    return RS.group_fold_table(df, "state", 5, "y")


def _shuffle_sql(value: str, part: str) -> str:
    over = lambda seed: f"row_number() OVER ({part} ORDER BY {H(seed, 'person_id')}, person_id)"
    key = "area_id, " if part else ""
    using = "(area_id, pos)" if part else "(pos)"
    return f"""SELECT person_id, shuffled FROM (SELECT {key}person_id, {over('42r')} AS pos FROM scored)
 JOIN (SELECT {key}{value} AS shuffled, {over('42g')} AS pos FROM scored) USING {using}"""


@query("shuffle_within_group", sql(_shuffle_sql("y", "PARTITION BY area_id")))
def shuffle_within_group(spark, sf):
    return RS.shuffled(scored(spark, sf).select("person_id", "area_id", "y"), "y", ["person_id"], ["area_id"]).select("person_id", "shuffled")


@query("shuffle_global", sql(_shuffle_sql("y", "")))
def shuffle_global(spark, sf):
    return RS.shuffled(scored(spark, sf).select("person_id", "y"), "y", ["person_id"]).select("person_id", "shuffled")


def _draws(reps: int) -> str:
    return f"""SELECT rep, g.area_id, count(*) AS times FROM (SELECT rep, slot, n, ({H(42, 'rep', 'slot')}) % n AS picked
 FROM slots CROSS JOIN (SELECT unnest(range({reps})) AS rep)) d JOIN slots g ON g.slot = d.picked GROUP BY 1, 2"""


_SLOTS = f"SELECT area_id, row_number() OVER (ORDER BY {H(42, 'area_id')}, area_id) - 1 AS slot, count(*) OVER () AS n FROM (SELECT DISTINCT area_id FROM scored)"
_REPS = 40


def _reps_sql(score: str) -> str:
    return ranked("resampled", "y", score, "wt", "rep")


_RESAMPLED = "SELECT rep, y, score_a, score_b, w*times AS wt FROM scored JOIN draws USING (area_id)"


@query("cluster_draws", sql("SELECT rep, area_id, times FROM draws", slots=_SLOTS, draws=_draws(_REPS)))
def cluster_draws(spark, sf):
    return RS.cluster_draws(scored(spark, sf), "area_id", _REPS)


@query("cluster_bootstrap", sql(f"""SELECT {R('(SELECT auc FROM (' + ranked('scored', 'y', 'score_a', 'w') + '))', 6)} AS estimate, {R('quantile_cont(auc, 0.025)', 6)} AS low,
 {R('quantile_cont(auc, 0.975)', 6)} AS high, {R('stddev_samp(auc)', 6)} AS deviation, {_REPS} AS resamples FROM ({_reps_sql('score_a')})""",
    slots=_SLOTS, draws=_draws(_REPS), resampled=_RESAMPLED))
def cluster_bootstrap(spark, sf):
    return rounded(RS.cluster_bootstrap(scored(spark, sf), "y", "score_a", "area_id", "auc", _REPS, "w"), 6)


@query("cluster_bootstrap_brier", sql(f"""SELECT {R('(SELECT sum(w*(score_a-y)*(score_a-y))/sum(w) FROM scored)', 6)} AS estimate, {R('quantile_cont(v, 0.025)', 6)} AS low,
 {R('quantile_cont(v, 0.975)', 6)} AS high, {R('stddev_samp(v)', 6)} AS deviation, {_REPS} AS resamples FROM (SELECT rep, sum(wt*(score_a-y)*(score_a-y))/sum(wt) AS v FROM resampled GROUP BY rep)""",
    slots=_SLOTS, draws=_draws(_REPS), resampled=_RESAMPLED))
def cluster_bootstrap_brier(spark, sf):
    return rounded(RS.cluster_bootstrap(scored(spark, sf), "y", "score_a", "area_id", "brier", _REPS, "w"), 6)


@query("paired_bootstrap", sql(f"""SELECT {R('max(ma)', 6)} AS metric_a, {R('max(mb)', 6)} AS metric_b, {R('max(ma - mb)', 6)} AS difference, {R('quantile_cont(d, 0.0125)', 6)} AS low,
 {R('quantile_cont(d, 0.9875)', 6)} AS high, {_REPS} AS resamples FROM (SELECT a.auc - b.auc AS d FROM ({_reps_sql('score_a')}) a JOIN ({_reps_sql('score_b')}) b USING (rep)),
 (SELECT auc AS ma FROM ({ranked('scored', 'y', 'score_a', 'w')})), (SELECT auc AS mb FROM ({ranked('scored', 'y', 'score_b', 'w')}))""",
    slots=_SLOTS, draws=_draws(_REPS), resampled=_RESAMPLED))
def paired_bootstrap(spark, sf):
    return rounded(RS.paired_bootstrap(scored(spark, sf), "y", "score_a", "score_b", "area_id", "auc", _REPS, "w", level=0.975), 6)


_STABLE = f"""SELECT u.area_id, u.year, {R('share', 6)} AS share, CASE WHEN share >= 0.95 THEN 'core' WHEN share <= 0.05 THEN 'out' WHEN share IS NOT NULL THEN 'fringe' END AS class FROM
 (SELECT area_id, year, CASE WHEN target_pct - pred IS NOT NULL THEN (SELECT count(*) FROM thresholds t WHERE t.v <= target_pct - pred)::DOUBLE/500 END AS share FROM predictions) u"""
_STABLE_PARTS = {
    "slots": f"SELECT residual AS v, row_number() OVER (ORDER BY {H(42, 'area_id', 'year')}, area_id, year) - 1 AS slot, count(*) OVER () AS n FROM predictions",
    "thresholds": f"""SELECT v FROM (SELECT rep, v, row_number() OVER (PARTITION BY rep ORDER BY v) AS rn, n FROM
 (SELECT rep, d.n, g.v FROM (SELECT rep, n, ({H(42, 'rep', 'slot')}) % n AS picked FROM slots CROSS JOIN (SELECT unnest(range(500)) AS rep)) d JOIN slots g ON g.slot = d.picked)) WHERE rn = ceil(n/2.0)""",
}


@query("list_stability", sql(_STABLE, **_STABLE_PARTS))
def list_stability(spark, sf):
    p = predictions(spark, sf)
    out = RS.list_stability(p, "pred", "target_pct", p, "residual", ["area_id", "year"], ["area_id", "year"])
    return rounded(out.select("area_id", "year", "share", "class"), 6)


@query("residual_smear", sql(f"SELECT area_id, year, {R('residual + (k*0.25::DOUBLE - 2.5)', 6)} AS residual, {R('k*0.25::DOUBLE - 2.5', 6)} AS shift FROM predictions CROSS JOIN (SELECT unnest(range(21)) AS k)"))
def residual_smear(spark, sf):
    return rounded(RS.residual_smear(predictions(spark, sf).select("area_id", "year", "residual"), "residual", 2.5), 6)
