"""Sources, editions, Gold tables, point-in-time features and sinks.

Source queries write the test tables in the layout of the published files and read them back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.scalars import round_even
from ..operators import editions as E
from ..operators import indicator as I
from ..operators import pit
from ..operators.joins import enriched
from ..plans.gold import gold_tables
from ..session import scratch_path, stored
from ..sources import delimited, integrity, records, sheets, sinks
from .base import YEARS, R, areas, fact, persons, results, sql, table, target_editions, targets
from .registry import query


def rounded(df, digits):
    return sinks.rounded(df, digits)


def text(c):
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def mean_of_hundredths(c):
    """Mean of figures with two decimals, summed as whole hundredths so that no order of rows changes it."""
    return F.sum(F.rint(F.col(c) * 100).cast("bigint")).cast("double") / F.count(c) / 100


# ---- delimited files -----------------------------------------------------------------------------


def person_file(spark, sf):
    """Person rows in the layout of the published file, as text; absent persons have '-' for a weight."""
    li = table(spark, sf, "lineitem")
    return li.select(
        text(F.year("l_shipdate")).alias("NU_ANO_AVALIACAO"), F.concat(F.lit("UF"), text(F.col("l_suppkey") % 25)).alias("SG_UF"),
        text("l_orderkey").alias("ID_ALUNO"), F.when(F.col("l_partkey") % 50 != 0, text("l_partkey")).alias("ID_ESCOLA"),
        F.when(F.col("l_linestatus") == "F", "2").otherwise("3").alias("TP_DEPENDENCIA"), text("l_suppkey").alias("CO_MUNICIPIO"),
        F.when(F.col("l_returnflag") != "R", "1").otherwise("0").alias("IN_PRESENCA_LP"),
        F.when(F.col("l_discount") > 0, "1").otherwise("0").alias("IN_PREENCHIMENTO_LP"),
        F.when(F.col("l_returnflag") != "R", text("l_quantity")).otherwise("-").alias("VL_PESO_ALUNO_LP"),
        text("l_extendedprice").alias("VL_PROFICIENCIA_LP"), F.when(F.col("l_extendedprice") >= 53000, "1").otherwise("0").alias("IN_ALFABETIZADO"),
        F.lit("x").alias("TX_RESPOSTAS"),
    )


@query("src_delimited_typed", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, 'UF' || (l_suppkey % 25) AS state, l_orderkey AS person_id,
 CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS school_id, CASE l_linestatus WHEN 'F' THEN 'estadual' ELSE 'municipal' END AS network, l_suppkey AS area_id,
 CAST(l_returnflag <> 'R' AS INTEGER) AS present, CAST(l_discount > 0 AS INTEGER) AS filled,
 CAST(CAST(CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS FLOAT) AS DOUBLE) AS weight, CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS score,
 CAST(l_extendedprice >= 53000 AS INTEGER) AS passed FROM lineitem""")
def src_delimited_typed(spark, sf):
    path = scratch_path(spark, "persons")
    person_file(spark, sf).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    out = delimited.read_persons(spark, path)
    return out.withColumn("weight", F.col("weight").cast("double")).withColumn("score", F.col("score").cast("double"))


_LEVELS = ", ".join(f"{R(f'CAST(100 AS DOUBLE)*count(*) FILTER (least(8, floor(l_extendedprice/12000)) = {k})/count(*)', 2)} AS level_{k}_pct" for k in range(9))


@query("src_area_aggregates", f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS area_id, 'Área ' || l_suppkey AS area_name, 'UF' AS state,
 CASE l_linestatus WHEN 'F' THEN 'estadual' ELSE 'municipal' END AS network, {R('CAST(100 AS DOUBLE)*count(*) FILTER (l_extendedprice >= 53000)/count(*)', 2)} AS indicator_pct,
 {R('avg(l_extendedprice)', 1)} AS mean_score, {_LEVELS} FROM lineitem GROUP BY 1, 2, l_linestatus""")
def src_area_aggregates(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("k", F.least(F.lit(8), F.floor(F.col("l_extendedprice") / 12000)))
    n = F.count("*")
    raw = li.groupBy(F.year("l_shipdate").alias("y"), "l_suppkey", "l_linestatus").agg(
        text(round_even(100.0 * F.count_if(F.col("l_extendedprice") >= 53000) / n, 2)).alias("PC_ALUNO_ALFABETIZADO"),
        text(round_even(F.avg("l_extendedprice"), 1)).alias("VL_MEDIA_LP"),
        *[text(round_even(100.0 * F.count_if(F.col("k") == k) / n, 2)).alias(f"PC_ALUNO_NIVEL_{k}_LP") for k in range(9)],
    )
    raw = raw.select(
        text("y").alias("NU_ANO_AVALIACAO"), text("l_suppkey").alias("CO_MUNICIPIO"), F.concat(F.lit("Área "), text("l_suppkey"), F.lit(" ")).alias("NO_MUNICIPIO"),
        F.lit("UF").alias("SG_UF"), F.when(F.col("l_linestatus") == "F", "2").otherwise("3").alias("ID_TIPO_REDE"), *[c for c in raw.columns if c[:2] in ("PC", "VL")],
    )
    path = scratch_path(spark, "aggregates")
    raw.write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    return delimited.area_aggregates(delimited.read_text_columns(spark, path))


# ---- sheets --------------------------------------------------------------------------------------


def result_sheet(spark, sf):
    """Area sheet of the year 2000: earlier results, a bare column for its own year, targets, and footer notes."""
    r, t = results(spark, sf), targets(spark, sf)
    wide = r.groupBy("area_id").pivot("year", [1998, 1999, 2000]).agg(F.first("indicator_pct"))
    own = r.filter("year = 2000").select("area_id", "level", "participation_pct")
    goals = t.groupBy("area_id").pivot("year", [2000, 2001]).agg(F.first("target_pct")).withColumnRenamed("2000", "t2000").withColumnRenamed("2001", "t2001")
    sheet = wide.join(own, "area_id", "left").join(goals, "area_id", "left").join(areas(spark, sf), "area_id", "left")

    def cell(c):
        return F.coalesce(text(c), F.lit("-"))

    rows = sheet.select(
        F.lit("2000").alias("ANO"), F.col("state").alias("SG_UF"), text("area_id").alias("CO_MUNICIPIO"), F.concat(F.col("area_name"), F.lit(" ")).alias("NO_MUNICIPIO"),
        F.lit(" MUNICIPAL").alias("NO_TP_REDE"), cell("1998").alias("PC_ALUNO_ALFABETIZADO_1998"), cell("1999").alias("PC_ALUNO_ALFABETIZADO_1999"),
        cell("2000").alias("PC_ALUNO_ALFABETIZADO"), cell("t2000").alias("META_FINAL_2000"),
        cell(F.when(F.col("t2001") < 40, F.lit(0.0)).otherwise(F.col("t2001"))).alias("META_FINAL_2001"),
        cell("level").alias("CO_NIVEL_ALFABETIZACAO"), cell("participation_pct").alias("PC_AVALIADOS_LP"),
    )
    notes = table(spark, sf, "region").select(F.lit("2000").alias("ANO"), F.concat(F.lit("(1) "), "r_name").alias("NO_MUNICIPIO"))
    return rows.unionByName(notes, allowMissingColumns=True)


@query("src_wide_results", sql("""SELECT r.area_id, state, area_name, 'municipal' AS network, y.year, x.indicator_pct, 2000 AS edition, CASE WHEN y.year = 2000 THEN CAST(x.level AS DOUBLE) END AS level,
 CASE WHEN y.year = 2000 THEN x.participation_pct END AS participation_pct FROM (SELECT DISTINCT area_id FROM results) r CROSS JOIN (SELECT unnest([1998, 1999, 2000]) AS year) y
 LEFT JOIN results x ON x.area_id = r.area_id AND x.year = y.year LEFT JOIN areas a ON a.area_id = r.area_id"""))
def src_wide_results(spark, sf):
    return sheets.wide_results(result_sheet(spark, sf), 2000)[0]


@query("src_wide_targets", sql("""SELECT r.area_id, y.year, CASE WHEN y.year = 2001 AND x.target_pct < 40 THEN NULL WHEN x.target_pct > 0 THEN x.target_pct END AS target_pct, 2000 AS edition
 FROM (SELECT DISTINCT area_id FROM results) r CROSS JOIN (SELECT unnest([2000, 2001]) AS year) y LEFT JOIN targets x ON x.area_id = r.area_id AND x.year = y.year"""))
def src_wide_targets(spark, sf):
    return sheets.wide_results(result_sheet(spark, sf), 2000)[1]


_MEAN = "CAST(sum(CAST(round_even(indicator_pct*100, 0) AS BIGINT)) AS DOUBLE)/count(indicator_pct)/100"
_STATE = f"""SELECT state, year, {R(_MEAN, 1)} AS v FROM results JOIN areas USING (area_id) GROUP BY GROUPING SETS ((state, year), (year))"""


def state_sheet(spark, sf):
    """State sheet of 2000: one row without a code for the country, a starred code, targets as '> 80'."""
    df = results(spark, sf).join(areas(spark, sf), "area_id")
    v = round_even(mean_of_hundredths("indicator_pct"), 1).alias("v")
    long = df.groupBy("state", "year").agg(v).unionByName(df.groupBy("year").agg(v).withColumn("state", F.lit(None).cast("string")))
    wide = long.groupBy("state").pivot("year", [1997, 1999, 2000]).agg(F.first("v"))
    star = F.when(F.col("state").endswith("3"), F.concat("state", F.lit("*"))).otherwise(F.col("state"))
    return wide.select(
        F.lit("2000").alias("ANO"), star.alias("SIGLA_UF"), F.concat(F.lit("Nome "), F.coalesce("state", F.lit("Brasil"))).alias("NOME_UF"),
        text("1997").alias("SAEB_1997"), text("1999").alias("PC_ALUNO_ALFABETIZADO_1999"), text("2000").alias("PC_ALUNO_ALFABETIZADO"),
        F.concat(F.lit("> "), text("2000")).alias("META_FINAL_2030"), F.lit("0").alias("META_FINAL_2029"),
    )


@query("src_wide_state", sql("""SELECT coalesce(s.state, 'BR') AS state, 'Nome ' || coalesce(s.state, 'Brasil') AS state_name, y.year, x.v AS indicator_pct,
 CASE WHEN y.year = 1997 THEN 'saeb' ELSE 'indicador' END AS source, 2000 AS edition FROM (SELECT DISTINCT state FROM st) s CROSS JOIN (SELECT unnest([1997, 1999, 2000]) AS year) y
 LEFT JOIN st x ON x.state IS NOT DISTINCT FROM s.state AND x.year = y.year""", st=_STATE))
def src_wide_state(spark, sf):
    return sheets.wide_state(state_sheet(spark, sf), 2000)[0]


@query("src_wide_state_targets", sql("""SELECT coalesce(s.state, 'BR') AS state, y.year, CASE WHEN y.year = 2029 THEN 0.0::DOUBLE ELSE x.v END AS target_pct, 2000 AS edition
 FROM (SELECT DISTINCT state FROM st) s CROSS JOIN (SELECT unnest([2029, 2030]) AS year) y LEFT JOIN st x ON x.state IS NOT DISTINCT FROM s.state AND x.year = 2000""", st=_STATE))
def src_wide_state_targets(spark, sf):
    return sheets.wide_state(state_sheet(spark, sf), 2000)[1]


def census_rows(spark, sf):
    """Census rows per area and stratum, in the published columns."""
    li = table(spark, sf, "lineitem").join(areas(spark, sf).select(F.col("area_id").alias("l_suppkey"), "state"), "l_suppkey")
    cells = F.array(F.struct(F.lit("Total").alias("c")), F.struct(F.when(F.col("l_linestatus") == "F", "Rural").otherwise("Urbana").alias("c")))
    ex = li.select("state", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", F.explode(cells).alias("s"))
    return ex.groupBy("state", "l_suppkey", F.col("s.c").alias("c"), (F.col("l_returnflag") == "A").alias("pub")).agg(
        round_even(F.avg("l_quantity"), 1).alias("a"), round_even(100 * F.avg("l_discount"), 1).alias("b")
    ).select(
        "state", F.lit("2024").alias("NU_ANO_CENSO"), text("l_suppkey").alias("CO_MUNICIPIO"), F.col("c").alias("NO_CATEGORIA"),
        F.when(F.col("pub"), "Pública").otherwise("Total").alias("NO_DEPENDENCIA"),
        F.when(F.col("a") < 24, "--").otherwise(text("a")).alias("FUN_AI_CAT_0"), text("b").alias("FUN_02_CAT_0"),
    )


_CENSUS = f"""SELECT 2024 AS year, l_suppkey AS area_id, CASE WHEN a >= 24 THEN a END AS distorcao_ai_pct, b AS distorcao_2ano_pct FROM
 (SELECT l_suppkey, {R('avg(l_quantity)', 1)} AS a, {R('100*avg(l_discount)', 1)} AS b FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)"""


@query("src_indicator_select", _CENSUS)
def src_indicator_select(spark, sf):
    return sheets.census_indicator(census_rows(spark, sf), sheets.CENSUS_COLUMNS["tdi"])


@query("src_header_sentinel", _CENSUS)
def src_header_sentinel(spark, sf):
    """One sheet per state: a title, the header, then the rows. Lines are ordered inside each file only."""
    rows = census_rows(spark, sf)
    names = [c for c in rows.columns if c != "state"]
    body = rows.select("state", F.lit(2).alias("o"), F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in names]).alias("value"))
    head = rows.select("state").distinct().select(
        "state", F.explode(F.array(F.struct(F.lit(0).alias("o"), F.concat(F.lit("Indicador por área;"), "state").alias("value")),
                                   F.struct(F.lit(1).alias("o"), F.lit(";".join(names)).alias("value")))).alias("e")).select("state", "e.*")
    path = scratch_path(spark, "sheets")
    lines = body.unionByName(head).repartition("state").sortWithinPartitions("state", "o")
    lines.select("state", "value").write.partitionBy("state").text(path)
    raw = sheets.read_headed(spark, path, "NU_ANO_CENSO")
    return sheets.census_indicator(raw, sheets.CENSUS_COLUMNS["tdi"])


@query("src_panel_unpivot", """SELECT c.area_id, y.year, a.v AS ideb, CASE WHEN y.year <> 1998 THEN a.n END AS nota_lp, CAST(NULL AS DOUBLE) AS nota_mt, CAST(NULL AS DOUBLE) AS rendimento
 FROM (SELECT DISTINCT o_custkey AS area_id FROM orders) c CROSS JOIN (SELECT unnest([1996, 1998, 2000]) AS year) y LEFT JOIN
 (SELECT o_custkey AS area_id, year(o_orderdate) AS year, round_even(avg(o_totalprice), 0) + 0.0::DOUBLE AS v, count(*)::DOUBLE AS n FROM orders GROUP BY 1, 2) a
 ON a.area_id = c.area_id AND a.year = y.year""")
def src_panel_unpivot(spark, sf):
    o = table(spark, sf, "orders")
    wide = o.groupBy("o_custkey").agg(*[
        f(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))).alias(n)
        for y in (1996, 1998, 2000) for n, f in ((f"v{y}", F.avg), (f"n{y}", F.count))
    ])
    raw = wide.select(
        F.lit("Pública").alias("REDE"), text("o_custkey").alias("CO_MUNICIPIO"),
        *[F.coalesce(text(round_even(f"v{y}")), F.lit("-")).alias(f"VL_OBSERVADO_{y}") for y in (1996, 1998, 2000)],
        *[F.when(F.col(f"n{y}") > 0, text(f"n{y}")).alias(f"VL_NOTA_PORTUGUES_{y}") for y in (1996, 2000)],
    )
    return sheets.panel_long(raw)


@query("src_stratum_widen", f"""SELECT l_suppkey AS area_id, CAST(l_suppkey % 10 = 1 AS INTEGER) AS capital, {R('avg(l_quantity)', 2)} AS social_mean, count(*)::DOUBLE AS social_persons,
 {R('CAST(100 AS DOUBLE)*count(*) FILTER (l_linestatus = $$F$$)/count(*)', 6)} AS rural_pct,
 {R('avg(l_discount)', 4)} + {R('avg(l_tax)', 4)} AS social_low_pct, {R('avg(l_tax)', 4)}*2 AS social_high_pct FROM lineitem GROUP BY 1""")
def src_stratum_widen(spark, sf):
    li = table(spark, sf, "lineitem")
    places = F.when(F.col("l_linestatus") == "F", F.array(F.lit("0"), F.lit("2"))).otherwise(F.array(F.lit("0"), F.lit("1")))
    g = li.select("l_suppkey", "l_quantity", "l_discount", "l_tax", F.explode(places).alias("TP_LOCALIZACAO")).groupBy("l_suppkey", "TP_LOCALIZACAO").agg(
        round_even(F.avg("l_quantity"), 2).alias("q"), F.count("*").alias("n"), round_even(F.avg("l_discount"), 4).alias("d"), round_even(F.avg("l_tax"), 4).alias("t"))
    raw = g.select(
        F.lit("6").alias("TP_TIPO_REDE"), "TP_LOCALIZACAO", text("l_suppkey").alias("CO_MUNICIPIO"), F.when(F.col("l_suppkey") % 10 == 1, "1").otherwise("2").alias("TP_CAPITAL"),
        text("q").alias("MEDIA_INSE"), text("n").alias("QTD_ALUNOS_INSE"), text("d").alias("PC_NIVEL_1"), text("t").alias("PC_NIVEL_2"),
        *[F.lit("-").alias(f"PC_NIVEL_{k}") for k in (3, 4, 5, 6)], text("t").alias("PC_NIVEL_7"), text("t").alias("PC_NIVEL_8"),
    )
    return delimited.social_level(raw).withColumn("rural_pct", round_even("rural_pct", 6))


# ---- records, geometry, digests ------------------------------------------------------------------

_CODES = {"click": "clicks", "view": "views", "error": "errors"}


@query("src_eav_pivot", "SELECT user_id AS area_id, CAST(month(ts) AS INTEGER) AS year, " + ", ".join(
    f"arg_min(value, event_id) FILTER (event_type = '{c}' AND value >= 5) AS {n}" for c, n in _CODES.items())
    + " FROM events WHERE event_type IN ('click', 'view', 'error') GROUP BY 1, 2")
def src_eav_pivot(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select(
        text("user_id").alias("D1C"), F.col("event_type").alias("D2C"), text(F.month("ts")).alias("D3C"),
        F.when(F.col("value") < 5, "...").otherwise(text("value")).alias("V"), F.col("event_id").alias("SEQ"),
    )
    header = table(spark, sf, "region").limit(1).select(
        F.lit("Código").alias("D1C"), F.lit("Variável").alias("D2C"), F.lit("Ano").alias("D3C"), F.lit("Valor").alias("V"), F.lit(-1).cast("bigint").alias("SEQ"))
    path = scratch_path(spark, "records")
    header.unionByName(rows).write.json(path)
    back = spark.read.schema("D1C string, D2C string, D3C string, V string, SEQ bigint").json(path)
    return records.eav_pivot(back, _CODES, order_by="SEQ")


@query("src_geojson_rings", """SELECT s_suppkey AS area_id, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS n_rings,
 CAST(4 AS INTEGER) AS n_points, s_acctbal AS first_x, s_acctbal + 1 AS second_x FROM supplier""")
def src_geojson_rings(spark, sf):
    """Suppliers as squares, one collection per state; odd ones have two parts and a hole in the first."""
    s = table(spark, sf, "supplier")
    x0, x1 = text("s_acctbal"), text(F.col("s_acctbal") + 1)
    ring = F.concat(F.lit("[["), x0, F.lit(",0.0],["), x1, F.lit(",0.0],["), x1, F.lit(",1.0],["), x0, F.lit(",0.0]]"))
    hole = F.lit("[[0.1,0.1],[0.2,0.1],[0.2,0.2]]")
    even = F.col("s_suppkey") % 2 == 0
    coords = F.when(even, F.concat(F.lit("["), ring, F.lit("]"))).otherwise(F.concat(F.lit("[["), ring, F.lit(","), hole, F.lit("],["), ring, F.lit("]]")))
    kind = F.when(even, "Polygon").otherwise("MultiPolygon")
    feature = F.concat(F.lit('{"type":"Feature","properties":{"codarea":"'), text("s_suppkey"), F.lit('"},"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}"))
    lines = s.select("s_nationkey", feature.alias("f")).groupBy("s_nationkey").agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("f"), ","), F.lit("]}")).alias("value"))
    path = scratch_path(spark, "mesh")
    lines.select("value").write.text(path)
    r = records.exterior_rings(spark, path, multi_line=False)
    return r.select("area_id", F.size("rings").alias("n_rings"), F.size(F.get("rings", F.lit(0))).alias("n_points"),
                    F.expr("rings[0][0][0]").alias("first_x"), F.expr("rings[0][1][0]").alias("second_x"))


@query("src_integrity", """SELECT part, md5, sha256, bytes, CASE WHEN part % 7 = 0 THEN 'diverges' WHEN part % 5 = 0 THEN 'unlisted' WHEN part % 3 = 0 THEN 'drifted' ELSE 'ok' END AS status FROM
 (SELECT part, md5(t) AS md5, sha256(t) AS sha256, CAST(strlen(t) AS BIGINT) AS bytes FROM (SELECT c_custkey // 500 AS part, string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10) AS t FROM customer GROUP BY 1))
 UNION ALL SELECT -1, NULL, NULL, NULL, 'absent' FROM (SELECT count(*) FROM customer)""")
def src_integrity(spark, sf):
    """Customer names in files of 500; some list entries are wrong, some files are new, some have changed."""
    c = table(spark, sf, "customer").select(F.floor(F.col("c_custkey") / 500).alias("part"), "c_custkey", "c_name")
    path = scratch_path(spark, "files")
    c.repartition("part").sortWithinPartitions("part", "c_custkey").select("part", F.col("c_name").alias("value")).write.partitionBy("part").text(path)
    found = integrity.file_digests(spark, path, "*.txt")
    named = found.withColumn("part", F.regexp_extract("path", r"part=(\d+)", 1).cast("bigint")).drop("path")
    # A file name can repeat between folders, so folder and name identify it.
    named = named.withColumn("name", F.concat_ws("-", "part", "name"))
    listed = named.select(F.concat(F.when(F.col("part") % 7 == 0, F.md5(F.lit("other"))).otherwise(F.col("md5")), F.lit("  *"), F.col("name")).alias("value"))
    list_path = scratch_path(spark, "md5-list")
    listed.write.text(list_path)
    manifest = named.filter(F.col("part") % 5 != 0).select(
        "name", F.when(F.col("part") % 3 == 0, F.sha2(F.lit("old"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    manifest = manifest.unionByName(table(spark, sf, "customer").agg(F.count("*")).select(F.lit("-1-gone").alias("name"), F.lit("0").alias("sha256")))
    report = integrity.integrity_report(named.drop("part"), integrity.published_md5(spark, list_path), manifest)
    return report.select(F.regexp_extract("name", r"^(-?\d+)-", 1).cast("bigint").alias("part"), "md5", "sha256", "bytes", "status")


# ---- sinks ---------------------------------------------------------------------------------------


@query("sink_tables", sql("SELECT * FROM fact"))
def sink_tables(spark, sf):
    folder = scratch_path(spark, "gold")
    sinks.write_tables({"fact": (fact(spark, sf), ["year", "area_id", "network"])}, folder)
    return spark.read.parquet(f"{folder}/fact")


@query("sink_reports", sql(f"SELECT area_id, year, {R('indicator_pct', 1)} AS indicator_pct, {R('participation_pct', 1)} AS participation_pct FROM results"))
def sink_reports(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_report(results(spark, sf).select("area_id", "year", "indicator_pct", "participation_pct"), path, 1)
    return spark.read.csv(path, header=True, schema="area_id bigint, year int, indicator_pct double, participation_pct double")


# ---- editions ------------------------------------------------------------------------------------

_CLOSEST = """SELECT unit_id, year, target_pct, edition FROM (SELECT unit_id, year, target_pct, edition + 1997 AS edition,
 row_number() OVER (PARTITION BY unit_id, year ORDER BY abs(edition + 1997 - year), edition) AS rn FROM editions {where}) WHERE rn = 1"""


def _dated(spark, sf):
    return target_editions(spark, sf).withColumn("edition", F.col("edition") + 1997)


@query("dedupe_by_priority", sql(_CLOSEST.format(where="")))
def dedupe_by_priority(spark, sf):
    return E.closest_edition(_dated(spark, sf), ["unit_id", "year"])


@query("dedupe_by_priority_known", sql(_CLOSEST.format(where="WHERE target_pct IS NOT NULL")))
def dedupe_by_priority_known(spark, sf):
    return E.closest_edition(_dated(spark, sf), ["unit_id", "year"], value="target_pct", drop_null_first=True)


@query("keep_first", """SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1""")
def keep_first(spark, sf):
    return E.first_by(table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("keep_last", sql("SELECT unit_id, year, arg_max(coalesce(target_pct, -1), edition) AS v, max(edition) AS edition FROM editions GROUP BY 1, 2"))
def keep_last(spark, sf):
    df = target_editions(spark, sf).select("unit_id", "year", F.coalesce("target_pct", F.lit(-1.0)).alias("v"), "edition")
    return E.latest_edition(df, ["unit_id", "year"])


_CONSOLIDATE = """SELECT unit_id, year, coalesce(p.target_pct, b.target_pct) AS target_pct, coalesce(p.edition, b.edition) AS edition FROM bases b LEFT JOIN finer p USING (unit_id, year)
 UNION ALL SELECT unit_id, year, target_pct, edition FROM (SELECT *, row_number() OVER (PARTITION BY unit_id, year ORDER BY edition DESC) AS rn FROM filled WHERE unit_id NOT IN (SELECT unit_id FROM chosen)) WHERE rn = 1"""
_CONSOLIDATE_PARTS = {
    "filled": "SELECT * FROM editions WHERE target_pct IS NOT NULL",
    "chosen": "SELECT unit_id, max(edition) AS base FROM (SELECT unit_id, edition FROM filled GROUP BY 1, 2 HAVING count(DISTINCT year) = (SELECT count(DISTINCT year) FROM filled)) GROUP BY 1",
    "bases": "SELECT f.* FROM filled f JOIN chosen c ON c.unit_id = f.unit_id AND c.base = f.edition",
    "older": "SELECT f.*, round_even(f.target_pct, 0) = round_even(b.target_pct, 0) AS same FROM filled f JOIN bases b USING (unit_id, year) WHERE f.edition < b.edition",
    "winner": "SELECT unit_id, min(edition) AS edition FROM (SELECT unit_id, edition FROM older GROUP BY 1, 2 HAVING bool_and(same) AND count(DISTINCT year) = (SELECT count(DISTINCT year) FROM filled)) GROUP BY 1",
    "finer": "SELECT o.* FROM older o JOIN winner w USING (unit_id, edition)",
}


@query("consolidate_targets", sql(_CONSOLIDATE, **_CONSOLIDATE_PARTS))
def consolidate_targets(spark, sf):
    return E.consolidate_targets(stored(target_editions(spark, sf), "editions"))


@query("targets_long", sql(f"SELECT unit_id, year, target_pct FROM ({_CONSOLIDATE})", **_CONSOLIDATE_PARTS))
def targets_long(spark, sf):
    return E.targets_long(E.consolidate_targets(stored(target_editions(spark, sf), "editions")))


@query("edition_tables", sql(f"SELECT c.unit_id, c.year, coalesce(CASE WHEN c.year IN (1999, 2000) THEN x.v END, c.target_pct) AS indicator_pct, c.edition FROM ({_CLOSEST.format(where='')}) c"
    " LEFT JOIN (SELECT area_id AS unit_id, year, indicator_pct AS v FROM ind_network WHERE network = 'municipal') x USING (unit_id, year)"))
def edition_tables(spark, sf):
    published = _dated(spark, sf).withColumnRenamed("target_pct", "indicator_pct")
    exact = fact(spark, sf).filter("network = 'municipal'").select(F.col("area_id").alias("unit_id"), "year", "indicator_pct")
    return E.edition_tables(published, target_editions(spark, sf), "unit_id", ["unit_id", "year"], exact, [1999, 2000])[0]


@query("asof_edition", """SELECT o_custkey, ask AS year, coalesce((SELECT max(e) FROM ed WHERE ed.o_custkey = r.o_custkey AND e <= ask), (SELECT min(e) FROM ed WHERE ed.o_custkey = r.o_custkey)) AS ref_edition
 FROM (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ask FROM orders) r""".replace("SELECT o_custkey, ask", "WITH ed AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS e FROM orders WHERE o_orderstatus = 'F') SELECT o_custkey, ask", 1))
def asof_edition(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    given = o.filter("o_orderstatus = 'F'").withColumnRenamed("year", "edition")
    return E.asof_edition(o, given, "year", by=["o_custkey"])


# ---- Gold ----------------------------------------------------------------------------------------


@query("mart_indicator", sql("SELECT * FROM mart"))
def mart_indicator(spark, sf):
    return I.area_mart(results(spark, sf), targets(spark, sf), areas(spark, sf), fact(spark, sf), "municipal")


_SR = f"""SELECT state, 'indicador' AS source, year, {R(_MEAN, 2)} AS indicator_pct FROM results JOIN areas USING (area_id) GROUP BY state, year"""


def _state_results(spark, sf):
    df = results(spark, sf).join(areas(spark, sf), "area_id").groupBy("state", "year").agg(round_even(mean_of_hundredths("indicator_pct"), 2).alias("indicator_pct"))
    return df.withColumn("source", F.lit("indicador"))


@query("mart_state", sql(f"""SELECT s.state, s.source, s.year, s.indicator_pct, t.target_pct, CASE WHEN t.target_pct IS NULL THEN NULL ELSE coalesce(s.indicator_pct >= t.target_pct, false) END AS hit,
 {R('s.indicator_pct - t.target_pct', 1)} AS gap FROM sr s LEFT JOIN (SELECT state, year + 1 AS year, indicator_pct + 1 AS target_pct FROM sr) t USING (state, year)""", sr=_SR))
def mart_state(spark, sf):
    r = _state_results(spark, sf)
    t = r.select("state", (F.col("year") + 1).alias("year"), (F.col("indicator_pct") + 1).alias("target_pct"))
    return I.state_mart(r, t)


@query("dim_area", """SELECT area_id, CASE WHEN a IS NULL THEN lower(s_name) ELSE s_name END AS area_name, n_name AS state, area_id // 100000 AS state_id, lower(n_name) AS state_name,
 CASE area_id // 1000000 WHEN 1 THEN 'Norte' WHEN 2 THEN 'Nordeste' WHEN 3 THEN 'Sudeste' WHEN 4 THEN 'Sul' WHEN 5 THEN 'Centro-Oeste' END AS region
 FROM (SELECT (10*(1 + s_nationkey % 5) + s_nationkey // 5)*100000::BIGINT + s_suppkey AS area_id, s_name, s_nationkey, CASE WHEN s_acctbal > 0 THEN 1 END AS a FROM supplier) JOIN nation ON n_nationkey = s_nationkey""")
def dim_area(spark, sf):
    """First source: suppliers in credit. Second source: all, named in lower case."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    code = (10 * (1 + F.col("s_nationkey") % 5) + F.floor(F.col("s_nationkey") / 5)) * 100000 + F.col("s_suppkey")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(code.cast("bigint").alias("area_id"), "s_name", "s_acctbal", F.col("n_name").alias("state"))
    first = j.filter("s_acctbal > 0").select("area_id", F.col("s_name").alias("area_name"), "state", F.lit(0).alias("source_rank"))
    second = j.select("area_id", F.lower("s_name").alias("area_name"), "state", F.lit(1).alias("source_rank"))
    names = n.select(F.col("n_name").alias("state"), F.lower("n_name").alias("state_name"))
    return I.area_dimension(first.unionByName(second), names)


@query("person_fact", sql("SELECT person_id, year, CASE WHEN present = 1 THEN network END AS network FROM persons"))
def person_fact(spark, sf):
    p = persons(spark, sf).select("person_id", "year", F.when(F.col("present") == 1, F.col("network")).otherwise("nan").alias("network"))
    return delimited.person_fact(*[p.filter(F.col("year") == y) for y in YEARS])


@query("gold_run", sql("""SELECT 'fact' AS "table", count(*) AS n_rows FROM fact UNION ALL SELECT 'mart', count(*) FROM mart UNION ALL SELECT 'evolution', count(*) FROM mart
 UNION ALL SELECT 'areas', count(*) FROM areas UNION ALL SELECT 'persons', count(*) FROM persons UNION ALL SELECT 'targets', count(*) FROM targets"""))
def gold_run(spark, sf):
    out = gold_tables(persons(spark, sf), areas(spark, sf), results(spark, sf), targets(spark, sf), "municipal")
    return reduce(lambda a, b: a.unionByName(b), [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in out.items()
    ])


@query("evolution", sql(f"SELECT *, {R('indicator_pct - previous', 1)} AS change FROM (SELECT year, area_id, area_name, state, region, indicator_pct, lag(indicator_pct) OVER (PARTITION BY area_id ORDER BY year) AS previous FROM mart)"))
def evolution(spark, sf):
    return I.evolution(mart_indicator(spark, sf))


# ---- point-in-time features ----------------------------------------------------------------------

_T = [1999, 2000, 2001, 2002]

_HISTORY = """SELECT u.target_year, u.area_id, a.indicator_pct AS indicator_t1, a.level AS level_t1, a.participation_pct AS participation_t1, b.indicator_pct AS indicator_t2,
 a.indicator_pct - b.indicator_pct AS change_t1, g.target_pct AS target_t1, a.indicator_pct - g.target_pct AS gap_t1, t.target_pct AS target_t, t.target_pct - a.indicator_pct AS required_jump,
 c.indicator_pct AS indicator_t, c.hit AS hit_t, c.gap AS gap_t FROM
 (SELECT area_id, y AS target_year FROM mart CROSS JOIN (SELECT unnest([1999, 2000, 2001, 2002])::INTEGER AS y) WHERE year IN (y, y - 1) UNION SELECT area_id, year FROM targets WHERE year >= 1999) u
 LEFT JOIN mart a ON a.area_id = u.area_id AND a.year = u.target_year - 1 LEFT JOIN mart b ON b.area_id = u.area_id AND b.year = u.target_year - 2
 LEFT JOIN mart c ON c.area_id = u.area_id AND c.year = u.target_year LEFT JOIN targets t ON t.area_id = u.area_id AND t.year = u.target_year
 LEFT JOIN targets g ON g.area_id = u.area_id AND g.year = u.target_year - 1"""


def _history(spark, sf):
    """Features start from stored Gold tables."""
    mart, goals = stored(mart_indicator(spark, sf), "mart"), stored(targets(spark, sf), "targets")
    return pit.history_block(mart, goals, _T)


@query("block_history", sql("SELECT * FROM hist", hist=_HISTORY))
def block_history(spark, sf):
    return _history(spark, sf)


def _panel(spark, sf):
    o = table(spark, sf, "orders").filter(F.year("o_orderdate") <= 2001)
    v = round_even(F.avg("o_totalprice") / 1000, 2)
    return o.groupBy(F.col("o_custkey").alias("area_id"), F.year("o_orderdate").alias("year")).agg(
        F.when(F.count("*") > 1, v).alias("ideb"), F.count("*").cast("double").alias("nota_lp"))


_PANEL = f"""SELECT o_custkey AS area_id, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN count(*) > 1 THEN {R('avg(o_totalprice)/1000', 2)} END AS ideb, count(*)::DOUBLE AS nota_lp
 FROM orders WHERE year(o_orderdate) <= 2001 GROUP BY 1, 2"""
_PB = f"""SELECT area_id, target_year, max(ideb) FILTER (rn = 1) AS ideb_last, max(nota_lp) FILTER (rn = 1) AS nota_lp_last, max(year) FILTER (rn = 1) AS ref_panel, max(ideb) FILTER (rn = 2) AS ideb_previous,
 {R('CASE WHEN count(ideb) FILTER (rn <= 5) >= 3 THEN regr_slope(ideb, year/2.0) FILTER (rn <= 5) END', 6)} AS ideb_trend, max(ideb) FILTER (rn = 1) - max(ideb) FILTER (rn = 2) AS ideb_change
 FROM (SELECT p.*, y AS target_year, row_number() OVER (PARTITION BY area_id, y ORDER BY year DESC) AS rn FROM panel p CROSS JOIN (SELECT unnest([1999, 2000, 2001, 2002])::INTEGER AS y) WHERE year < y)
 GROUP BY 1, 2"""


def _panel_block(spark, sf):
    out = pit.panel_block(_panel(spark, sf), _T, ["ideb", "nota_lp"], "ideb")
    return out.withColumn("ideb_trend", round_even("ideb_trend", 6))


@query("block_panel", sql("SELECT * FROM pb", panel=_PANEL, pb=_PB))
def block_panel(spark, sf):
    return _panel_block(spark, sf)


@query("latest_edition_value", sql("SELECT area_id, target_year, ideb_last, ideb_previous, ideb_change, ref_panel FROM pb", panel=_PANEL, pb=_PB))
def latest_edition_value(spark, sf):
    return _panel_block(spark, sf).select("area_id", "target_year", "ideb_last", "ideb_previous", "ideb_change", "ref_panel")


@query("trend_slope", sql("SELECT area_id, target_year, ideb_trend FROM pb", panel=_PANEL, pb=_PB))
def trend_slope(spark, sf):
    return _panel_block(spark, sf).select("area_id", "target_year", "ideb_trend")


_STATIC = f"""SELECT coalesce(c.area_id, s.area_id) AS area_id, population, gdp_thousands, {R('CASE WHEN population > 0 THEN CAST(1000 AS DOUBLE)*gdp_thousands/population END', 4)} AS gdp_per_head, social_mean
 FROM (SELECT c_custkey AS area_id, c_acctbal AS population, gdp_thousands FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*)::DOUBLE AS gdp_thousands FROM orders GROUP BY 1) USING (c_custkey)
  WHERE c_mktsegment <> 'HOUSEHOLD') c FULL JOIN (SELECT user_id AS area_id, {R('avg(value)', 4)} AS social_mean FROM events GROUP BY 1) s USING (area_id)"""


def _static(spark, sf):
    c = table(spark, sf, "customer").filter("c_mktsegment <> 'HOUSEHOLD'").select(F.col("c_custkey").alias("area_id"), F.col("c_acctbal").alias("population"))
    g = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("area_id")).agg(F.count("*").cast("double").alias("gdp_thousands"))
    s = table(spark, sf, "events").groupBy(F.col("user_id").alias("area_id")).agg(round_even(F.avg("value"), 4).alias("social_mean"))
    return pit.static_block(c, g, s).withColumn("gdp_per_head", round_even("gdp_per_head", 4))


@query("block_static", f"SELECT * FROM ({_STATIC})")
def block_static(spark, sf):
    return _static(spark, sf)


_EDITIONED = """SELECT y AS target_year, area_id, ref_census, distorcao FROM (SELECT y, CASE WHEN y - 1 >= 2000 THEN 2000 ELSE 1999 END AS ref_census FROM (SELECT unnest([1999, 2000, 2001, 2002])::INTEGER AS y))
 JOIN (SELECT area_id, year AS ref_census, participation_pct AS distorcao FROM results WHERE year IN (1999, 2000)) USING (ref_census)"""


def _editioned(spark, sf):
    years = results(spark, sf).select(F.explode(F.array(*[F.lit(y) for y in _T])).alias("target_year")).distinct()
    block = results(spark, sf).filter(F.col("year").isin(1999, 2000)).select("area_id", F.col("year").alias("edition"), F.col("participation_pct").alias("distorcao"))
    return pit.editioned_block(years, block, 1, "edition", "ref_census")


@query("block_editioned", sql(f"SELECT target_year, area_id, CAST(ref_census AS INTEGER) AS ref_census, distorcao FROM ({_EDITIONED})"))
def block_editioned(spark, sf):
    return _editioned(spark, sf)


_ABT = f"""SELECT h.*, a.area_name, a.state, a.state_id, a.state_name, a.region, CAST(e.ref_census AS INTEGER) AS ref_census, e.distorcao, ideb_last, nota_lp_last, ref_panel, ideb_previous, ideb_trend, ideb_change,
 population, gdp_thousands, gdp_per_head, social_mean, {R('ln(1 + population)', 6)} AS log_population
 FROM hist h JOIN areas a USING (area_id) LEFT JOIN ({_EDITIONED}) e USING (area_id, target_year) LEFT JOIN pb USING (area_id, target_year) LEFT JOIN (SELECT * REPLACE (CASE WHEN population > -1 THEN population END AS population) FROM ({_STATIC})) st USING (area_id)"""
_ABT_PARTS = {"hist": _HISTORY, "panel": _PANEL, "pb": _PB}


def area_features(spark, sf):
    static = _static(spark, sf).withColumn("population", F.when(F.col("population") > -1, F.col("population")))
    out = pit.area_table(_history(spark, sf), [_editioned(spark, sf), _panel_block(spark, sf)], static, areas(spark, sf))
    return out.withColumn("log_population", round_even("log_population", 6))


@query("abt_area", sql(f"SELECT * FROM ({_ABT})", **_ABT_PARTS))
def abt_area(spark, sf):
    return area_features(spark, sf)


_PEOPLE = f"""SELECT year, person_id, area_id, school_id, state, network, weight, score, n AS school_evaluated, {R('att', 6)} AS school_attendance_pct, passed FROM evaluated JOIN
 (SELECT year, school_id, count(*) FILTER (present = 1 AND filled = 1) AS n, 100*avg(present) AS att FROM persons GROUP BY 1, 2) USING (year, school_id) JOIN areas USING (area_id)"""


def people(spark, sf):
    p = enriched(persons(spark, sf), areas(spark, sf).select("area_id", "state"), ["area_id"])
    return I.person_table(p).withColumn("school_attendance_pct", round_even("school_attendance_pct", 6))


@query("abt_person", sql(f"SELECT * FROM ({_PEOPLE})"))
def abt_person(spark, sf):
    return people(spark, sf)


@query("abt_person_full", sql(f"""SELECT p.*, f.* EXCLUDE (year, area_id, state, indicator_t, hit_t, gap_t, area_name, state_name, region) FROM ppl p
 LEFT JOIN (SELECT * RENAME (target_year AS year) FROM ({_ABT})) f USING (year, area_id)""", **_ABT_PARTS, ppl=_PEOPLE))
def abt_person_full(spark, sf):
    return I.person_full(people(spark, sf), area_features(spark, sf))
