import pytest
from pyspark.sql import functions as F

from tallyforge.session import scratch_path
from tallyforge.sources import delimited, integrity, records, sheets, sinks


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def result_sheet(spark):
    columns = (
        "ANO string, CO_UF string, SG_UF string, CO_MUNICIPIO string, NO_MUNICIPIO string, NO_TP_REDE string, "
        "PC_ALUNO_ALFABETIZADO_2023 string, PC_ALUNO_ALFABETIZADO_2024 string, META_FINAL_2024 string, META_FINAL_2025 string, "
        "CO_NIVEL_ALFABETIZACAO string, PC_AVALIADOS_LP string"
    )
    return spark.createDataFrame(
        [
            ("2024", "11", "RO", "1100015", "Alta Floresta D'Oeste", "MUNICIPAL", "64.6", "67.79", "67.08", "69.51", "3", "89.87"),
            ("2024", "11", "RO", "1100023", "Ariquemes", "MUNICIPAL", "-", "65.62", "-", "0", "3", "88.76"),
            (None, None, None, None, "(1) nota de rodape", None, None, None, None, None, None, None),
        ],
        columns,
    )


def test_wide_results(result_sheet):
    results, targets = sheets.wide_results(result_sheet, 2024)
    r = {(x.area_id, x.year): x for x in results.collect()}
    assert len(r) == 4 and all(x.edition == 2024 for x in r.values())
    assert r[1100015, 2024].indicator_pct == 67.79 and r[1100015, 2024].level == 3
    assert r[1100015, 2023].level is None and r[1100023, 2023].indicator_pct is None
    assert r[1100015, 2024].network == "municipal"
    t = {(x.area_id, x.year): x.target_pct for x in targets.collect()}
    assert t == {(1100015, 2024): 67.08, (1100015, 2025): 69.51, (1100023, 2024): None, (1100023, 2025): None}


def test_bare_result_column_is_the_own_year(spark):
    raw = spark.createDataFrame(
        [("9", "X", "n", "m", "50")], "CO_MUNICIPIO string, SG_UF string, NO_MUNICIPIO string, NO_TP_REDE string, PC_ALUNO_ALFABETIZADO string"
    ).withColumn("META_FINAL_2025", F.lit("1"))
    assert sheets.wide_results(raw, 2023)[0].first().year == 2023


def test_wide_state(spark):
    raw = spark.createDataFrame(
        [("2024", None, "Brasil", "56", "59.2", "59.9", "> 80"), ("2024", "SC*", "Santa Catarina", "60", "61", "61.7", "> 80")],
        "ANO string, SIGLA_UF string, NOME_UF string, PC_ALUNO_ALFABETIZADO_2023 string, PC_ALUNO_ALFABETIZADO_2024 string, META_FINAL_2024 string, META_FINAL_2030 string",
    )
    results, targets = sheets.wide_state(raw, 2024)
    assert {r.state for r in results.collect()} == {"BR", "SC"}
    assert targets.filter("state = 'BR' and year = 2030").first().target_pct == 80.0


def write_lines(spark, lines):
    path = scratch_path(spark, "sheet")
    spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string").coalesce(1).sortWithinPartitions("i").select("value").write.text(path)
    return path


def test_header_sentinel(spark):
    path = write_lines(spark, [
        "Titulo do arquivo", "", "NU_ANO_CENSO;NO_REGIAO;SG_UF;CO_MUNICIPIO;NO_MUNICIPIO;NO_CATEGORIA;NO_DEPENDENCIA;FUN_CAT_0;FUN_AI_CAT_0;FUN_02_CAT_0",
        "2024;Norte;RO;1100015;A;Total;Total;10;9.1;4", "2024;Norte;RO;1100015;A;Total;Pública;10;8.9;--", "2024;Norte;RO;1100015;A;Rural;Pública;10;7;1",
        "2024;Norte;RO;1100023;B;Total;Pública;10;5.5;2", "nota final",
    ])
    out = sheets.census_indicator(sheets.read_headed(spark, path, "NU_ANO_CENSO"), sheets.CENSUS_COLUMNS["tdi"])
    assert rows(out, "area_id") == [(2024, 1100015, 8.9, None), (2024, 1100023, 5.5, 2.0)]
    with pytest.raises(ValueError):
        sheets.read_headed(spark, path, "NOT_THERE")


def test_panel_has_null_for_absent_families(spark):
    raw = spark.createDataFrame(
        [("RO", "1100015", "A", "Pública", "5.1", "5.6", "190.1", "200.2", "0.9"), ("RO", "1100015", "A", "Municipal", "1", "1", "1", "1", "1"), ("RO", "1100023", "B", "Pública", "-", "5.0", "1", "2", "3")],
        "SG_UF string, CO_MUNICIPIO string, NO_MUNICIPIO string, REDE string, VL_OBSERVADO_2021 string, VL_OBSERVADO_2023 string, VL_NOTA_PORTUGUES_2023 string, VL_NOTA_MATEMATICA_2023 string, VL_INDICADOR_REND_2023 string",
    )
    got = {(r.area_id, r.year): r for r in sheets.panel_long(raw).collect()}
    assert len(got) == 4 and got[1100015, 2023].ideb == 5.6
    assert got[1100015, 2021].nota_lp is None and got[1100023, 2021].ideb is None


def test_person_file(spark):
    path = write_lines(spark, [
        "NU_ANO_AVALIACAO;SG_UF;ID_ALUNO;ID_ESCOLA;TP_DEPENDENCIA;CO_MUNICIPIO;IN_PRESENCA_LP;IN_PREENCHIMENTO_LP;VL_PESO_ALUNO_LP;VL_PROFICIENCIA_LP;IN_ALFABETIZADO;TX",
        "2025;RO;1;10;3;1100015;1;1;1.06;760.5;1;x", "2025;RO;2;10;2;1100015;0;0; ; ;0;x", "2025;RO;3;;;;1;1;1;700;0;x",
    ])
    got = rows(delimited.read_persons(spark, path), "person_id")
    assert [r[4] for r in got] == ["municipal", "estadual", None]
    assert got[0][8] == pytest.approx(1.06, abs=1e-6) and got[1][9] is None and got[2][5] is None and got[2][3] is None
    assert [r[10] for r in got] == [1, 0, 0]


def test_person_fact_drops_the_literal_nan(spark):
    a = spark.createDataFrame([(1, "nan"), (2, "estadual")], "person_id int, network string")
    assert rows(delimited.person_fact(a, a.limit(0)), "person_id") == [(1, None), (2, "estadual")]


def test_records_pivot(spark):
    data = [("Município (Código)", "Variável", "Ano", "Valor"), ("1100015", "93", "2022", "21494"), ("1100015", "614", "2022", "3.04"), ("1100023", "93", "2022", "..."), ("1100023", "1", "2022", "5")]
    out = records.eav_pivot(spark.createDataFrame(data, "D1C string, D2C string, D3C string, V string"), records.CENSUS_VARIABLES)
    got = {r.area_id: r for r in out.collect()}
    assert got[1100015].population == 21494 and got[1100015].density == 3.04 and got[1100015].area_km2 is None
    assert got[1100023].population is None


def test_rings_treat_a_polygon_as_one_part(spark):
    df = spark.createDataFrame(
        [(1, "Polygon", "[[[0,0],[1,0],[1,1]],[[5,5],[6,6],[7,7]]]"), (2, "MultiPolygon", "[[[[0,0],[2,0],[2,2]]],[[[9,9],[8,8],[7,7]]]]")],
        "area_id bigint, type string, coordinates string")
    got = {r.area_id: r.rings for r in records.rings_of(df).collect()}
    assert got[1] == [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]] and len(got[2]) == 2 and got[2][1][0] == [9.0, 9.0]


def test_integrity_states(spark):
    d = spark.createDataFrame([("a", 1, "m1", "s1"), ("b", 1, "m2", "s2"), ("c", 1, "m3", "s3"), ("d", 1, "m4", "s4")], "name string, bytes long, md5 string, sha256 string")
    p = spark.createDataFrame([("m1", "a"), ("xx", "b")], "expected_md5 string, name string")
    m = spark.createDataFrame([("a", "s1"), ("b", "s2"), ("c", "old"), ("gone", "s")], "name string, sha256 string")
    report = integrity.integrity_report(d, p, m)
    assert {r.name: r.status for r in report.collect()} == {"a": "ok", "b": "diverges", "c": "drifted", "d": "unlisted", "gone": "absent"}
    with pytest.raises(RuntimeError):
        integrity.require_intact(report)


def test_written_table_counts_its_rows(spark):
    path = scratch_path(spark, "table")
    assert sinks.write_table(spark.range(1000).withColumn("k", F.col("id") % 7), path, ["k", "id"]) == (1000, 2)
    assert spark.read.parquet(path).count() == 1000
