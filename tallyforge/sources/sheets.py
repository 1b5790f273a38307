"""Wide published sheets, as text cells, to long tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clean_text, to_number

HEAD_LINES = 15

# Per indicator, output column -> column of the sheet.
CENSUS_COLUMNS = {
    "afd": {"afd_ai_grupo1_pct": "FUN_AI_CAT_1", "afd_ai_grupo5_pct": "FUN_AI_CAT_5", "afd_inf_grupo1_pct": "ED_INF_CAT_1"},
    "atu": {"alunos_por_turma_ai": "FUN_AI_CAT_0", "alunos_por_turma_2ano": "FUN_02_CAT_0", "alunos_por_turma_pre": "PRE_CAT_0"},
    "tdi": {"distorcao_ai_pct": "FUN_AI_CAT_0", "distorcao_2ano_pct": "FUN_02_CAT_0"},
    "dsu": {"docentes_superior_ai_pct": "FUN_AI_CAT_0", "docentes_superior_inf_pct": "ED_INF_CAT_0"},
    "rend": {
        "aprovacao_ai_pct": "1_CAT_FUN_AI", "aprovacao_1ano_pct": "1_CAT_FUN_01", "aprovacao_2ano_pct": "1_CAT_FUN_02",
        "reprovacao_ai_pct": "2_CAT_FUN_AI", "abandono_ai_pct": "3_CAT_FUN_AI",
    },
}

# The four column families of the biennial panel.
PANEL_FAMILIES = {
    "ideb": "VL_OBSERVADO", "nota_lp": "VL_NOTA_PORTUGUES", "nota_mt": "VL_NOTA_MATEMATICA", "rendimento": "VL_INDICADOR_REND",
}

RESULT_STEM, TARGET_STEM, EARLIER_STEM = "PC_ALUNO_ALFABETIZADO", "META_FINAL", "SAEB"


def read_headed(spark: SparkSession, path: str, sentinel: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Text cells of a sheet whose header is the first of the first lines that starts with `sentinel`.

    Only that header line comes to the driver. Lines before it carry other text in the key columns and
    fall to the filters of the callers; the header line itself is left out here. Files are split as usual.
    """
    lines = spark.read.option("encoding", encoding).text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("seq"),
    )
    head = lines.filter(F.col("start") == 0)
    first = head.groupBy("file").agg(F.min("seq").alias("first_seq"))
    is_header = F.trim(F.element_at(F.split("value", re.escape(sep)), 1)) == sentinel
    found = (
        head.join(first, "file").filter((F.col("seq") - F.col("first_seq") < HEAD_LINES) & is_header)
        .orderBy("file", "seq").select("value").first()
    )
    if found is None:
        raise ValueError(f"no line of the first {HEAD_LINES} starts with {sentinel!r}: {path}")
    names = [n.strip() for n in found["value"].split(sep)]
    schema = ", ".join(f"`{n}` string" for n in names)
    cells = F.from_csv(F.col("value"), schema, {"sep": sep, "mode": "PERMISSIVE"})
    return lines.filter(~is_header).select(cells.alias("row")).select("row.*")


def year_columns(names: Sequence[str], stem: str, own_year: int | None = None) -> dict[str, int]:
    """Columns named STEM_YYYY; a bare STEM stands for the sheet's own year."""
    out = {}
    for name in names:
        m = re.fullmatch(rf"{stem}(?:_(\d{{4}}))?", name)
        if m and (m.group(1) or own_year is not None):
            out[name] = int(m.group(1)) if m.group(1) else own_year
    return out


def _long(raw: DataFrame, keep: Sequence[Column], columns: Mapping[str, int], value: str, cell=to_number, **tags) -> DataFrame:
    entries = [
        F.struct(F.lit(year).alias("year"), cell(F.col(name)).alias(value), *[F.lit(v).alias(k) for k, v in tags.items()])
        for name, year in columns.items()
    ]
    return raw.select(*keep, F.explode(F.array(*entries)).alias("e")).select(*[k for k in _names(raw, keep)], "e.*")


def _names(raw: DataFrame, keep: Sequence[Column]) -> list[str]:
    return raw.select(*keep).columns


def wide_results(raw: DataFrame, edition: int) -> tuple[DataFrame, DataFrame]:
    """(results, targets) of one area sheet. `edition` is the sheet's own year.

    Footer lines have no numeric area code. Level and participation belong to the own year only.
    A target of zero or less is a filling error.
    """
    area = to_number("CO_MUNICIPIO").cast("bigint")
    rows = raw.filter(area.isNotNull())
    level = next((c for c in raw.columns if c.startswith(("CO_NIVEL", "NIVEIS_"))), None)
    nothing = F.lit(None).cast("double")
    own_level = to_number(level) if level else nothing
    own_part = to_number("PC_AVALIADOS_LP") if "PC_AVALIADOS_LP" in raw.columns else nothing
    keep = [
        area.alias("area_id"), clean_text("SG_UF").alias("state"), clean_text("NO_MUNICIPIO").alias("area_name"),
        clean_text("NO_TP_REDE", lower=True).alias("network"),
        own_level.alias("__level"), own_part.alias("__part"),
    ]
    results = _long(rows, keep, year_columns(raw.columns, RESULT_STEM, edition), "indicator_pct")
    own = F.col("year") == edition
    results = results.select(
        "area_id", "state", "area_name", "network", "year", "indicator_pct", F.lit(edition).alias("edition"),
        F.when(own, F.col("__level")).alias("level"), F.when(own, F.col("__part")).alias("participation_pct"),
    )

    def positive(c):
        return F.when(to_number(c) > 0, to_number(c))

    targets = _long(rows, [area.alias("area_id")], year_columns(raw.columns, TARGET_STEM), "target_pct", positive)
    return results, targets.withColumn("edition", F.lit(edition))


def wide_state(raw: DataFrame, edition: int) -> tuple[DataFrame, DataFrame]:
    """(results, targets) of one state sheet: the country row has no code, codes may carry '*', targets '> 80'."""
    code = clean_text(F.coalesce(F.col("SIGLA_UF"), F.lit("BR")), drop=["*"])
    rows = raw.filter(F.col("NOME_UF").isNotNull())
    keep = [code.alias("state"), clean_text("NOME_UF").alias("state_name")]
    results = _long(
        rows, keep, year_columns(raw.columns, RESULT_STEM, edition), "indicator_pct", source="indicador"
    )
    earlier = year_columns(raw.columns, EARLIER_STEM)
    if earlier:
        results = results.unionByName(_long(rows, keep, earlier, "indicator_pct", source="saeb"))

    def plain(c):
        return to_number(F.replace(c, F.lit(">"), F.lit("")))

    targets = _long(rows, [code.alias("state")], year_columns(raw.columns, TARGET_STEM), "target_pct", plain)
    return results.withColumn("edition", F.lit(edition)), targets.withColumn("edition", F.lit(edition))


def total_stratum(raw: DataFrame) -> DataFrame:
    """Rows of the total location stratum with a numeric area code."""
    area = to_number("CO_MUNICIPIO").cast("bigint")
    return raw.filter((F.col("NO_CATEGORIA") == "Total") & area.isNotNull())


def census_indicator(raw: DataFrame, columns: Mapping[str, str], dependency: str = "Pública") -> DataFrame:
    """Chosen columns of one census sheet for one administrative network."""
    return total_stratum(raw).filter(F.col("NO_DEPENDENCIA") == dependency).select(
        to_number("NU_ANO_CENSO").cast("int").alias("year"),
        to_number("CO_MUNICIPIO").cast("bigint").alias("area_id"),
        *[to_number(source).alias(name) for name, source in columns.items()],
    )


def panel_long(raw: DataFrame, network: str = "Pública", families: Mapping[str, str] | None = None) -> DataFrame:
    """One row per area and year found in the first family; a family without that year is null."""
    families = families or PANEL_FAMILIES
    lead = next(iter(families.values()))
    years = sorted(set(year_columns(raw.columns, lead).values()))
    area = to_number("CO_MUNICIPIO").cast("bigint")

    def cell(stem: str, year: int) -> Column:
        name = f"{stem}_{year}"
        return to_number(name) if name in raw.columns else F.lit(None).cast("double")

    entries = [
        F.struct(F.lit(y).alias("year"), *[cell(stem, y).alias(name) for name, stem in families.items()]) for y in years
    ]
    rows = raw.filter((F.col("REDE") == network) & area.isNotNull())
    return rows.select(area.alias("area_id"), F.explode(F.array(*entries)).alias("e")).select("area_id", "e.*")
