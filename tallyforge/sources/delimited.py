"""Delimited person and area files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import clean_text, lookup, ratio, to_number

# Header of the person file -> (column here, type).
PERSON_COLUMNS = {
    "NU_ANO_AVALIACAO": ("year", "int"),
    "SG_UF": ("state", "string"),
    "ID_ALUNO": ("person_id", "bigint"),
    "ID_ESCOLA": ("school_id", "bigint"),
    "TP_DEPENDENCIA": ("network", "code"),
    "CO_MUNICIPIO": ("area_id", "bigint"),
    "IN_PRESENCA_LP": ("present", "int"),
    "IN_PREENCHIMENTO_LP": ("filled", "int"),
    "VL_PESO_ALUNO_LP": ("weight", "number"),
    "VL_PROFICIENCIA_LP": ("score", "number"),
    "IN_ALFABETIZADO": ("passed", "int"),
}

# Network codes of the person file and of the area file.
PERSON_NETWORKS = {1: "federal", 2: "estadual", 3: "municipal", 4: "privada"}
AREA_NETWORKS = {0: "total", 1: "federal", 2: "estadual", 3: "municipal", 4: "privada", 5: "publica"}


def header_names(spark: SparkSession, path: str, sep: str, encoding: str) -> list[str]:
    """Column names from the first line; one line comes to the driver."""
    return spark.read.csv(path, sep=sep, encoding=encoding, header=True, inferSchema=False).columns


def read_text_columns(spark: SparkSession, path: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """Every column as text under an explicit schema, so that a later select prunes the scan."""
    names = header_names(spark, path, sep, encoding)
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.csv(path, sep=sep, encoding=encoding, header=True, schema=schema)


def persons(raw: DataFrame) -> DataFrame:
    """Person rows with declared types; weights and scores that are not numbers become null."""
    cells = []
    for header, (name, kind) in PERSON_COLUMNS.items():
        c = F.trim(F.col(header))
        if kind == "number":
            typed = to_number(c).cast("float")
        elif kind == "code":
            typed = lookup(to_number(c).cast("int"), PERSON_NETWORKS)
        elif kind == "string":
            typed = c
        else:
            typed = to_number(c).cast(kind)
        cells.append(typed.alias(name))
    return raw.select(*cells)


def read_persons(spark: SparkSession, path: str) -> DataFrame:
    return persons(read_text_columns(spark, path))


def person_fact(*years: DataFrame) -> DataFrame:
    """Union of the yearly person tables; the literal network 'nan' is no network."""
    out = years[0]
    for other in years[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out.withColumn("network", F.nullif(F.col("network"), F.lit("nan")))


def area_aggregates(raw: DataFrame, levels: int = 9) -> DataFrame:
    """Published aggregates per area and network, with one share per level 0..levels-1."""
    return raw.select(
        to_number("NU_ANO_AVALIACAO").cast("int").alias("year"),
        to_number("CO_MUNICIPIO").cast("bigint").alias("area_id"),
        clean_text("NO_MUNICIPIO").alias("area_name"),
        F.col("SG_UF").alias("state"),
        lookup(to_number("ID_TIPO_REDE").cast("int"), AREA_NETWORKS).alias("network"),
        to_number("PC_ALUNO_ALFABETIZADO").alias("indicator_pct"),
        to_number("VL_MEDIA_LP").alias("mean_score"),
        *[to_number(f"PC_ALUNO_NIVEL_{k}_LP").alias(f"level_{k}_pct") for k in range(levels)],
    )


def social_level(raw: DataFrame, network: int = 6) -> DataFrame:
    """Social level per area: the total stratum, with the rural share of persons and the band sums.

    Conditional aggregation over the two strata: one shuffle, no self join.
    """
    place, count = to_number("TP_LOCALIZACAO"), to_number("QTD_ALUNOS_INSE")
    level = [to_number(f"PC_NIVEL_{k}") for k in range(1, 9)]

    def band(ks):
        return sum((F.coalesce(level[k - 1], F.lit(0.0)) for k in ks), F.lit(0.0))

    total, rural = place == 0, place == 2
    grouped = (
        raw.filter((to_number("TP_TIPO_REDE") == network) & place.isin(0, 2))
        .groupBy(to_number("CO_MUNICIPIO").cast("bigint").alias("area_id"))
        .agg(
            F.count_if(total).alias("__total"),
            F.max(F.when(total, (to_number("TP_CAPITAL") == 1).cast("int"))).alias("capital"),
            F.max(F.when(total, to_number("MEDIA_INSE"))).alias("social_mean"),
            F.max(F.when(total, count)).alias("social_persons"),
            F.coalesce(F.max(F.when(rural, count)), F.lit(0.0)).alias("__rural"),
            F.max(F.when(total, band((1, 2, 3)))).alias("social_low_pct"),
            F.max(F.when(total, band((6, 7, 8)))).alias("social_high_pct"),
        )
    )
    return grouped.filter(F.col("__total") > 0).select(
        "area_id", "capital", "social_mean", "social_persons",
        ratio(F.lit(100.0) * F.col("__rural"), "social_persons").alias("rural_pct"),
        "social_low_pct", "social_high_pct",
    )
