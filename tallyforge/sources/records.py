"""JSON record lists and GeoJSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import to_number

# Variable codes of the population and accounts records.
CENSUS_VARIABLES = {"93": "population", "6318": "area_km2", "614": "density"}
ACCOUNTS_VARIABLES = {
    "37": "gdp_thousands", "516": "agriculture_pct", "520": "industry_pct", "528": "government_pct", "6574": "services_pct",
}

_RECORD = "D1C string, D2C string, D3C string, V string"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records {D1C, D2C, D3C, V}; one JSON list per file, or one record per line for large data."""
    return spark.read.schema(_RECORD).json(path, multiLine=True)


def eav_pivot(records: DataFrame, variables: Mapping[str, str], order_by: str | None = None) -> DataFrame:
    """Unit x year with one column per known variable: the first value that is a number, in `order_by` order.

    The header record has no numeric unit and falls out. Units whose values are all missing stay.
    """
    unit, year = to_number("D1C").cast("bigint"), to_number("D3C").cast("int")
    rank = F.col(order_by) if order_by else F.lit(0)
    rows = records.filter(unit.isNotNull() & F.col("D2C").isin(list(variables))).select(
        unit.alias("area_id"), year.alias("year"), F.col("D2C").alias("code"), to_number("V").alias("v"), rank.alias("o")
    )
    return rows.groupBy("area_id", "year").agg(
        *[
            F.min_by("v", F.when((F.col("code") == code) & F.col("v").isNotNull(), F.col("o"))).alias(name)
            for code, name in variables.items()
        ]
    )


def exterior_rings(spark: SparkSession, path: str, key: str = "codarea", multi_line: bool = True) -> DataFrame:
    """One row per area with the outer ring of each of its polygons."""
    schema = f"features array<struct<properties: struct<{key}: string>, geometry: struct<type: string, coordinates: string>>>"
    raw = spark.read.schema(schema).json(path, multiLine=multi_line)
    return rings_of(raw.select(F.explode("features").alias("f")).select(
        to_number(f"f.properties.{key}").cast("bigint").alias("area_id"),
        F.col("f.geometry.type").alias("type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    ))


def rings_of(features: DataFrame) -> DataFrame:
    """(area_id, type, coordinates text) to (area_id, rings). A Polygon counts as a one-part MultiPolygon."""
    ring = "array<array<double>>"
    multi = F.from_json("coordinates", f"array<array<{ring}>>")
    single = F.array(F.from_json("coordinates", f"array<{ring}>"))
    parts = F.when(F.col("type") == "Polygon", single).otherwise(multi)
    return features.select("area_id", F.transform(parts, lambda p: F.get(p, F.lit(0))).alias("rings"))
