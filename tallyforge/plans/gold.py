"""All Gold tables from their sources, as lazy frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.indicator import area_mart, evolution, fact_table


def gold_tables(
    persons: DataFrame, areas: DataFrame, results: DataFrame, targets: DataFrame, network: str
) -> dict[str, DataFrame]:
    fact = fact_table(persons, areas, targets)
    mart = area_mart(results, targets, areas, fact, network)
    return {
        "areas": areas, "persons": persons, "fact": fact, "mart": mart, "targets": targets, "evolution": evolution(mart),
    }
