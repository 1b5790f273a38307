"""Tables, reports, predictions and models to storage."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import round_even


def write_table(df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> tuple[int, int]:
    """zstd Parquet in key order; returns (rows, columns). The rows are counted while they are written."""
    seen = Observation()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    out = ordered.observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"], len(df.columns)


def write_tables(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], folder: str) -> dict[str, tuple[int, int]]:
    return {name: write_table(df, f"{folder}/{name}", keys) for name, (df, keys) in tables.items()}


def rounded(df: DataFrame, digits: int) -> DataFrame:
    return df.select(*[
        round_even(c, digits).alias(c) if kind in ("double", "float") else F.col(c) for c, kind in df.dtypes
    ])


def write_report(df: DataFrame, path: str, digits: int = 4) -> None:
    rounded(df, digits).write.mode("overwrite").csv(path, header=True)


def write_predictions(df: DataFrame, path: str, keys: Sequence[str], prediction: str, weight: str | None = None) -> None:
    df.select(*keys, prediction, *([weight] if weight else [])).write.mode("overwrite").parquet(path)


def save_model(model: PipelineModel, path: str, metadata: Mapping) -> None:
    """The fitted stages and, beside them, a one-row JSON table of metadata with the UTC time."""
    model.write().overwrite().save(f"{path}/model")
    record = {**metadata, "saved_at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
    spark = SparkSession.getActiveSession()
    row = spark.createDataFrame([(json.dumps(record, ensure_ascii=False, default=float),)], "metadata string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def load_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()["value"])
