"""Training metadata: an append-only log of JSON payloads, read as the latest per model."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

RUN_SCHEMA = "model string, payload string, updated_at timestamp"


def append_metadata(spark: SparkSession, path: str, metadata: Mapping[str, Any]) -> None:
    """Add one row per top-level key, stamped with the current time."""
    rows = [(name, json.dumps(value, ensure_ascii=False)) for name, value in metadata.items()]
    spark.createDataFrame(rows, "model string, payload string").withColumn("updated_at", F.current_timestamp()).write.mode("append").parquet(path)


def latest_metadata(log: DataFrame, key: str = "model", payload: str = "payload", at: str = "updated_at") -> DataFrame:
    """The newest payload per key; equal times resolve to the larger payload."""
    newest = F.max(F.struct(F.col(at), F.col(payload)))
    return log.groupBy(key).agg(newest.alias("m")).select(key, F.col(f"m.{payload}").alias(payload), F.col(f"m.{at}").alias("last_updated"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return latest_metadata(spark.read.schema(RUN_SCHEMA).parquet(path))
