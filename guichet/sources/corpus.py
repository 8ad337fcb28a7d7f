"""Small document lists held in code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..schema import DOCUMENT_SCHEMA


def documents_from_records(spark: SparkSession, records: Iterable[Mapping]) -> DataFrame:
    """``{id, text, metadata}`` records, each with its own metadata keys, as a document table."""
    rows = [(r["id"], r["text"], {k: str(v) for k, v in r.get("metadata", {}).items()}) for r in records]
    return spark.createDataFrame(rows, DOCUMENT_SCHEMA)
