"""Ticket, stage and document files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import BALANCED_SCHEMA, DOCUMENT_SCHEMA, SPLIT_LABELS, STAGE_COLUMNS, TICKET_SCHEMA

# Quotes are doubled inside quoted fields, and blanks at the ends of a field are kept.
CSV_FORMAT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_tickets_csv(spark: SparkSession, path: str, schema: str = TICKET_SCHEMA, multi_line: bool = True, malformed: str | None = None) -> DataFrame:
    """Ticket CSV whose header matches the schema.

    A row with too few or too many fields, or a value of the wrong type, fails the read. With ``malformed`` such rows
    are kept instead and carry their text in a column of that name, null for good rows. Quoted line breaks need
    ``multi_line``, which reads each file in one task; files without them can be split when it is off.
    """
    reader = spark.read.options(**CSV_FORMAT, multiLine=multi_line, enforceSchema=malformed is not None)
    if malformed is None:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    return reader.schema(f"{schema}, `{malformed}` string").options(mode="PERMISSIVE", columnNameOfCorruptRecord=malformed).csv(path)


def read_split_csvs(spark: SparkSession, paths: Mapping[str, str], schema: str = BALANCED_SCHEMA) -> DataFrame:
    """One CSV per split -> one DataFrame with a ``split`` column."""
    frames = [read_tickets_csv(spark, paths[s], schema).withColumn("split", F.lit(s)) for s in SPLIT_LABELS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def write_table(df: DataFrame, path: str, split: str | None = None) -> None:
    """Replace a Parquet table, one folder per split if a split column is named."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(split) if split else writer).parquet(path)


def replace_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """Replace the splits that ``df`` has rows of; the folders of all others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(split).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_FORMAT).csv(path)


def read_stage(spark: SparkSession, path: str, stage: str, splits: Sequence[str] | None = None, split: str = "split") -> DataFrame:
    """A table with the predictions up to ``stage``; says what to run when it is missing or too early.

    ``splits`` names the splits to read: where the table has a folder for each, the others are not listed.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no table at {path}: train the '{stage}' stage first") from error
    missing = [c for c in STAGE_COLUMNS[stage] if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks {missing}: train the '{stage}' stage first")
    return df if splits is None else df.filter(F.col(split).isin(list(splits)))


def write_documents(df: DataFrame, path: str) -> None:
    """(id, text, metadata map) as JSON lines."""
    df.select("id", "text", "metadata").write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, path: str, array_file: bool = False) -> DataFrame:
    """JSON lines, or files that each hold one JSON array."""
    return spark.read.schema(DOCUMENT_SCHEMA).json(path, multiLine=array_file)
