"""A training corpus from raw documents: five stages, each a table that the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet.llm.decontaminate import without_leaks
from guichet.llm.kdtree import kd_shards
from guichet.llm.lines import clean_documents
from guichet.llm.mixture import mixed_documents
from guichet.llm.registry import table
from guichet.llm.simhash import drop_near_copies
from guichet.session import fresh_path, ship_code

#: Bytes of a shard.
SHARD_BYTES = 32 << 20


def _counted(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without their hosts' boilerplate lines."""
    ship_code(spark)
    return _counted(clean_documents(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    ship_code(spark)
    return _counted(drop_near_copies(docs, size=5, similarity=0.8))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    ship_code(spark)
    return _counted(without_leaks(docs, table(spark, sf_dir, "benchmark")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with those words, as the mix of sources takes them."""
    ship_code(spark)
    return _counted(mixed_documents(docs))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text, shard and place of each row of the mix; rows of one document differ in their words or their slot."""
    ship_code(spark)
    return kd_shards(docs, target_bytes=SHARD_BYTES, with_text=True).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontamination), ("mixture", mixture), ("sharding", sharding),
]

#: SQL has no SimHash and no pseudorandom deal; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
