"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path, passing, settle


def _least(pairs: DataFrame) -> DataFrame:
    """Each link in both directions beside the smallest node around its first end."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return both.join(least, F.col("a") == F.col("n")).drop("n")


def _large_star(pairs: DataFrame) -> DataFrame:
    return _least(pairs).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    joined = down.join(least, F.col("a") == F.col("n"))
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``links`` (a, b: long) to (node, root): the smallest node that each linked node reaches.

    Alternates large and small stars until the links no longer change; each round is a table in
    the shared folder. A hub is only ever a join key (split by adaptive execution) and a minimum
    (combined before the shuffle). Self links and nulls are ignored; no links give no rows.
    """
    spark = links.sparkSession
    out = fresh_path(spark, "roots")
    with passing(spark):
        pairs = settle(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
        seen = None
        for _ in range(rounds):
            pairs = settle(_small_star(_large_star(pairs)).filter("a <> b").distinct(), "stars")
            state = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
            if state == seen:
                roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root"))
                return settle(pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct(), path=out)
            seen = state
    raise RuntimeError(f"components still change after {rounds} rounds")
