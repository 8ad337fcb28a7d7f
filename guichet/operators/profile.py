"""Distributions and numeric profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..schema import URGENCY_LABELS


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value, nulls left out, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    pct = F.col("n") * 100.0 / counts.agg(F.sum("n")).scalar()  # a subquery on the same shuffle
    return counts.select(column, "n", pct.alias("pct")).orderBy(F.desc("n"), column)


def value_counts_in_order(df: DataFrame, column: str = "urgence", labels: Sequence[str] = tuple(URGENCY_LABELS)) -> DataFrame:
    """The same in a fixed label order, absent labels skipped, with a text bar."""
    rank = F.array_position(F.array(*[F.lit(v) for v in labels]), F.col(column))
    return (
        value_counts(df, column)
        .filter(F.col(column).isin(list(labels)))
        .withColumns({"rank": rank.cast("int"), "bar": T.percent_bar("pct")})
        .orderBy("rank")
    )


def distribution_report(before: DataFrame, after: DataFrame, column: str = "urgence") -> DataFrame:
    """Both distributions in one long table."""
    return (
        value_counts(before, column).withColumn("phase", F.lit("before"))
        .unionByName(value_counts(after, column).withColumn("phase", F.lit("after")))
        .select("phase", column, "n", "pct")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, one row per column."""
    parts = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("p")).select("p.*")
    n = F.approx_count_distinct("value") if approximate else F.count_distinct("value")
    return parts.groupBy("column").agg(n.alias("n_distinct"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def numeric_profile(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """min, max, mean, median and sample standard deviation of a target column."""
    c = F.col(column)
    aggs = [F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")]
    if approximate:
        return df.agg(*aggs, F.percentile_approx(c, 0.5, 100_000).cast("double").alias("median"))
    return df.agg(*aggs).withColumn("median", F.lit(exact_median(df, column)).cast("double"))


def exact_median(df: DataFrame, column: str, accuracy: int = 10_000, most: int = 10_000) -> float | None:
    """The exact median; null and NaN values are left out, and no values give None.

    Each pass brackets the middle with a quantile sketch over the values still in question and counts what lies
    below. It ends when at most ``most`` distinct values are left; only those are put in order. A bracket that has
    lost the middle, which the sketch's error bound excludes, raises.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    total = values.count()
    if not total:
        return None
    ranks = ((total + 1) // 2, total // 2 + 1)
    below, inside, here = 0, total, values
    while here.select("v").distinct().limit(most + 1).count() > most:
        middle = [(r - below) / inside for r in ranks]
        band = 4.0 / accuracy
        low, high = here.agg(F.percentile_approx("v", F.array(F.lit(max(0.0, middle[0] - band)), F.lit(min(1.0, middle[1] + band))), accuracy)).first()[0]
        under, here = F.count_if(F.col("v") < low), here.filter(F.col("v").between(low, high))
        below, inside = values.agg(under).first()[0], here.count()
        if not below < ranks[0] <= ranks[1] <= below + inside:
            raise ArithmeticError(f"the sketch of {column} missed the middle")
    counts = sorted((r.v, r.n) for r in here.groupBy("v").agg(F.count("*").alias("n")).collect())
    found = []
    for v, n in counts:
        found += [v] * sum(below < r <= below + n for r in ranks)
        below += n
    return sum(found) / 2


def prediction_profile(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean and population standard deviation of a prediction column."""
    c = F.col(column)
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("std"))


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values with their share of all rows; ties in value order."""
    return value_counts(df, column).limit(n)
