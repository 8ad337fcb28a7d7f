"""Spark ML transformers and feature blocks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ..functions import text as T


class TicketTerms(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text column -> array of lower-case word n-grams; null text gives an empty array."""

    low = Param(Params._dummy(), "low", "smallest n-gram", typeConverter=TypeConverters.toInt)
    high = Param(Params._dummy(), "high", "largest n-gram", typeConverter=TypeConverters.toInt)
    foldAccents = Param(Params._dummy(), "foldAccents", "drop accents", typeConverter=TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCol="text_full", outputCol="terms", low=1, high=2, foldAccents=True):
        super().__init__()
        self._setDefault(inputCol="text_full", outputCol="terms", low=1, high=2, foldAccents=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        words = T.tokens(self.getInputCol(), fold=self.getOrDefault("foldAccents"))
        return dataset.withColumn(self.getOutputCol(), T.ngrams(words, self.getOrDefault("low"), self.getOrDefault("high")))


@F.arrow_udf(VectorUDT())
def _log_counts(v: pa.Array) -> pa.Array:
    counts = v.field("values")
    logs = pa.ListArray.from_arrays(counts.offsets, pa.array(1.0 + np.log(counts.values.to_numpy(zero_copy_only=False))))
    return pa.StructArray.from_arrays([v.field("type"), v.field("size"), v.field("indices"), logs], ["type", "size", "indices", "values"])


class SublinearCounts(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Sparse term counts c -> 1 + ln c. Spark ML has no elementwise logarithm; one call takes the counts of a whole Arrow batch."""

    @keyword_only
    def __init__(self, *, inputCol="counts", outputCol="log_counts"):
        super().__init__()
        self._setDefault(inputCol="counts", outputCol="log_counts")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), _log_counts(F.unwrap_udt(self.getInputCol())))


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Remove intermediate feature columns at the end of a pipeline."""

    columns = Param(Params._dummy(), "columns", "columns to drop", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        if columns is not None:
            self._set(columns=columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.getOrDefault("columns"))


def fit_one_hot(df: DataFrame, columns: Sequence[str], prefix: str = "") -> tuple[list, list[str]]:
    """Fitted indexers and encoder for label columns, and the vector columns they make.

    Categories are in alphabetical order; an unseen or null value becomes all zeros.
    """
    if not columns:
        return [], []
    index_cols = [f"{prefix}{c}__index" for c in columns]
    hot_cols = [f"{prefix}{c}__hot" for c in columns]
    indexer = StringIndexer(inputCols=list(columns), outputCols=index_cols, handleInvalid="keep", stringOrderType="alphabetAsc").fit(df)
    encoder = OneHotEncoder(inputCols=index_cols, outputCols=hot_cols, dropLast=True).fit(indexer.transform(df))
    return [indexer, encoder], hot_cols


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<c>_scaled`` = (c - mean) / population std; a constant column scales to 0."""
    stats = df.agg(*[x for i, c in enumerate(columns) for x in (F.avg(c).alias(f"__m{i}"), F.stddev_pop(c).alias(f"__s{i}"))])
    row = stats.select(F.struct("*").alias("s")).scalar()  # one row
    out = df.withColumn("__stats", row)
    for i, c in enumerate(columns):
        sd = F.col(f"__stats.__s{i}")
        out = out.withColumn(f"{c}_scaled", (F.col(c) - F.col(f"__stats.__m{i}")) / F.when(sd > 0, sd).otherwise(F.lit(1.0)))
    return out.drop("__stats")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("total"), F.count("*").alias("k")).select((F.col("total") / F.col("k")).alias("x")).scalar()
    return counts.select(label, "n", (totals / F.col("n")).alias("weight"))


def to_dense(df: DataFrame, vector: str, out: str, max_size: int) -> DataFrame:
    """Sparse vector -> array. A vector with more than ``max_size`` entries fails its task rather than filling its memory."""
    v = F.unwrap_udt(vector)
    size = F.coalesce(v["size"], F.size(v["values"]))
    too_large = F.raise_error(F.format_string(f"{vector} has %d entries; over {max_size} stays sparse", size)).cast("array<double>")
    return df.withColumn(out, F.when(size > max_size, too_large).otherwise(vector_to_array(vector)))
