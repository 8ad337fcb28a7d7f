"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def byte_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words. ``bytes.split`` separates at exactly the six ASCII white-space characters."""
    return text.lower().split() if text else []


def text_key(*values: Column) -> list[Column]:
    """Two 64-bit hashes that stand for the values, nulls included."""
    marked = [c for v in values for c in (v.isNull(), v)]
    return [F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *marked)]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` at most; a longer value comes alone."""
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in (x.as_buffer() if x.is_valid else None for x in batch.column(column))]
        start = total = 0
        for row, n in enumerate(sizes):
            if row > start and total + n > max_bytes:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def running_offset(df: DataFrame, groups: list[str], order: list[str], weight: str, name: str, rows: int, deal: list[str] | None = None, per_piece: int = 50_000) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows before this one in its group.

    Rows are dealt to pieces by a hash of ``deal`` (by default ``order``) and sorted inside their piece, so a
    group that holds most of the table is many bounded windows. The order of the pieces is pseudorandom but
    repeats on every run. Rows that tie in ``order`` follow one another in any order.
    """
    pieces = max(1, -(-rows // per_piece))
    cut = df.withColumn("_piece", F.pmod(F.xxhash64(F.lit(7), *(deal or order)), F.lit(pieces)))
    totals = cut.groupBy(*groups, "_piece").agg(F.sum(weight).alias("_total"))
    before = Window.partitionBy(*groups).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], F.col("_piece").alias("_p"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*groups, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    same = F.col("_piece") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = cut.join(totals, same)
    return joined.withColumn(name, F.col("_inside") + F.col("_before")).drop("_piece", "_inside", "_p", "_before", *[f"_g{i}" for i in range(len(groups))])
