"""Index tables that grow by segments: rows are added, replaced and deleted by id without rewriting what is stored.

A change writes one new segment, its rows and the ids it takes from older segments, and a line of the log that names
the segments in use. Readers see the state of one log version. One writer at a time.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import delete_path

#: Segments of about the same size that are merged into one; a segment is of the next size when it has this many times the rows.
FAN_IN = 4


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("version long, place int, segment string, n_rows long, n_gone long").parquet(os.path.join(path, "log"))


def segments(spark: SparkSession, path: str) -> list:
    """(version, place, segment, n_rows, n_gone) of the segments in use, oldest first; one row a segment, about FAN_IN * log(changes) of them."""
    try:
        log = _log(spark, path)
        last = log.agg(F.max("version")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return log.filter(F.col("version") == last).orderBy("place").collect()


def _name(spark: SparkSession, path: str, used: list[tuple[str, int, int]], version: int) -> None:
    """Make ``used`` (segment, rows, ids taken) the segments of ``version``. Spark commits the one file whole."""
    rows = [(version, k, s, n, g) for k, (s, n, g) in enumerate(used)]
    spark.createDataFrame(rows, "version long, place int, segment string, n_rows long, n_gone long").coalesce(1).write.mode("append").parquet(os.path.join(path, "log"))


def _write(path: str, rows: DataFrame, gone: DataFrame) -> tuple[str, int, int]:
    spark, segment = rows.sparkSession, f"segment-{uuid.uuid4().hex}"
    here = os.path.join(path, segment)
    rows.write.parquet(os.path.join(here, "rows"))
    gone.write.parquet(os.path.join(here, "gone"))
    return segment, spark.read.parquet(os.path.join(here, "rows")).count(), spark.read.parquet(os.path.join(here, "gone")).count()


def _stacked(spark: SparkSession, path: str, used: list, part: str) -> DataFrame:
    """The rows or the taken ids of some segments, with ``_place``."""
    tables = [spark.read.parquet(os.path.join(path, s.segment, part)).withColumn("_place", F.lit(s.place)) for s in used]
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more)
    return out


def _live(spark: SparkSession, path: str, used: list, id_col: str) -> DataFrame:
    """The rows of ``used`` whose id no later segment of them takes."""
    rows = _stacked(spark, path, used, "rows")
    taken = _stacked(spark, path, used, "gone").groupBy(F.col(id_col).alias("_gone_id")).agg(F.max("_place").alias("_gone_at"))
    joined = rows.join(taken, F.col(id_col) == F.col("_gone_id"), "left")
    return joined.filter(F.col("_gone_at").isNull() | (F.col("_place") >= F.col("_gone_at"))).drop("_place", "_gone_id", "_gone_at")


def change(path: str, rows: DataFrame, deleted: DataFrame | None = None, id_col: str = "id", merge: bool = True) -> None:
    """Add ``rows``, in place of stored ones with their ids, and delete the ids of ``deleted``.

    Rows of one change that repeat an id all stay; an id both added and deleted is added. Rows without an id are
    kept and can't be replaced. Only the new segment is written; with ``merge`` small segments are then merged.
    """
    spark = rows.sparkSession
    used = segments(spark, path)
    version = used[0].version + 1 if used else 0
    gone = rows.select(id_col)
    if deleted is not None:
        gone = gone.union(deleted.select(id_col))
    if not used:
        gone = gone.limit(0)  # there is nothing older to take ids from
    written = _write(path, rows, gone.filter(F.col(id_col).isNotNull()).distinct())
    _name(spark, path, [(s.segment, s.n_rows, s.n_gone) for s in used] + [written], version)
    if merge:
        merge_segments(spark, path, id_col)


def merge_segments(spark: SparkSession, path: str, id_col: str = "id", fan_in: int = FAN_IN, whole: bool = False) -> bool:
    """Merge the newest segments where ``fan_in`` of them are of a size, or all with ``whole``; True if any were.

    A segment's size is its rows and the ids it takes. Each row is rewritten about once for each power of ``fan_in`` of
    the index. The merged segment takes the ids that its parts took, unless none is older; then deleted rows leave no trace.
    """
    used = segments(spark, path)
    start = 0 if whole else _first_to_merge([s.n_rows + s.n_gone for s in used], fan_in)
    tail = used[start:]
    if len(tail) < 2:
        return False
    gone = _stacked(spark, path, tail, "gone").select(id_col).distinct()
    written = _write(path, _live(spark, path, tail, id_col), gone if start else gone.limit(0))
    _name(spark, path, [(s.segment, s.n_rows, s.n_gone) for s in used[:start]] + [written], used[0].version + 1)
    return True


def _first_to_merge(sizes: list[int], fan_in: int) -> int:
    """Where the tail begins whose oldest part is under ``fan_in`` times the mean of the newer ones, of at least ``fan_in`` parts."""
    for start in range(0, len(sizes) - fan_in + 1):
        newer = sizes[start + 1:]
        if sizes[start] * len(newer) <= fan_in * sum(newer):
            return start
    return len(sizes)


def read(spark: SparkSession, path: str, id_col: str = "id") -> DataFrame:
    """The live rows of the index."""
    used = segments(spark, path)
    if not used:
        raise FileNotFoundError(f"no index at {path}")
    return _live(spark, path, used, id_col)


def drop_unused(spark: SparkSession, path: str) -> int:
    """Delete the segments that the last version does not name, once no reader is on an older one; how many there were."""
    used = {s.segment for s in segments(spark, path)}
    old = [r.segment for r in _log(spark, path).select("segment").distinct().collect() if r.segment not in used]
    for segment in old:
        delete_path(spark, os.path.join(path, segment))
    return len(old)
