"""Approximate dense search: an inverted file of k-means cells over all rows, with exact distances inside the probed cells."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .search import best_per_query, comparable, dense_scores, dense_search, keep_best

#: Rows that the cells are fitted on at most, rows a cell holds on average, cells at most, and cells that a query probes.
SAMPLE, CELL_ROWS, MAX_CELLS, PROBES = 100_000, 100, 4_096, 8
#: Share of the exact hits that tuning asks for, and rows that it asks about.
RECALL, TUNING = 0.95, 300
#: Rows of a part of a cell, and queries that meet it together.
PART_ROWS, BLOCK_QUERIES = 4_000, 1_000
#: Distances between rows and centres that a task holds at a time.
DISTANCES = 1_000_000


@dataclass
class CellIndex:
    """``rows`` is (cell, part, id, v) of every row; ``parts`` is (cell, parts); ``centres`` one row of numbers a cell."""

    rows: DataFrame
    parts: DataFrame
    centres: np.ndarray
    metric: str
    #: Cells that a query probes if its search names no other number.
    probes: int = PROBES


def _ready(df: DataFrame, id_col: str, vec_col: str, metric: str, name: str) -> DataFrame:
    """(name, v): vectors of finite numbers; of length one for cosine, where a zero vector stays zero."""
    v = F.col(vec_col).cast("array<double>")
    given = df.filter(F.col(vec_col).isNotNull()).select(F.col(id_col).alias(name), v.alias("v"))
    given = given.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if metric == "l2sq":
        return given
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return given.withColumn("_n", norm).select(name, F.when(F.col("_n") > 0, F.transform("v", lambda x: x / F.col("_n"))).otherwise(F.col("v")).alias("v"))


def _from_centres(batch: pa.RecordBatch, vec: str, centres: np.ndarray, squares: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, distances): some rows of the batch at a time and how far each is from every centre, less its own square."""
    step = max(1, DISTANCES // len(centres))
    for at in range(0, batch.num_rows, step):
        some = batch.slice(at, step)
        x = some.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, -1)
        yield some, squares - 2 * x @ centres.T


def _nearest(df: DataFrame, name: str, centres: np.ndarray, n: int) -> DataFrame:
    """(name, v, cell): each row once for each of its ``n`` nearest cells. The centres travel to the tasks: MAX_CELLS vectors at most.

    A task hands on each vector once with its list of cells.
    """
    kind = df.schema[name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares = (centres * centres).sum(1)
        for batch in batches:
            for some, far in _from_centres(batch, "v", centres, squares):
                near = np.sort(np.argpartition(far, n - 1, axis=1)[:, :n] if n < len(centres) else np.tile(np.arange(len(centres)), (len(far), 1)), axis=1)
                cells = pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, near.shape[1], dtype=np.int32)), pa.array(near.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([some.column(name), some.column("v"), cells], [name, "v", "cells"])

    return df.select(name, "v").mapInArrow(run, f"{name} {kind}, v array<double>, cells array<int>").select(name, "v", F.explode("cells").alias("cell"))


def build_cells(docs: DataFrame, metric: str = "cosine", doc_id: str = "id", doc_vec: str = "embedding", sample: int = SAMPLE, cell_rows: int = CELL_ROWS, max_cells: int = MAX_CELLS) -> CellIndex | None:
    """The cells of all rows with a vector of finite numbers, None if there is no such row.

    k-means on at most ``sample`` rows, those with the smallest hashes of their ids, gives one centre for ``cell_rows`` rows
    and ``max_cells`` at most; then every row goes to the cell of its nearest centre. A cell with more than PART_ROWS
    rows is stored in parts, so a hot cell is many bounded groups.
    """
    if metric not in ("cosine", "l2sq"):
        raise ValueError(f"unknown metric {metric}")
    ready = settle(_ready(docs, doc_id, doc_vec, metric, "id"), "vectors")
    n = ready.count()
    if n == 0:
        return None
    h = F.xxhash64("id")
    few = ready.filter(h <= F.lit(min((1 << 63) - 1, -(1 << 63) + (1 << 64) * (sample + sample // 20) // n)))
    k = max(1, min(max_cells, -(-n // cell_rows)))
    if k == 1 or few.count() <= k:
        centres = np.array([few.first().v if few.first() else ready.first().v])
    else:
        fitted = KMeans(k=k, seed=7, maxIter=15, featuresCol="f").fit(few.select(array_to_vector("v").alias("f")))
        centres = np.array(fitted.clusterCenters())
    placed = settle(_nearest(ready, "id", centres, 1), "placed")
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))  # one row a cell
    rows = placed.join(F.broadcast(parts), "cell").select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"), "id", "v")
    return CellIndex(settle(rows.repartition("cell", "part").sortWithinPartitions("cell", "part"), "cells"), settle(parts, "parts"), centres, metric)


def cell_search(queries: DataFrame, index: CellIndex | None, k: int = 3, query_id: str = "query_id", query_vec: str = "embedding", probes: int | None = None) -> DataFrame:
    """(query_id, id, rank) with ``similarity``/``distance`` for cosine, ``distance`` for l2sq: the nearest rows in the ``probes`` nearest cells.

    Distances there are exact. Queries and rows meet by cell, a block of queries and a part of the cell at a time; each
    meeting yields k rows a query. With as many probes as cells the result is exact. Queries without a vector of
    finite numbers have no rows.
    """
    if index is None:
        raise ValueError("the index has no rows")
    metric = index.metric
    asked = _nearest(_ready(queries, query_id, query_vec, metric, "query_id"), "query_id", index.centres, min(probes or index.probes, len(index.centres)))
    blocks = -(-max(1, queries.count()) // BLOCK_QUERIES)
    spread = asked.join(F.broadcast(index.parts), "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    spread = spread.select("cell", "part", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"), "query_id", F.col("v").alias("q"))
    met = spread.groupBy("cell", "part", "block").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))  # about BLOCK_QUERIES at most
    met = met.withColumnRenamed("cell", "_cell").withColumnRenamed("part", "_part")
    rows = index.rows.groupBy("cell", "part").agg(F.collect_list(F.struct("id", "v")).alias("rows"))  # about PART_ROWS at most
    pairs = met.join(rows, (F.col("cell") == F.col("_cell")) & (F.col("part") == F.col("_part"))).select("asked", "rows")
    id_kind, query_kind = (f.schema[c].dataType.simpleString() for f, c in ((index.rows, "id"), (spread, "query_id")))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked_rows, held = (batch.column(c).slice(i, 1).flatten() for c in ("asked", "rows"))
                names, ids = asked_rows.field("query_id"), held.field("id").to_numpy(zero_copy_only=False)
                q, x = (v.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1) for v, c in ((asked_rows, "q"), (held, "v")))
                found = []
                for at in range(0, len(q), 64):
                    scores = dense_scores(x, q[at:at + 64], "l2sq") if metric == "l2sq" else q[at:at + 64] @ x.T
                    for j, row in enumerate(comparable(scores, metric)):
                        best, score = keep_best(ids, row, k)
                        found.append((np.full(len(best), at + j), best, score))
                which, best, score = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([names.take(pa.array(which)), pa.array(best, held.field("id").type), pa.array(score.astype(float))], ["query_id", "id", "score"])

    hits = best_per_query(pairs.mapInArrow(meet, f"query_id {query_kind}, id {id_kind}, score double"), k)
    if metric == "l2sq":
        return hits.select("query_id", "id", "rank", (-F.col("score")).alias("distance"))
    return hits.select("query_id", "id", "rank", F.col("score").alias("similarity"), (1 - F.col("score")).alias("distance"))


def tune_probes(index: CellIndex, k: int = 10, target: float = RECALL, sample: int = TUNING) -> CellIndex:
    """Set the fewest probes that find ``target`` of the exact k nearest rows of ``sample`` rows of the index, by hash of their ids.

    How many that are depends on the vectors: where they lie in clusters a few, where they fill all directions alike
    most cells. The exact search tells each hit's cell; its place among the cells nearest to the query is the number of probes that
    finds it, so one pass answers for every number.
    """
    h = F.xxhash64(F.lit("tune"), "id")
    n = index.rows.count()
    few = index.rows.filter(h <= F.lit(min((1 << 63) - 1, -(1 << 63) + (1 << 64) * sample // max(n, 1)))).select(F.col("id").alias("query_id"), F.col("v").alias("embedding"))
    few = settle(few, "tuning")
    exact = dense_search(few, index.rows.select("id", F.col("v").alias("embedding")), k + 1, index.metric).filter("id <> query_id")
    cells = exact.select("query_id", "id").join(index.rows.select("id", "cell"), "id").join(few, "query_id").select("embedding", "cell")
    places, centres = np.zeros(len(index.centres) + 1), index.centres
    squares = (centres * centres).sum(1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, far in _from_centres(batch, "embedding", centres, squares):
                cell = some.column("cell").to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array((far < far[np.arange(len(cell)), cell][:, None]).sum(1) + 1)], ["place"])

    for row in cells.mapInArrow(place, "place long").groupBy("place").count().collect():  # one row a cell at most
        places[row["place"]] = row["count"]
    if places.sum():
        index.probes = int(np.argmax(np.cumsum(places) >= target * places.sum()))
    return index


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of the exact hits that the search found, over all queries; 1.0 without any."""
    held = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return held.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0))).first()[0]
