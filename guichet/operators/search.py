"""Per-query top-k search over dense vectors and TF-IDF vectors.

TF-IDF search reads an inverted index. Dense search is exact: a query batch whose size has been
checked travels to the documents, where each task hands on at most k rows per query; a larger batch
takes an exact distributed path instead. For an approximate one over cells see ``cells``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.vectors import RANK_DIGITS
from ..session import settle
from .inverted import InvertedIndex, inverted_index, inverted_search, with_zero_hits
from .tfidf import TfidfModel

MAX_QUERIES = 10_000  # queries one task holds at a time
MAX_QUERY_BYTES = 128 << 20
DOCS_PER_GROUP = 20_000
CELLS = 4_000_000  # score cells a kernel holds at a time


# --- kernels: (documents of one batch, queries) -> scores, higher is better -----------------

def dense_scores(docs: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2sq":
        return -np.stack([np.square(docs - q).sum(axis=1) for q in queries])
    norms = np.outer(np.linalg.norm(queries, axis=1), np.linalg.norm(docs, axis=1))
    dots = queries @ docs.T
    with np.errstate(invalid="ignore"):
        return np.where(norms == 0, 0.0, np.divide(dots, norms, out=np.full_like(dots, np.nan), where=norms > 0))


def comparable(scores: np.ndarray, metric: str) -> np.ndarray:
    """Scores without the noise of summation: cosines at a fixed number of digits, distances at as many significant ones."""
    if metric != "l2sq":
        return np.round(scores, RANK_DIGITS) + 0.0
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = np.power(10.0, np.floor(np.log10(np.abs(scores))) - RANK_DIGITS)
        return np.where(scores == 0, 0.0, np.round(scores / unit) * unit)


def keep_best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query by (score descending, id ascending); scores that are no finite numbers are left out."""
    finite = np.isfinite(scores)
    if not finite.all():
        ids, scores = ids[finite], scores[finite]
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= kth
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _stack(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix; a null entry is NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _search_task(score: Callable[[pa.RecordBatch], np.ndarray], query_ids: list, k: int, schema: StructType, metric: str = "cosine"):
    """A mapInArrow function that keeps a running top-k per query over its task's batches, at most CELLS scores at a time."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, CELLS // max(1, len(query_ids)))
        for batch in batches:
            for start in range(0, batch.num_rows if query_ids else 0, rows):
                yield batch.slice(start, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [None] * len(query_ids)
        for batch in tiles(batches):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            scores = comparable(score(batch), metric)
            for q in range(len(query_ids)):
                found = keep_best(ids, scores[q], k)
                if best[q] is not None:
                    found = keep_best(np.concatenate([best[q][0], found[0]]), np.concatenate([best[q][1], found[1]]), k)
                best[q] = found
        rows = [(query_ids[q], i, s) for q, b in enumerate(best) if b is not None for i, s in zip(*b)]
        if rows:
            arrow = to_arrow_schema(schema)
            columns = [pa.array([r[j] if j < 2 else float(r[j]) for r in rows], type=arrow.field(j).type) for j in range(3)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return run


def _hit_schema(queries: DataFrame, query_id: str, docs: DataFrame, doc_id: str) -> StructType:
    return StructType([
        StructField("query_id", queries.schema[query_id].dataType),
        StructField("id", docs.schema[doc_id].dataType),
        StructField("score", DoubleType()),
    ])


def best_per_query(scored: DataFrame, k: int) -> DataFrame:
    """Rank candidate (query_id, id, score) rows; ties by id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _small_batch(queries: DataFrame, row_bytes: int) -> list | None:
    """The query rows if they are few enough to send to every task, else None."""
    limit = max(1, min(MAX_QUERIES, MAX_QUERY_BYTES // max(1, row_bytes)))
    rows = queries.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def _block_search(q: DataFrame, d: DataFrame, query_id: str, doc_id: str, k: int, schema: StructType,
                  score: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray], metric: str = "cosine") -> DataFrame:
    """Every bounded block of queries meets every bounded part of the documents once; a meeting yields k rows per query."""
    blocks = -(-q.count() // max(1, MAX_QUERIES // 2))
    parts = max(1, -(-d.count() // DOCS_PER_GROUP))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = q.withColumnRenamed(query_id, "query_id").withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("part", numbers(parts))
    right = d.withColumnRenamed(doc_id, "id").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts))).withColumn("block", numbers(blocks))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        step = max(1, CELLS // max(1, len(b)))
        for start in range(0, len(a) if len(b) else 0, step):
            some = a.iloc[start:start + step]
            scores = comparable(score(some, b), metric)
            for name, row in zip(some["query_id"], scores):
                found += [(name, i, s) for i, s in zip(*keep_best(b["id"].to_numpy(), row, k))]
        return pd.DataFrame(found, columns=["query_id", "id", "score"])

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(meet, schema)


# --- dense -----------------------------------------------------------------------------------

def dense_search(queries: DataFrame, docs: DataFrame, k: int = 3, metric: str = "cosine", query_id: str = "query_id", query_vec: str = "embedding",
                 doc_id: str = "id", doc_vec: str = "embedding") -> DataFrame:
    """(query_id, id, rank) with ``similarity``/``distance`` for cosine, ``distance`` for l2sq.

    A zero vector has cosine similarity 0. Null vectors and vectors with NaN or infinite entries are skipped;
    a vector of another length than the first query's fails its task.
    """
    if metric not in ("cosine", "l2sq"):
        raise ValueError(f"unknown metric {metric}")
    schema = _hit_schema(queries, query_id, docs, doc_id)
    q = queries.filter(F.col(query_vec).isNotNull()).select(query_id, F.col(query_vec).cast("array<double>").alias("v"))
    d = docs.filter(F.col(doc_vec).isNotNull()).select(doc_id, F.col(doc_vec).cast("array<double>").alias("v"))
    head = q.select(F.size("v")).first()
    size = head[0] if head else 1
    if head:
        other = F.raise_error(F.format_string(f"a vector has %d entries, the first query {size}", F.size("v"))).cast("array<double>")
        q, d = (x.withColumn("v", F.when(F.size("v") == size, F.col("v")).otherwise(other)) for x in (q, d))
    rows = _small_batch(q, 8 * size)
    if rows is not None:
        ids, matrix = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)

        def score(batch: pa.RecordBatch) -> np.ndarray:
            return dense_scores(_stack(batch.column(1)), matrix, metric)

        candidates = d.mapInArrow(_search_task(score, ids, k, schema, metric), schema)
    else:
        def meeting(a: pd.DataFrame, b: pd.DataFrame) -> np.ndarray:
            return dense_scores(np.stack(b["v"].to_numpy()), np.stack(a["v"].to_numpy()), metric)

        candidates = _block_search(q, d, query_id, doc_id, k, schema, meeting, metric)
    ranked = best_per_query(candidates, k)
    if metric == "l2sq":
        return ranked.select("query_id", "id", "rank", (-F.col("score")).alias("distance"))
    return ranked.select("query_id", "id", "rank", F.col("score").alias("similarity"), (1 - F.col("score")).alias("distance"))


# --- TF-IDF ----------------------------------------------------------------------------------

def index_vectors(model: TfidfModel, df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, indices, weights): the document side of a TF-IDF index."""
    v = F.unwrap_udt(model.output)
    return model.transform(df).select(F.col(id_col).alias("id"), v["indices"].alias("indices"), v["values"].alias("weights"))


def tfidf_search(queries: DataFrame, model: TfidfModel, vectors: DataFrame | InvertedIndex, k: int = 3, query_id: str = "query_id", query_text: str = "text",
                 fill_zero: bool = True) -> DataFrame:
    """(query_id, id, rank, similarity, distance) by cosine over the index, which is inverted first if it is not.

    Postings that can't reach a query's first k are not read; no query meets documents without a term of it. With
    ``fill_zero`` a query with fewer than k matching documents is filled up with documents at similarity 0,
    lowest id first. The rows of one query id are one query.
    """
    text_col = model.stages[0].getInputCol()
    index = vectors if isinstance(vectors, InvertedIndex) else inverted_index(vectors)
    q = settle(index_vectors(model, queries.select(F.col(query_id).alias("id"), F.col(query_text).alias(text_col))).withColumnRenamed("id", "query_id"), "queries")
    hits = inverted_search(q, index, k)
    if fill_zero:
        hits = with_zero_hits(settle(hits, "hits"), q, index, k)
    return hits.select("query_id", "id", "rank", F.col("score").alias("similarity"), (1 - F.col("score")).alias("distance"))


def postings(vectors: DataFrame) -> DataFrame:
    """(id, index, weight) rows of an index."""
    return vectors.select("id", F.explode(F.arrays_zip("indices", "weights")).alias("e")).select(
        "id", F.col("e.indices").alias("index"), F.col("e.weights").alias("weight"))


def attach_documents(hits: DataFrame, docs: DataFrame, doc_id: str = "id") -> DataFrame:
    """Hits with the document's other columns. AQE broadcasts the hits when they turn out small."""
    return hits.join(docs.withColumnRenamed(doc_id, "id") if doc_id != "id" else docs, "id")
