"""Queries on tables that are kept and grow: sketches by day, stage tables by split, embeddings of texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import search as R
from ..session import fresh_path, settle
from ..sources import sketches, stores, tables
from .registry import query
from .standin import table
from .tabular import _SPLIT, r6, split_tickets


@query("""SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, min(value) AS least, max(value) AS most,
  round(count(*) * 100.0::double / (SELECT count(*) FROM events), 6) AS pct, count(DISTINCT user_id) AS n_users,
  true AS users_near, true AS median_near FROM events GROUP BY 1""")
def daily_profile(spark, sf):
    """Profiles merged from sketches by day, the later days stored twice, beside the exact counts of the same rows."""
    events, path = table(spark, sf, "events"), fresh_path(spark, "days")
    days = settle(sketches.daily_sketches(events, "ts", "event_type", "user_id", "value"), "sketched")
    sketches.store_days(days, path)
    sketches.store_days(days.filter("day >= DATE '2024-01-16'"), path)  # delivered again: replaced, not added
    merged = sketches.merged_profile(sketches.read_days(spark, path), quantiles=(0.5,))
    near = events.join(merged.select(F.col("label").alias("_label"), "q50"), F.col("event_type").eqNullSafe(F.col("_label")))
    exact = near.groupBy(F.col("event_type").alias("_type")).agg(
        F.count_distinct("user_id").alias("n_users"), F.avg((F.col("value") < F.col("q50")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("q50")).cast("double")).alias("upto"))
    both = merged.join(exact, F.col("label").eqNullSafe(F.col("_type")))
    return both.select(F.col("label").alias("event_type"), "n", F.round("total", 4).alias("total"), "least", "most", *r6("pct"), "n_users",
                       (F.abs(F.col("n_keys") - F.col("n_users")) <= 0.065 * F.col("n_users")).alias("users_near"),
                       ((F.col("below") <= 0.51) & (F.col("upto") >= 0.49)).alias("median_near"))


@query(f"""{_SPLIT} SELECT "ID", split, CASE WHEN split = 'validation' THEN 'again' ELSE 'first' END AS urgence_pred FROM split_rows WHERE split <> 'train'""")
def stage_replace(spark, sf):
    """A stage table with a folder per split whose validation split is made anew, read without its train split."""
    path, rows = fresh_path(spark, "stage"), split_tickets(spark, sf).select("ID", "split").withColumn("urgence_pred", F.lit("first"))
    tables.write_table(rows, path, split="split")
    tables.replace_splits(rows.filter("split = 'validation'").withColumn("urgence_pred", F.lit("again")), path)
    return tables.read_stage(spark, path, "urgence", ("validation", "test")).select("ID", "split", "urgence_pred")


def letter_shares():
    """An embedder without weights: the share of each of the 26 letters in a text, either case."""
    letters = [chr(c) for c in range(97, 123)]
    small = {ord(c.upper()): c for c in letters}

    def embed(texts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(texts), 26), np.float32)
        for row, text in zip(out, texts, strict=True):
            t = (text or "").translate(small)
            row[:] = [t.count(c) / max(len(t), 1) for c in letters]
        return out

    return embed


@query("""WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  e AS (SELECT doc_id, list_transform(range(97, 123), lambda c: ((length(t) - length(replace(t, chr(c::int), '')))::double / greatest(length(t), 1))::float::double) AS v FROM t),
  s AS (SELECT q.doc_id AS query_id, d.doc_id AS id, CASE WHEN list_dot_product(d.v, d.v) > 0 AND list_dot_product(q.v, q.v) > 0 THEN
    round(list_dot_product(q.v, d.v) / (sqrt(list_dot_product(d.v, d.v)) * sqrt(list_dot_product(q.v, q.v))), 9) ELSE 0 END AS s FROM e q CROSS JOIN e d WHERE q.doc_id % 50 = 0)
  SELECT query_id, id, rank, round(s, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM s) WHERE rank <= 3""")
def embedding_search(spark, sf):
    """Documents embedded in batches by a model that each worker loads once, stored as an index and searched."""
    docs, path = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")), fresh_path(spark, "embedded")
    stores.save_dense_index(stores.embed(docs, letter_shares), path, "letters")
    index = stores.load_dense_index(spark, path, "letters").select("id", "embedding")
    queries = index.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    return R.dense_search(queries, index, 3).select("query_id", "id", "rank", *r6("similarity"))
