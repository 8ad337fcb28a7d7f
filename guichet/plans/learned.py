"""Stored tables, trained models and streams."""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import cascade as C, evaluation as E, sampling as S, tfidf as W
from ..schema import URGENCY_LABELS
from ..session import fresh_path, settle
from ..sources import models_dir, runlog, tables
from ..streaming import monitor, scoring
from .registry import built_once, query
from .standin import SQL_BALANCED, SQL_TICKETS, sql_split, sql_terms, sql_vocab, table, ticket_columns, tickets
from .tabular import balanced, r6

PARALLEL_FOLDS = 5
# The library trains on 50,000 terms for 2,000 solver steps by default. At those settings the fits of the registered
# run did not end within 400 s on the smallest tables, so it is bounded: the most frequent terms and fewer steps.
TRAINING_TERMS, TRAINING_STEPS = 1_000, 200


# --- stored tables -------------------------------------------------------------------------------

@query(f"""WITH {SQL_TICKETS} SELECT "ID", md5(texte) AS texte_md5, titre, categorie, urgence, round(temps_resolution, 6) AS temps_resolution, type_ticket, nb_mots FROM tickets""")
def csv_roundtrip(spark, sf):
    path = fresh_path(spark, "tickets-csv")
    tables.write_csv(tickets(spark, sf).drop("text_full").select(*[f.split()[0] for f in tables.TICKET_SCHEMA.split(", ")]), path)
    return tables.read_tickets_csv(spark, path).select("ID", F.md5("texte").alias("texte_md5"), "titre", "categorie", "urgence", *r6("temps_resolution"), "type_ticket", "nb_mots")


@query("SELECT doc_id::varchar AS id, md5(text) AS text_md5, lang AS langue, source AS origine FROM documents")
def json_roundtrip(spark, sf):
    path = fresh_path(spark, "documents-json")
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text",
                                                F.create_map(F.lit("langue"), "lang", F.lit("origine"), "source").alias("metadata"))
    tables.write_documents(docs, path)
    return tables.read_documents(spark, path).select("id", F.md5("text").alias("text_md5"), F.col("metadata.langue").alias("langue"), F.col("metadata.origine").alias("origine"))


@query("""SELECT event_type AS model, payload, last_updated::varchar AS last_updated FROM (SELECT event_type, props AS payload, ts AS last_updated,
  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, props DESC) AS r FROM events) WHERE r = 1""")
def metadata_upsert(spark, sf):
    log = table(spark, sf, "events").select(F.col("event_type").alias("model"), F.col("props").alias("payload"), F.col("ts").alias("updated_at"))
    return runlog.latest_metadata(log).select("model", "payload", F.col("last_updated").cast("string").alias("last_updated"))


# --- trained models ------------------------------------------------------------------------------

# Training itself has no SQL. What it must keep has: the rows of each split, whole predictions, block sizes, and scores
# that beat what the labels alone would give.

def trained(spark, sf) -> C.CascadeRun:
    """The cascade on balanced tickets, split by origin so copies of a ticket stay together: at the bounded settings above."""

    def build():
        parts = S.stratified_split(balanced(spark, sf), group_col="origin")
        return C.train_cascade(parts, replace(W.MODEL_TFIDF, max_features=TRAINING_TERMS), group_col="origin", parallelism=PARALLEL_FOLDS, max_iter=TRAINING_STEPS)

    return built_once(spark, sf, "cascade", build)


_ORIGIN_SPLIT = f"""WITH {SQL_BALANCED}, origins AS (SELECT DISTINCT origin, urgence FROM balanced), {sql_split('origins', key='origin')},
  parts AS (SELECT b.*, s.split FROM balanced b JOIN split_rows s ON b.origin = s.origin)"""


def _sql_rows(target: str) -> str:
    return f"{_ORIGIN_SPLIT} SELECT split, count(*) AS n, true AS beats_chance FROM parts WHERE {target} IS NOT NULL GROUP BY 1"


def _scores(df, target, prediction):
    """Rows per split, and whether accuracy is above the share that guessing by label frequency gets."""
    labelled = df.filter(F.col(target).isNotNull())
    share = labelled.groupBy("split", target).agg(F.count("*").alias("k")).groupBy("split").agg((F.sum(F.col("k") * F.col("k")) / F.sum("k") / F.sum("k")).alias("chance"))
    found = E.accuracy_f1(labelled, target, prediction, ["split"]).join(share, "split")
    return found.select("split", "n", (F.col("accuracy") > F.col("chance")).alias("beats_chance"))


@query(_sql_rows("urgence"))
def train_urgency(spark, sf):
    return _scores(trained(spark, sf).scored, "urgence", "urgence_pred")


@query(_sql_rows("categorie"))
def train_category(spark, sf):
    return _scores(trained(spark, sf).scored, "categorie", "categorie_pred")


@query(f"{_ORIGIN_SPLIT} SELECT split, count(*) AS n, count(*) AS n_predicted FROM parts WHERE type_ticket IS NOT NULL GROUP BY 1")
def train_type(spark, sf):
    """The stand-in's types hardly depend on the text, so no accuracy is promised, only whole predictions."""
    labelled = trained(spark, sf).scored.filter("type_ticket IS NOT NULL")
    return labelled.groupBy("split").agg(F.count("*").alias("n"), F.count("type_ticket_pred").alias("n_predicted"))


@query(_sql_rows("temps_resolution"))
def train_time(spark, sf):
    """Rows per split, and whether errors are smaller than those of the mean (R2 above 0)."""
    found = E.regression_metrics(trained(spark, sf).scored, "temps_resolution", "temps_resolution_pred", ["split"])
    return found.select("split", "n", (F.col("r2") > 0).alias("beats_chance"))


@query(f"""{_ORIGIN_SPLIT}, train AS (SELECT * FROM parts WHERE split = 'train'), {sql_terms('train', '"ID"', 'text_full', True)}, {sql_vocab('train', 2, TRAINING_TERMS)}
  SELECT m.model, (SELECT count(*) FROM vocab) AS text, 1::bigint AS numeric, true AS one_hot_fits, true AS adds_up, (SELECT count(*) FROM train) AS train_rows
  FROM (VALUES ('urgency'), ('category'), ('type'), ('time')) m(model)""")
def feature_vectors(spark, sf):
    """Block sizes of each model, beside the labels that its upstream predictions can have."""
    run = trained(spark, sf)
    rows = [(m, b["text"], b["numeric"], b["one_hot"], b["total"]) for m, b in run.cascade.feature_blocks.items()]
    blocks = spark.createDataFrame(rows, "model string, text long, numeric long, one_hot long, total long")
    used = run.scored.filter("split = 'train'")
    typed = F.col("type_ticket").isNotNull()  # the type model is fitted on these rows only
    labels = used.agg(F.count("*").alias("train_rows"), *[F.count_distinct(c).alias(c) for c in ("urgence_pred", "categorie_pred", "type_ticket_pred")],
                      (F.count_distinct(F.when(typed, F.col("urgence_pred"))) + F.count_distinct(F.when(typed, F.col("categorie_pred")))).alias("typed_labels"))
    u, c, t = F.col("urgence_pred"), F.col("categorie_pred"), F.col("type_ticket_pred")
    expected = F.when(F.col("model") == "urgency", 0).when(F.col("model") == "category", u).when(F.col("model") == "type", F.col("typed_labels")).otherwise(u + c + t)
    return blocks.join(F.broadcast(labels)).select(  # one row
        "model", "text", "numeric", (F.col("one_hot") == expected).alias("one_hot_fits"),
        (F.col("total") == F.col("text") + F.col("numeric") + F.col("one_hot")).alias("adds_up"), "train_rows")


@query(f"""{_ORIGIN_SPLIT} SELECT "ID", split, urgence, categorie, type_ticket, 4 AS n_predictions, true AS known FROM parts""")
def oof_predictions(spark, sf):
    """Every balanced ticket with its split, labels and how many predictions it has; train rows are predicted out of fold."""
    scored = trained(spark, sf).scored
    n = sum(F.col(c).isNotNull().cast("int") for c in _PREDICTED)
    known = F.col("urgence_pred").isin(URGENCY_LABELS) & F.col("type_ticket_pred").isin("Demande", "Incident") & (F.col("temps_resolution_pred") >= 0)
    return scored.select("ID", "split", "urgence", "categorie", "type_ticket", n.alias("n_predictions"), known.alias("known"))


_PREDICTED = ("urgence_pred", "categorie_pred", "type_ticket_pred", "temps_resolution_pred")
_STATUS = f"WITH {SQL_TICKETS}, s AS (SELECT \"ID\", CASE WHEN text_full = '' THEN 'empty' WHEN nb_mots < 2 THEN 'too_short' ELSE 'ok' END AS status FROM tickets)"
_SAME = f"{_STATUS} SELECT status, count(*) AS n, 0::bigint AS n_different FROM s GROUP BY 1"


def batch_scores(spark, sf):
    """All tickets scored; stored, because two more queries compare with it."""
    return built_once(spark, sf, "scores", lambda: settle(C.score_tickets(tickets(spark, sf, typed=False), trained(spark, sf).cascade).select("ID", "status", *_PREDICTED)))


def _compared(scores, batch):
    """Rows per status, and how many have other predictions than the batch, or none there."""
    other = batch.select(F.col("ID").alias("_id"), F.struct("status", *_PREDICTED).alias("_other"))
    same = F.struct("status", *_PREDICTED).eqNullSafe(F.col("_other"))
    return scores.join(other, F.col("ID") == F.col("_id"), "left").groupBy("status").agg(F.count("*").alias("n"), F.count_if(~same).alias("n_different"))


@query(f"{_STATUS} SELECT \"ID\", status, CASE WHEN status = 'ok' THEN 4 ELSE 0 END AS n_predictions FROM s")
def cascade_score(spark, sf):
    scores = batch_scores(spark, sf)
    return scores.select("ID", "status", sum(F.col(c).isNotNull().cast("int") for c in _PREDICTED).alias("n_predictions"))


@query(_SAME)
def model_roundtrip(spark, sf):
    """Predictions of the cascade after saving and loading it, against those before."""
    path = fresh_path(spark, "cascade")
    models_dir.save_cascade(trained(spark, sf).cascade, path)
    return _compared(C.score_tickets(tickets(spark, sf, typed=False), models_dir.load_cascade(spark, path)), batch_scores(spark, sf))


# --- streams -------------------------------------------------------------------------------------

def _stream(spark, sf, name):
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(os.path.join(sf, f"{name}.parquet*"))


@query(_SAME)
def stream_score(spark, sf):
    """Predictions of the stream against those of the batch."""
    out, state = fresh_path(spark, "scored"), fresh_path(spark, "scored-state")
    arriving = ticket_columns(_stream(spark, sf, "documents")).select("ID", "titre", "texte")
    scoring.score_stream(arriving, trained(spark, sf).cascade, out, state, once=True).awaitTermination()
    return _compared(spark.read.parquet(out), batch_scores(spark, sf))


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
  SELECT strftime(window_start, '%Y-%m-%d %H:%M') AS window_start, event_type, n, round(n * 100.0::double / sum(n) OVER (PARTITION BY window_start), 6) AS pct FROM w""")
def stream_distribution(spark, sf):
    """Every window of the stream, those still open at its end included."""
    state, name = fresh_path(spark, "windows-state"), fresh_path(spark, "windows")
    counts = monitor.class_distribution_stream(_stream(spark, sf, "events"), "ts", "event_type")
    monitor.write_windows(counts, name, state, once=True).awaitTermination()
    shares = monitor.with_window_share(monitor.latest_windows(spark.read.parquet(name), "event_type"))
    return shares.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n", *r6("pct"))
