"""Text, TF-IDF, search and answer queries."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..functions import text as T, vectors as V
from ..operators import answers as A, cells as C, evaluation as E, features as X, models as M, prepare as P, search as R, tfidf as W
from ..session import fresh_path, settle
from ..sources import segments, stores
from .registry import built_once, query
from .standin import SQL_PREDICTIONS, SQL_TICKETS, predictions, sql_terms, sql_vocab, sql_weights, sql_word_count, table, tickets
from .tabular import r6

# --- scalar functions ----------------------------------------------------------------------------


@query(f"""WITH w AS (SELECT *, regexp_extract_all(strip_accents(lower(text)), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM documents)
  SELECT doc_id, md5(strip_accents(lower(text))) AS folded_md5, {sql_word_count('text')} AS n_words, len(w) AS n_tokens,
    len(w) + greatest(len(w) - 1, 0) AS n_grams, md5(array_to_string(w, ' ')) AS tokens_md5, substr(text, 1, 200) AS preview,
    array_to_string(list_slice(string_split(text, chr(10)), 1, 4), chr(10)) AS head, contains(lower(text), 'the') AS has_the,
    repeat('█', floor((n_chars % 100) / 2.0)::bigint) AS bar FROM w""")
def scalar_text(spark, sf):
    d = table(spark, sf, "documents").withColumn("w", T.tokens("text"))
    return d.select(
        "doc_id", F.md5(T.fold_accents(F.lower("text"))).alias("folded_md5"), T.word_count("text").alias("n_words"), F.size("w").alias("n_tokens"),
        F.size(T.ngrams("w")).alias("n_grams"), F.md5(F.array_join("w", " ")).alias("tokens_md5"), T.preview("text").alias("preview"),
        T.first_lines("text").alias("head"), T.contains_any("text", ["the"]).alias("has_the"), T.percent_bar(F.col("n_chars") % 100).alias("bar"))


@query("""SELECT l_orderkey, l_linenumber, round(sqrt(l_extendedprice), 6) AS root, round(abs(l_quantity - 25), 6) AS distance,
  greatest(l_quantity - 25, 0) AS clamped, trunc(l_extendedprice)::bigint AS whole, round(l_discount * 100 / (1 + l_tax), 6) AS pct,
  round(1 + ln(l_quantity), 6) AS log_count FROM lineitem""")
def scalar_numeric(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.sqrt("l_extendedprice"), 6).alias("root"), F.round(F.abs(F.col("l_quantity") - 25), 6).alias("distance"),
        P.clamp_non_negative(F.col("l_quantity") - 25).alias("clamped"), F.col("l_extendedprice").cast("long").alias("whole"),
        F.round(V.to_percent("l_discount") / (1 + F.col("l_tax")), 6).alias("pct"), F.round(1 + F.log("l_quantity"), 6).alias("log_count"))


@query("""WITH m AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), x AS (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM m)
  SELECT doc_id, i::int AS place, md5(lines[i]) AS line_md5, md5(lines[len(lines) + 1 - i]) AS mirror_md5, i || '/' || len(lines) AS label,
    array_to_string(list_slice(lines, 1, 2), ', ') AS first_two FROM x""")
def scalar_array_map(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    both = F.posexplode(F.arrays_zip("l", F.reverse("l").alias("r"))).alias("i", "z")
    return lines.select("doc_id", F.array_join(F.slice("l", 1, 2), ", ").alias("first_two"), F.size("l").alias("n"), both).select(
        "doc_id", (F.col("i") + 1).alias("place"), F.md5("z.l").alias("line_md5"), F.md5("z.r").alias("mirror_md5"),
        F.format_string("%d/%d", F.col("i") + 1, F.col("n")).alias("label"), "first_two")


@query("""SELECT event_id, json_extract(props, '$.k')::bigint AS k, '{"event_type":"' || event_type || '","k":' || json_extract(props, '$.k') || '}' AS packed FROM events""")
def json_fields(spark, sf):
    e = table(spark, sf, "events").withColumn("p", F.from_json("props", "k bigint"))
    return e.select("event_id", "p.k", F.to_json(F.struct("event_type", F.col("p.k").alias("k"))).alias("packed"))


@query(f"""WITH {SQL_TICKETS} SELECT "ID" AS id, 'en' AS langue, CASE WHEN type_ticket IS NULL THEN 'N/A' ELSE type_ticket END AS type,
  'N/A' AS operateur FROM tickets WHERE categorie LIKE 'en/%'""")
def doc_metadata_lookup(spark, sf):
    t = tickets(spark, sf)
    entries = F.filter(F.array(F.struct(F.lit("langue").alias("k"), F.substring_index("categorie", "/", 1).alias("v")),
                               F.struct(F.lit("type").alias("k"), F.col("type_ticket").alias("v"))), lambda e: e["v"].isNotNull())
    docs = t.select(F.col("ID").alias("id"), F.map_from_entries(entries).alias("metadata"))
    return docs.filter(T.metadata_get("metadata", "langue") == "en").select(
        "id", T.metadata_get("metadata", "langue").alias("langue"), T.metadata_get("metadata", "type").alias("type"),
        T.metadata_get("metadata", "operateur").alias("operateur"))


# --- features ------------------------------------------------------------------------------------

@query(f"""WITH {SQL_PREDICTIONS}, labels_seen AS (SELECT DISTINCT urgence_pred AS c FROM predictions WHERE split = 'train')
  SELECT p."ID", l.c AS category, 1.0::double AS value FROM predictions p JOIN labels_seen l ON p.urgence_pred = l.c""")
def one_hot(spark, sf):
    p = predictions(spark, sf)
    stages, hot = X.fit_one_hot(p.filter("split = 'train'"), ["urgence_pred"])
    names = F.array(*[F.lit(v) for v in stages[0].labelsArray[0]])
    for stage in stages:
        p = stage.transform(p)
    return W.vector_entries(p, ["ID"], hot[0]).select("ID", F.get(names, F.col("index")).alias("category"), F.col("weight").alias("value"))


@query(f"""WITH {SQL_TICKETS}, c AS (SELECT urgence, count(*) AS n FROM tickets GROUP BY 1)
  SELECT urgence, n, round(sum(n) OVER () / (count(*) OVER () * n)::double, 6) AS weight FROM c""")
def class_weights(spark, sf):
    return X.class_weights(tickets(spark, sf, typed=False), "urgence").select("urgence", "n", *r6("weight"))


@query(f"""WITH {SQL_TICKETS}, s AS (SELECT avg(nb_mots) AS m, stddev_pop(nb_mots) AS d FROM tickets)
  SELECT "ID", nb_mots, round((nb_mots - m) / d, 6) AS nb_mots_scaled FROM tickets, s""")
def standardize(spark, sf):
    return X.standardize(tickets(spark, sf, typed=False), ["nb_mots"]).select("ID", "nb_mots", *r6("nb_mots_scaled"))


# --- TF-IDF --------------------------------------------------------------------------------------

_MODEL_TF = f"WITH {SQL_TICKETS}, {sql_terms('tickets', '\"ID\"', 'text_full', True)}, {sql_vocab('tickets', 2, 50_000)}"


def model_text(spark, sf):
    return built_once(spark, sf, "model_text", lambda: W.fit_tfidf(tickets(spark, sf, typed=False), W.MODEL_TFIDF))


@query(f"{_MODEL_TF} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab")
def tfidf_vocab(spark, sf):
    t = tickets(spark, sf, typed=False)
    return W.vocabulary(W.candidate_statistics(t, W.MODEL_TFIDF), table(spark, sf, "documents").count(), W.MODEL_TFIDF).select("term", "df", "cf", *r6("idf"))


@query(f"{_MODEL_TF}, {sql_weights('tf', 'weights', True)} SELECT id AS \"ID\", term, round(w, 6) AS weight FROM weights")
def tfidf_weights(spark, sf):
    return W.tfidf_weights(model_text(spark, sf), tickets(spark, sf, typed=False)).select("ID", "term", *r6("weight"))


@query(f"""{_MODEL_TF} SELECT 'text' AS block, (SELECT count(*) FROM vocab) AS size UNION ALL SELECT 'numeric', 1 UNION ALL
  SELECT 'one_hot', (SELECT count(DISTINCT urgence) FROM tickets) UNION ALL
  SELECT 'total', (SELECT count(*) FROM vocab) + 1 + (SELECT count(DISTINCT urgence) FROM tickets)""")
def feature_blocks(spark, sf):
    stage, text = M.Stage("blocks", "urgence", "urgence_pred", categorical=("urgence",)), model_text(spark, sf)
    stages, _ = M.feature_stages(tickets(spark, sf, typed=False), stage, text.output)
    return spark.createDataFrame(list(M.block_sizes(text, PipelineModel(stages), stage).items()), "block string, size long")


_CHUNK = """'Ticket ID: ' || "ID" || chr(10) || 'Titre: ' || titre || chr(10) || 'Catégorie: ' || categorie || chr(10) || 'Urgence: ' || urgence || chr(10) ||
  'Type: ' || coalesce(type_ticket, '') || chr(10) || 'Temps de résolution: ' || temps_resolution::varchar || ' heures' || chr(10) || chr(10) || 'Texte: ' || text_full"""
_CHUNKS = f"WITH {SQL_TICKETS}, chunks AS (SELECT \"ID\" AS id, {_CHUNK} AS chunk, categorie, urgence, type_ticket FROM tickets)"
_INDEX = f"{_CHUNKS}, {sql_terms('chunks', 'id', 'chunk', False)}, {sql_vocab('chunks', 1, 1_000)}, {sql_weights('tf', 'docs', False)}"
_SEARCH = f"""{_INDEX}, {sql_terms('benchmark', 'item_id', 'text', False, 'q')}, {sql_weights('qtf', 'asked', False)},
  sims AS (SELECT q.id AS query_id, d.id, round(sum(q.w * d.w), 9) AS s FROM asked q JOIN docs d ON q.term = d.term GROUP BY 1, 2),
  pairs AS (SELECT b.item_id AS query_id, c.id, coalesce(s.s, 0) AS s FROM benchmark b CROSS JOIN chunks c LEFT JOIN sims s ON s.query_id = b.item_id AND s.id = c.id),
  hits AS (SELECT * FROM (SELECT query_id, id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM pairs) WHERE rank <= 3)"""


@query(f"{_CHUNKS} SELECT id, chunk, categorie, urgence, type_ticket FROM chunks")
def chunks(spark, sf):
    return P.build_chunks(tickets(spark, sf)).select("id", "chunk", "metadata.categorie", "metadata.urgence", "metadata.type_ticket")


def ticket_index(spark, sf) -> stores.TfidfIndex:
    """The index is built and written once; queries read the stored tables."""

    def build():
        path = fresh_path(spark, "ticket-index")
        stores.save_tfidf_index(stores.build_tfidf_index(P.build_chunks(tickets(spark, sf))), path)
        return stores.load_tfidf_index(spark, path)

    return built_once(spark, sf, "ticket_index", build)


def ticket_hits(spark, sf):
    index = ticket_index(spark, sf)
    asked = table(spark, sf, "benchmark")
    return built_once(spark, sf, "ticket_hits", lambda: settle(R.tfidf_search(asked, index.model, index.inverted, 3, "item_id", "text")))


@query(f"{_INDEX} SELECT id, term, round(w, 6) AS weight FROM docs")
def tfidf_index_weights(spark, sf):
    index = ticket_index(spark, sf)
    return W.tfidf_weights(index.model, index.chunks, "id").select("id", "term", *r6("weight"))


@query(f"{_INDEX} SELECT v.term, v.df, v.cf, round(v.idf, 6) AS idf, count(d.id) AS n_postings, round(sum(d.w), 6) AS total_weight FROM vocab v JOIN docs d ON d.term = v.term GROUP BY ALL")
def index_build_tfidf(spark, sf):
    index = ticket_index(spark, sf)
    per_term = R.postings(index.vectors).groupBy("index").agg(F.count("*").alias("n_postings"), F.sum("weight").alias("total_weight"))
    return index.model.vocab.join(per_term, "index").select("term", "df", "cf", *r6("idf"), "n_postings", *r6("total_weight"))


@query(f"{_SEARCH} SELECT query_id, id, rank, round(s, 6) AS similarity, round(1 - s, 6) AS distance FROM hits")
def tfidf_search(spark, sf):
    index = ticket_index(spark, sf)
    return R.tfidf_search(table(spark, sf, "benchmark"), index.model, index.inverted, 3, "item_id", "text").select(
        "query_id", "id", "rank", *r6("similarity", "distance"))


_TURNS = f"""{_INDEX}, asked_turns AS (SELECT conv_id || '/' || turn AS query_id, text FROM conversations),
  {sql_terms('asked_turns', 'query_id', 'text', False, 'q')}, {sql_weights('qtf', 'asked', False)},
  sims AS (SELECT q.id AS query_id, d.id, round(sum(q.w * d.w), 9) AS s FROM asked q JOIN docs d ON q.term = d.term GROUP BY 1, 2),
  hits AS (SELECT * FROM (SELECT query_id, id, s, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM sims WHERE s > 0) WHERE rank <= 5)"""


def asked_turns(spark, sf):
    return table(spark, sf, "conversations").select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"), "text")


@query(f"{_TURNS} SELECT query_id, id, rank, round(s, 6) AS similarity FROM hits")
def tfidf_search_turns(spark, sf):
    """A batch that grows with its table: every turn of every conversation, without documents at similarity 0."""
    index = ticket_index(spark, sf)
    return R.tfidf_search(asked_turns(spark, sf), index.model, index.inverted, 5, fill_zero=False).select("query_id", "id", "rank", *r6("similarity"))


@query(f"""{_SEARCH} SELECT h.query_id, h.rank, h.id, round(h.s, 6) AS similarity, c.categorie, c.urgence, coalesce(c.type_ticket, 'N/A') AS type_ticket,
  array_to_string(list_slice(string_split(c.chunk, chr(10)), 1, 4), chr(10)) AS head FROM hits h JOIN chunks c ON h.id = c.id""")
def search_report(spark, sf):
    found = R.attach_documents(ticket_hits(spark, sf), ticket_index(spark, sf).chunks)
    return found.select("query_id", "rank", "id", *r6("similarity"), "metadata.categorie", "metadata.urgence",
                        F.coalesce("metadata.type_ticket", F.lit("N/A")).alias("type_ticket"), T.first_lines("chunk").alias("head"))


# --- dense search --------------------------------------------------------------------------------

_CENTRES = """WITH e AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
  m AS (SELECT label, i, avg(x::double) AS x FROM e GROUP BY 1, 2), centres AS (SELECT label AS query_id, list(x ORDER BY i) AS v FROM m GROUP BY 1),
  docs AS (SELECT vec_id AS id, embedding::double[] AS v FROM embeddings)"""


def centres(spark, sf):
    """The mean vector of each label: a query set that grows with labels, not with rows."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"])
    return means.groupBy(F.col("label").alias("query_id")).agg(ordered.alias("embedding"))


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@query(f"""{_CENTRES}, s AS (SELECT c.query_id, d.id, CASE WHEN list_dot_product(d.v, d.v) > 0 AND list_dot_product(c.v, c.v) > 0 THEN
    round(list_dot_product(c.v, d.v) / (sqrt(list_dot_product(d.v, d.v)) * sqrt(list_dot_product(c.v, c.v))), 9) ELSE 0 END AS s FROM centres c CROSS JOIN docs d)
  SELECT query_id, id, rank, round(s, 6) AS similarity, round(1 - s, 6) AS distance FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS rank FROM s) WHERE rank <= 3""")
def dense_search_cosine(spark, sf):
    return R.dense_search(centres(spark, sf), _vectors(spark, sf), 3).select("query_id", "id", "rank", *r6("similarity", "distance"))


@query(f"""{_CENTRES}, s AS (SELECT c.query_id, d.id, round(list_sum(list_transform(range(1, len(c.v) + 1), lambda i: (c.v[i] - d.v[i]) * (c.v[i] - d.v[i]))), 9) AS s
    FROM centres c CROSS JOIN docs d)
  SELECT query_id, id, rank, round(s, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s, id) AS rank FROM s) WHERE rank <= 2""")
def dense_search_l2(spark, sf):
    return R.dense_search(centres(spark, sf), _vectors(spark, sf), 2, "l2sq").select("query_id", "id", "rank", *r6("distance"))


def _tuned_cells(spark, sf):
    return built_once(spark, sf, "cells", lambda: C.tune_probes(C.build_cells(_vectors(spark, sf))))


def _every_fiftieth(spark, sf):
    return _vectors(spark, sf).filter("id % 50 = 0").withColumnRenamed("id", "query_id")


@query()
def dense_search_cells(spark, sf):
    """The ten nearest rows of every fiftieth vector by the approximate index; no SQL, for its cells are fitted."""
    return C.cell_search(_every_fiftieth(spark, sf), _tuned_cells(spark, sf), 10).select("query_id", "id", "rank", *r6("similarity", "distance"))


@query("""WITH q AS (SELECT vec_id, embedding::double[] AS v FROM embeddings WHERE vec_id % 50 = 0)
  SELECT count(*) AS n_queries, 10 * count(*) AS n_exact, true AS recall_of_nine_tenths FROM q""")
def dense_cells_recall(spark, sf):
    """Whether the approximate index finds nine tenths of what the exact search does."""
    q = _every_fiftieth(spark, sf)
    exact = settle(R.dense_search(q, _vectors(spark, sf), 10), "exact")
    found = C.recall(C.cell_search(q, _tuned_cells(spark, sf), 10), exact)
    return exact.agg(F.count_distinct("query_id").alias("n_queries"), F.count("*").alias("n_exact")).withColumn("recall_of_nine_tenths", F.lit(found >= 0.9))


@query(f"""{_CENTRES}, own AS (SELECT e.vec_id, e.embedding::double[] AS a, c.v AS b FROM embeddings e JOIN centres c ON e.label = c.query_id)
  SELECT vec_id, round(list_dot_product(a, b), 6) AS dot, round(sqrt(list_dot_product(a, a)), 6) AS norm,
    CASE WHEN list_dot_product(a, a) > 0 AND list_dot_product(b, b) > 0 THEN round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) ELSE 0 END AS cosine,
    round(list_sum(list_transform(range(1, len(a) + 1), lambda i: (a[i] - b[i]) * (a[i] - b[i]))), 6) AS l2sq FROM own""")
def vector_functions(spark, sf):
    own = table(spark, sf, "embeddings").join(centres(spark, sf).select(F.col("query_id").alias("label"), F.col("embedding").alias("centre")), "label")
    return own.select("vec_id", F.round(V.dot("embedding", "centre"), 6).alias("dot"), F.round(V.l2_norm("embedding"), 6).alias("norm"),
                      F.round(V.cosine("embedding", "centre"), 6).alias("cosine"), F.round(V.squared_l2("embedding", "centre"), 6).alias("l2sq"))


@query("""SELECT vec_id AS id, len(embedding) AS size, round(list_sum(embedding::double[]), 4) AS total, 'given' AS model_name FROM embeddings""")
def index_build_dense(spark, sf):
    path = fresh_path(spark, "dense-index")
    stores.save_dense_index(_vectors(spark, sf), path, "given")
    return stores.load_dense_index(spark, path, "given").select(
        "id", F.size("embedding").alias("size"),
        F.round(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, b: a + b), 4).alias("total"), "model_name")


@query("""SELECT vec_id AS id, len(embedding) AS size, round(CASE WHEN l.doc_id IS NULL THEN 1 ELSE -1 END * list_sum(embedding::double[]), 4) AS total
  FROM embeddings LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l ON doc_id = vec_id WHERE coalesce(toxic, 0) = 0""")
def index_segments(spark, sf):
    """All vectors are stored; then those that the labels call toxic are deleted and the other labelled ones replaced by their opposites."""
    path = fresh_path(spark, "segments")
    given, labels = _vectors(spark, sf), table(spark, sf, "labels").groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    segments.change(path, given)
    clean = given.join(labels.filter("coalesce(toxic, 0) = 0").select("id"), "id")
    segments.change(path, clean.withColumn("embedding", F.transform("embedding", lambda x: -x)).select(given.columns), labels.filter("toxic <> 0"))
    return segments.read(spark, path).select("id", F.size("embedding").alias("size"), F.round(F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, b: a + b), 4).alias("total"))


# --- answers -------------------------------------------------------------------------------------

_CONTEXT = f"""{_SEARCH}, contexts AS (SELECT h.query_id, string_agg('[Document ' || h.rank || ' - ' || h.id || ']' || chr(10) || c.chunk, chr(10) || chr(10) ORDER BY h.rank) AS context,
    string_agg(h.id, ', ' ORDER BY h.rank) AS sources, string_agg(round((1 - (1 - h.s)) * 100, 1)::varchar, '|' ORDER BY h.rank) AS percents
  FROM hits h JOIN chunks c ON h.id = c.id GROUP BY 1)"""
_A, _B, _C = (p.replace("'", "''").replace("\n", "' || chr(10) || '") for p in A.PROMPT_PARTS)
_PROMPT = f"{_CONTEXT}, prompts AS (SELECT b.item_id AS query_id, b.text AS question, '{_A}' || c.context || '{_B}' || b.text || '{_C}' AS prompt, c.sources FROM benchmark b JOIN contexts c ON c.query_id = b.item_id)"


def ticket_contexts(spark, sf):
    found = R.attach_documents(ticket_hits(spark, sf), ticket_index(spark, sf).chunks)
    return A.context_per_query(found, "chunk")


def _questions(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("question"))


@query(f"{_CONTEXT} SELECT query_id, context, sources FROM contexts")
def rag_context(spark, sf):
    return ticket_contexts(spark, sf).select("query_id", "context", F.array_join("sources", ", ").alias("sources"))


@query(f"{_PROMPT} SELECT query_id, prompt FROM prompts")
def rag_prompt(spark, sf):
    return A.with_prompt(_questions(spark, sf), ticket_contexts(spark, sf)).select("query_id", "prompt")


_SYSTEM = A.SYSTEM_PROMPT.replace("'", "''").replace("\n", "' || chr(10) || '")


@query(f"""SELECT conv_id, turn, 1 AS place, 'system' AS role, '{_SYSTEM}' AS content FROM conversations WHERE role = 'user'
  UNION ALL SELECT conv_id, turn, 2, 'user', text FROM conversations WHERE role = 'user'""")
def rag_messages(spark, sf):
    asked = table(spark, sf, "conversations").filter("role = 'user'").select("conv_id", "turn", F.posexplode(A.messages("text")).alias("i", "m"))
    return asked.select("conv_id", "turn", (F.col("i") + 1).alias("place"), "m.role", "m.content")


def _count_lines(prompts: pd.Series) -> pd.Series:
    """A stand-in answer provider: any function from prompts to answers will do."""
    return "Lignes: " + (prompts.str.count("\n") + 1).astype(str)


@query(f"""{_PROMPT} SELECT p.query_id, h.rank, h.id AS source, md5(c.chunk) AS document_md5, round(1 - h.s, 6) AS distance,
  'Lignes: ' || (len(p.prompt) - len(replace(p.prompt, chr(10), '')) + 1) AS answer, 'ok' AS status
  FROM prompts p JOIN hits h ON h.query_id = p.query_id JOIN chunks c ON c.id = h.id""")
def ask_record(spark, sf):
    answers = A.ask(_questions(spark, sf), ticket_contexts(spark, sf), A.provider("lines", {"lines": _count_lines}))
    each = answers.select("query_id", "answer", "status", F.posexplode(F.arrays_zip("sources", "documents", "distances")).alias("i", "z"))
    return each.select("query_id", (F.col("i") + 1).alias("rank"), F.col("z.sources").alias("source"), F.md5("z.documents").alias("document_md5"),
                       F.round("z.distances", 6).alias("distance"), "answer", "status")


def _fragile(prompts: pd.Series) -> pd.Series:
    """A provider that refuses a whole batch for one prompt, and loses answers of large batches."""
    if prompts.str.contains("?", regex=False).any() or (prompts.str.len() % 2).any():
        raise RuntimeError("panne")
    return _count_lines(prompts).iloc[:3]


@query(f"""{_PROMPT} SELECT query_id, CASE WHEN contains(prompt, '?') OR len(prompt) % 2 = 1 THEN '{A.ERROR_PREFIX}panne'
    ELSE 'Lignes: ' || (len(prompt) - len(replace(prompt, chr(10), '')) + 1) END AS answer,
  CASE WHEN contains(prompt, '?') OR len(prompt) % 2 = 1 THEN 'error' ELSE 'ok' END AS status FROM prompts""")
def ask_failing(spark, sf):
    """Prompts that fail keep their own rows only; a short answer list is asked for again, never spread over other rows."""
    return A.ask(_questions(spark, sf), ticket_contexts(spark, sf), _fragile).select("query_id", "answer", "status")


@query(f"""{_INDEX}, asked AS (SELECT conv_id, turn, text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM conversations WHERE role = 'user'),
  found AS (SELECT conv_id, turn, bool_or(v.term IS NOT NULL) AS hit FROM (SELECT conv_id, turn,
    unnest(CASE WHEN len(w) = 0 THEN [''] ELSE list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS term FROM asked) a
    LEFT JOIN vocab v ON v.term = a.term GROUP BY 1, 2)
  SELECT conv_id || '/' || turn AS query_id, CASE WHEN NOT hit THEN '{A.NO_HIT}' END AS answer, CASE WHEN hit THEN 'not_generated' ELSE 'no_hit' END AS status FROM found""")
def ask_fallback(spark, sf):
    index = ticket_index(spark, sf)
    asked = table(spark, sf, "conversations").filter("role = 'user'").select(
        F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"), F.col("text").alias("question"))
    hits = R.tfidf_search(asked, index.model, index.inverted, 3, "query_id", "question", fill_zero=False)
    contexts = A.context_per_query(R.attach_documents(hits, index.chunks), "chunk")
    return A.ask(asked, contexts).select("query_id", "answer", "status")


_PAIRS = """WITH a AS (SELECT conv_id, turn, text AS answer FROM conversations WHERE role = 'assistant'),
  q AS (SELECT conv_id, turn + 1 AS turn, regexp_extract(text, '[\\p{L}\\p{N}_]{2,}') AS expected FROM conversations WHERE role = 'user'),
  checked AS (SELECT a.conv_id, a.turn, contains(lower(answer), 'ne trouve pas') OR contains(lower(answer), 'ne sais pas') AS refused,
    coalesce(contains(lower(answer), lower(q.expected)), false) AS grounded, q.expected FROM a LEFT JOIN q ON a.conv_id = q.conv_id AND a.turn = q.turn),
  passing AS (SELECT *, CASE WHEN expected IS NOT NULL THEN grounded ELSE refused END AS passed FROM checked)"""


def _checked_answers(spark, sf):
    """Assistant turns checked for the first word of the user turn they reply to."""
    c = table(spark, sf, "conversations")
    asked = c.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.regexp_extract("text", f"({T.WORD})", 1).alias("expected"))
    replies = c.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    return A.answer_checks(replies.join(asked, ["conv_id", "turn"], "left"), "answer", "expected")


@query(f"{_PAIRS} SELECT conv_id, turn, refused, grounded, passed FROM passing")
def refusal_check(spark, sf):
    return _checked_answers(spark, sf).select("conv_id", "turn", "refused", "grounded", "passed")


@query(f"""{_PAIRS} SELECT count(*) FILTER (WHERE passed) AS n_passed, count(*) AS n_total, CASE WHEN count(*) FILTER (WHERE passed) = count(*) THEN 'pass'
  WHEN count(*) FILTER (WHERE passed) * 2 >= count(*) THEN 'partial' ELSE 'fail' END AS verdict FROM passing""")
def answer_score(spark, sf):
    return E.pass_rate(_checked_answers(spark, sf))


@query(f"""{_CONTEXT} SELECT b.item_id AS query_id, b.text AS question, c.sources, c.percents FROM benchmark b JOIN contexts c ON c.query_id = b.item_id""")
def question_report(spark, sf):
    report = A.question_report(A.ask(_questions(spark, sf), ticket_contexts(spark, sf)))
    return report.select("query_id", "question", "sources", F.array_join(F.transform("percents", lambda p: p.cast("string")), "|").alias("percents"))
