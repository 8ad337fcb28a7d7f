"""The ticket table derived from the given documents and labels, in Spark and in SQL.

Both sides use the same expressions, so a query can be checked by running its SQL.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.draws import draw_key, draw_long
from ..functions.text import WHITESPACE_SET
from ..operators import prepare as P


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ticket_columns(documents: DataFrame) -> DataFrame:
    """The columns that need no labels; works on a stream too."""
    chars = F.col("n_chars")
    band = F.when(chars < 800, "short").when(chars < 2500, "medium").otherwise("long")
    lang = F.col("lang")
    return documents.select(
        "doc_id", F.col("doc_id").cast("string").alias("ID"), F.col("text").alias("texte"), F.substring("text", 1, 60).alias("titre"),
        F.concat(lang, F.lit("/"), band).alias("categorie"),
        F.when(lang == "en", "Basse").when(lang == "fr", "Moyenne").when(lang == "de", "Haute").when(lang == "es", "Très haute").alias("urgence"),
        (chars.cast("double") / 100).alias("temps_resolution"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str, typed: bool = True) -> DataFrame:
    """Tickets from documents; ``typed`` joins the labels on for ``type_ticket``, which is null otherwise."""
    rows = ticket_columns(table(spark, sf_dir, "documents"))
    if not typed:
        return rows.drop("doc_id").withColumn("type_ticket", F.lit(None).cast("string"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "Demande").when(F.col("quality") == 0, "Incident").alias("type_ticket"))
    return rows.join(labels, "doc_id", "left").drop("doc_id")


def tickets(spark: SparkSession, sf_dir: str, typed: bool = True) -> DataFrame:
    """Cleaned tickets: the nine balanced-table columns."""
    return P.select_columns(P.add_word_count(P.clean_tickets(raw_tickets(spark, sf_dir, typed))))


def percent_draw(salt: str, key: str = "ID"):
    """A whole number 0..99 per key."""
    return draw_long(draw_key(salt, F.col(key))) % 100


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets with repeatable imperfect predictions and a split, for the evaluation operators."""
    u, s = percent_draw("pred"), percent_draw("part")
    return tickets(spark, sf_dir, typed=False).select(
        "ID", "urgence", "categorie", "temps_resolution",
        F.when(u < 10, "Basse").when(u < 15, "Haute").otherwise(F.col("urgence")).alias("urgence_pred"),
        (F.col("temps_resolution") * (F.lit(0.8) + u.cast("double") / 250)).alias("temps_resolution_pred"),
        (F.col("temps_resolution") * (F.lit(0.5) + u.cast("double") / 120)).alias("temps_resolution_old"),
        F.when(s < 70, "train").when(s < 85, "validation").otherwise("test").alias("split"),
    )


# --- the same in SQL ---------------------------------------------------------------------------

def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WHITESPACE_SET}]+|[{WHITESPACE_SET}]+$', '', 'g')"


def sql_word_count(x: str) -> str:
    s = sql_strip(f"coalesce({x}, '')")
    return f"(CASE WHEN {s} = '' THEN 0 ELSE len(regexp_split_to_array({s}, '[{WHITESPACE_SET}]+')) END)"


def sql_draw(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


SQL_RAW = """raw_tickets AS (
  SELECT cast(d.doc_id AS varchar) AS "ID", d.text AS texte, substr(d.text, 1, 60) AS titre,
    d.lang || '/' || CASE WHEN n_chars < 800 THEN 'short' WHEN n_chars < 2500 THEN 'medium' ELSE 'long' END AS categorie,
    CASE d.lang WHEN 'en' THEN 'Basse' WHEN 'fr' THEN 'Moyenne' WHEN 'de' THEN 'Haute' WHEN 'es' THEN 'Très haute' END AS urgence,
    cast(n_chars AS double) / 100 AS temps_resolution,
    CASE l.quality WHEN 1 THEN 'Demande' WHEN 0 THEN 'Incident' END AS type_ticket
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

SQL_TICKETS = SQL_RAW + f""", joined_text AS (
  SELECT "ID", coalesce(texte, '') AS texte, coalesce(titre, '') AS titre, categorie,
    CASE urgence WHEN 'Très haute' THEN 'Haute' ELSE urgence END AS urgence, temps_resolution, type_ticket,
    {sql_strip("coalesce(titre, '') || ' ' || coalesce(texte, '')")} AS text_full
  FROM raw_tickets), tickets AS (SELECT *, {sql_word_count("text_full")} AS nb_mots FROM joined_text)"""

_U = sql_draw("'pred|' || \"ID\"") + " % 100"
_S = sql_draw("'part|' || \"ID\"") + " % 100"
SQL_PREDICTIONS = SQL_TICKETS + f""", drawn AS (SELECT *, {_U} AS u, {_S} AS s FROM tickets), predictions AS (
  SELECT "ID", urgence, categorie, temps_resolution,
    CASE WHEN u < 10 THEN 'Basse' WHEN u < 15 THEN 'Haute' ELSE urgence END AS urgence_pred,
    temps_resolution * (0.8::double + u::double / 250::double) AS temps_resolution_pred,
    temps_resolution * (0.5::double + u::double / 120::double) AS temps_resolution_old,
    CASE WHEN s < 70 THEN 'train' WHEN s < 85 THEN 'validation' ELSE 'test' END AS split
  FROM drawn)"""

SQL_TARGETS = SQL_TICKETS + """, sizes AS (SELECT urgence, count(*) AS n FROM tickets GROUP BY urgence),
  whole AS (SELECT floor(n / 0.5::double) AS total FROM sizes WHERE urgence = 'Basse'),
  targets AS (SELECT urgence, n, CASE urgence
      WHEN 'Moyenne' THEN greatest(floor(total * 0.28::double)::bigint, n)
      WHEN 'Haute' THEN greatest(floor(total * 0.22::double)::bigint, n) ELSE n END AS target FROM sizes, whole)"""

SQL_BALANCED = SQL_TARGETS + f""", ranked AS (
    SELECT *, row_number() OVER (PARTITION BY urgence ORDER BY md5('42|rank|' || "ID")) AS rk FROM tickets),
  draws AS (SELECT urgence, n, unnest(range(1, target - n + 1)) AS j FROM targets),
  picks AS (SELECT urgence, {sql_draw("'42|draw|' || urgence || '|' || j")} % n + 1 AS rk, j FROM draws),
  copies AS (SELECT r.*, row_number() OVER (PARTITION BY r."ID" ORDER BY p.j) AS copy_no
    FROM ranked r JOIN picks p ON r.urgence = p.urgence AND r.rk = p.rk),
  balanced AS (
    SELECT "ID", "ID" AS origin, texte, titre, categorie, urgence, temps_resolution, type_ticket, nb_mots, text_full FROM tickets
    UNION ALL
    SELECT "ID" || '_dup_' || copy_no, "ID", texte, titre, categorie, urgence, temps_resolution, type_ticket, nb_mots, text_full FROM copies)"""


def sql_split(source: str, class_col: str = "urgence", key: str = '"ID"') -> str:
    """CTEs ending in ``split_rows``: ``source`` with its 70/15/15 label."""
    return f"""class_n AS (SELECT {class_col} AS c, count(*) AS n FROM {source} GROUP BY 1),
  held AS (SELECT sum(n)::bigint AS total, ceil(round(sum(n) * 0.30::double, 9))::bigint AS held FROM class_n),
  q1 AS (SELECT c, n, held, total - held AS tr, (total - held) * n // total AS base, ((total - held) * n) % total AS rem FROM class_n, held),
  q2 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, c) <= tr - sum(base) OVER () THEN 1 ELSE 0 END AS n_train FROM q1),
  h1 AS (SELECT c, n_train, n - n_train AS hn, held, held - ceil(round(held * 0.5::double, 9))::bigint AS nv FROM q2),
  h2 AS (SELECT *, nv * hn // held AS base, (nv * hn) % held AS rem FROM h1),
  h3 AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, c) <= nv - sum(base) OVER () THEN 1 ELSE 0 END AS n_val FROM h2),
  placed AS (SELECT *, row_number() OVER (PARTITION BY {class_col} ORDER BY md5('42|split|' || {key})) AS place FROM {source}),
  split_rows AS (SELECT placed.*, CASE WHEN place <= n_train THEN 'train' WHEN place <= n_train + n_val THEN 'validation' ELSE 'test' END AS split
    FROM placed JOIN h3 ON placed.{class_col} = h3.c)"""


def sql_terms(source: str, id_col: str, text: str, fold: bool, prefix: str = "") -> str:
    """CTEs ending in ``<prefix>tf``: (id, term, tf) of 1-2-grams."""
    folded = f"strip_accents(lower(coalesce({text}, '')))" if fold else f"lower(coalesce({text}, ''))"
    return f"""{prefix}words AS (SELECT {id_col} AS id, regexp_extract_all({folded}, '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM {source}),
  {prefix}grams AS (SELECT id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM {prefix}words),
  {prefix}tf AS (SELECT id, term, count(*) AS tf FROM {prefix}grams GROUP BY 1, 2)"""


def sql_vocab(source: str, min_df: int, max_features: int) -> str:
    return f"""stats AS (SELECT term, count(*) AS df, sum(tf)::bigint AS cf FROM tf GROUP BY 1),
  vocab AS (SELECT term, df, cf, ln((1 + (SELECT count(*) FROM {source}))::double / (1 + df)::double) + 1 AS idf
    FROM stats WHERE df >= {min_df} ORDER BY cf DESC, term LIMIT {max_features})"""


def sql_weights(tf: str, out: str, sublinear: bool) -> str:
    count = "(1 + ln(tf))" if sublinear else "tf::double"
    return f"""{out}_raw AS (SELECT id, t.term, {count} * idf AS w FROM {tf} t JOIN vocab v ON t.term = v.term),
  {out} AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {out}_raw)"""
