"""Cleaning, checks, distributions, sampling and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import evaluation as E, prepare as P, profile as D, quality as Q, sampling as S
from ..schema import URGENCY_LABELS
from ..session import settle
from .registry import built_once, query
from .standin import (SQL_BALANCED, SQL_PREDICTIONS, SQL_RAW, SQL_TARGETS, SQL_TICKETS, predictions, raw_tickets, sql_split,
                      sql_strip, sql_word_count, table, tickets)


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oversampled tickets, written once; later steps read the files."""
    t = tickets(spark, sf_dir)
    return built_once(spark, sf_dir, "balanced", lambda: settle(
        S.oversample(t, "urgence", S.oversample_targets(t), origin_col="origin")))


# --- cleaning ------------------------------------------------------------------------------------

@query(f"""WITH {SQL_TICKETS} SELECT "ID", md5(texte) AS texte_md5, titre, categorie, urgence, round(temps_resolution, 6) AS temps_resolution,
  type_ticket, nb_mots, md5(text_full) AS text_md5 FROM tickets""")
def ticket_clean(spark, sf):
    return tickets(spark, sf).select("ID", F.md5("texte").alias("texte_md5"), "titre", "categorie", "urgence", *r6("temps_resolution"),
                                     "type_ticket", "nb_mots", F.md5("text_full").alias("text_md5"))


@query(f"""WITH {SQL_TICKETS} SELECT "ID", text_full, nb_mots FROM tickets""")
def ticket_features(spark, sf):
    return tickets(spark, sf, typed=False).select("ID", "text_full", "nb_mots")


@query(f"""WITH {SQL_RAW} SELECT count(*) FILTER (WHERE urgence = 'Très haute') AS n_replaced, count(*) AS n_rows FROM raw_tickets""")
def urgency_normalization(spark, sf):
    return P.normalization_count(raw_tickets(spark, sf, typed=False))


_SHORT = f"""SELECT conv_id, turn, {sql_strip("' ' || coalesce(text, '')")} AS text_full FROM conversations"""


@query(f"""WITH s AS ({_SHORT}), c AS (SELECT *, {sql_word_count('text_full')} AS nb_mots FROM s)
  SELECT conv_id, turn, nb_mots, CASE WHEN text_full = '' THEN 'empty' WHEN nb_mots < 2 THEN 'too_short' ELSE 'ok' END AS status FROM c""")
def input_validation(spark, sf):
    turns = table(spark, sf, "conversations").select("conv_id", "turn", F.lit("").alias("titre"), F.col("text").alias("texte"))
    return Q.input_status(turns).select("conv_id", "turn", "nb_mots", "status")


# --- checks --------------------------------------------------------------------------------------

@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return Q.duplicate_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query(f"WITH {SQL_RAW} SELECT urgence, count(*) AS n FROM raw_tickets WHERE urgence IS NULL OR urgence NOT IN ('Basse', 'Moyenne', 'Haute') GROUP BY 1")
def domain_violations(spark, sf):
    return Q.domain_violations(raw_tickets(spark, sf, typed=False))


@query("""SELECT doc_id, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1""")
def unlabelled_documents(spark, sf):
    return Q.domain_violations_by_table(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


def split_tickets(spark, sf) -> DataFrame:
    return S.stratified_split(balanced(spark, sf))


_SPLIT = f"WITH {SQL_BALANCED}, {sql_split('balanced')}"


@query(f"""{_SPLIT} SELECT split, count(*) AS n, (SELECT count(*) FROM balanced) AS total,
  round(count(*) * 100.0::double / (SELECT count(*) FROM balanced), 6) AS pct,
  (SELECT count(*) FROM balanced) - (SELECT count(*) FROM split_rows) AS lost FROM split_rows GROUP BY 1""")
def split_reconcile(spark, sf):
    return Q.reconcile_split(balanced(spark, sf), split_tickets(spark, sf)).select("split", "n", "total", *r6("pct"), "lost")


@query(f"""{_SPLIT}, both_sets AS (SELECT split AS dataset, urgence FROM split_rows UNION ALL SELECT 'original', urgence FROM split_rows)
  SELECT dataset, count(*) AS n_rows, {", ".join(f"round(count(*) FILTER (WHERE urgence = '{v}') * 100.0::double / count(*), 6) AS \"{v}\"" for v in URGENCY_LABELS)}
  FROM both_sets GROUP BY 1""")
def stratification_check(spark, sf):
    return Q.stratification_check(split_tickets(spark, sf)).select("dataset", "n_rows", *r6(*URGENCY_LABELS))


# --- distributions -------------------------------------------------------------------------------

def _sql_counts(source: str, column: str) -> str:
    return (f"SELECT {column}, count(*) AS n, round(count(*) * 100.0::double / (SELECT count({column}) FROM {source}), 6) AS pct "
            f"FROM {source} WHERE {column} IS NOT NULL GROUP BY 1")


@query(_sql_counts("orders", "o_orderpriority"))
def class_distribution(spark, sf):
    return D.value_counts(table(spark, sf, "orders"), "o_orderpriority").select("o_orderpriority", "n", *r6("pct"))


@query(f"""WITH {SQL_TICKETS}, c AS ({_sql_counts('tickets', 'urgence')})
  SELECT urgence, n, pct, CASE urgence WHEN 'Basse' THEN 1 WHEN 'Moyenne' THEN 2 ELSE 3 END AS rank, repeat('█', floor(pct / 2)::bigint) AS bar FROM c""")
def class_distribution_norm(spark, sf):
    return D.value_counts_in_order(tickets(spark, sf, typed=False)).select("urgence", "n", *r6("pct"), "rank", "bar")


@query(f"""WITH {SQL_BALANCED} SELECT 'before' AS phase, * FROM ({_sql_counts('tickets', 'urgence')})
  UNION ALL SELECT 'after', * FROM ({_sql_counts('balanced', 'urgence')})""")
def distribution_before_after(spark, sf):
    return D.distribution_report(tickets(spark, sf), balanced(spark, sf)).select("phase", "urgence", "n", *r6("pct"))


_PROFILE = """SELECT '{t}' AS measure, count({c}) AS n, round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(avg({c}), 4) AS mean,
  round(median({c}), 6) AS median, round(stddev_samp({c}), 4) AS std FROM {s}"""


@query(f"WITH {SQL_TICKETS} " + _PROFILE.format(t="ticket_hours", c="temps_resolution", s="tickets") + " UNION ALL "
       + _PROFILE.format(t="line_price", c="l_extendedprice", s="lineitem") + " UNION ALL " + _PROFILE.format(t="balance", c="c_acctbal", s="customer"))
def numeric_profile(spark, sf):
    def one(name, df, c):
        p = D.numeric_profile(df, c)
        return p.select(F.lit(name).alias("measure"), "n", *r6("min", "max"), F.round("mean", 4).alias("mean"), *r6("median"), F.round("std", 4).alias("std"))

    return (one("ticket_hours", tickets(spark, sf), "temps_resolution")
            .unionByName(one("line_price", table(spark, sf, "lineitem"), "l_extendedprice"))
            .unionByName(one("balance", table(spark, sf, "customer"), "c_acctbal")))


@query(f"""WITH {SQL_PREDICTIONS} SELECT round(min(temps_resolution_pred), 6) AS min, round(max(temps_resolution_pred), 6) AS max,
  round(avg(temps_resolution_pred), 6) AS mean, round(stddev_pop(temps_resolution_pred), 6) AS std FROM predictions""")
def prediction_profile(spark, sf):
    return D.prediction_profile(predictions(spark, sf), "temps_resolution_pred").select(*r6("min", "max", "mean", "std"))


@query(f"""WITH {SQL_TICKETS} SELECT 'ID' AS "column", count(DISTINCT "ID") AS n_distinct FROM tickets UNION ALL
  SELECT 'categorie', count(DISTINCT categorie) FROM tickets UNION ALL SELECT 'urgence', count(DISTINCT urgence) FROM tickets UNION ALL
  SELECT 'type_ticket', count(DISTINCT type_ticket) FROM tickets""")
def distinct_counts(spark, sf):
    return D.distinct_counts(tickets(spark, sf), ["ID", "categorie", "urgence", "type_ticket"])


@query(f"WITH {SQL_TICKETS} SELECT DISTINCT categorie FROM tickets WHERE categorie IS NOT NULL")
def distinct_values(spark, sf):
    return D.distinct_values(tickets(spark, sf), "categorie")


@query(f"WITH {SQL_TICKETS} {_sql_counts('tickets', 'categorie')} ORDER BY n DESC, categorie LIMIT 5")
def top_categories(spark, sf):
    return D.top_values(tickets(spark, sf), "categorie").select("categorie", "n", *r6("pct"))


# --- sampling ------------------------------------------------------------------------------------

@query(f"WITH {SQL_TARGETS} SELECT urgence, n, target FROM targets")
def oversample_targets(spark, sf):
    return S.oversample_targets(tickets(spark, sf))


@query(f"""WITH {SQL_BALANCED} SELECT "ID", origin, categorie, urgence, round(temps_resolution, 6) AS temps_resolution, type_ticket, nb_mots, titre,
  md5(text_full) AS text_md5 FROM balanced""")
def oversample(spark, sf):
    return balanced(spark, sf).select("ID", "origin", "categorie", "urgence", *r6("temps_resolution"), "type_ticket", "nb_mots", "titre",
                                      F.md5("text_full").alias("text_md5"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS k FROM lineitem)
  SELECT l_orderkey, l_linenumber, CASE WHEN k = 1 THEN l_orderkey::varchar ELSE l_orderkey || '_dup_' || (k - 1) END AS line_id FROM r""")
def dedup_ids(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return S.unique_ids(lines, "l_orderkey", ["l_linenumber"], out="line_id")


@query(f'{_SPLIT} SELECT "ID", urgence, split FROM split_rows')
def stratified_split(spark, sf):
    return split_tickets(spark, sf).select("ID", "urgence", "split")


@query(f"""WITH {SQL_BALANCED}, origins AS (SELECT DISTINCT origin, urgence FROM balanced), {sql_split('origins', key='origin')}
  SELECT b."ID", b.urgence, s.split FROM balanced b JOIN split_rows s ON b.origin = s.origin""")
def stratified_split_grouped(spark, sf):
    return S.stratified_split(balanced(spark, sf), group_col="origin").select("ID", "urgence", "split")


@query("""WITH sizes AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1), whole AS (SELECT floor(n / 0.5::double) AS total FROM sizes WHERE l_returnflag = 'N')
  SELECT l_returnflag, greatest(n, CASE l_returnflag WHEN 'A' THEN floor(total * 0.4::double)::bigint WHEN 'R' THEN floor(total * 0.3::double)::bigint ELSE n END) AS n,
    greatest(n, CASE l_returnflag WHEN 'A' THEN floor(total * 0.4::double)::bigint WHEN 'R' THEN floor(total * 0.3::double)::bigint ELSE n END) AS n_ids,
    n AS n_before FROM sizes, whole""")
def oversample_repeated_keys(spark, sf):
    """Order lines by order key: most keys repeat, yet every row of the result has a name of its own."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    targets = S.oversample_targets(lines, "l_returnflag", "N", shares={"A": 0.4, "R": 0.3})
    out = S.oversample(lines, "l_returnflag", targets, id_col="l_orderkey")
    counts = out.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("n_ids"))
    return counts.join(targets.select("l_returnflag", F.col("n").alias("n_before")), "l_returnflag")


@query(f"""WITH {SQL_TICKETS}, labelled AS (SELECT *, coalesce('v' || type_ticket, 'n') AS c FROM tickets),
  z AS (SELECT c, count(*) AS n FROM labelled GROUP BY 1),
  z2 AS (SELECT c, n, (sum(n) OVER (ORDER BY c) - n)::bigint AS start FROM z),
  q AS (SELECT c, i, floor((start + n - 1 - i)::double / 5)::bigint - floor((start - 1 - i)::double / 5)::bigint AS take FROM z2, (SELECT unnest(range(0, 5)) AS i)),
  q2 AS (SELECT c, i, sum(take) OVER (PARTITION BY c ORDER BY i) AS hi, sum(take) OVER (PARTITION BY c ORDER BY i) - take AS lo FROM q),
  p AS (SELECT "ID", type_ticket, c, row_number() OVER (PARTITION BY c ORDER BY md5('42|fold|' || "ID")) AS place FROM labelled)
  SELECT "ID", type_ticket, i::int AS fold FROM p JOIN q2 ON p.c = q2.c AND place > lo AND place <= hi""")
def stratified_folds(spark, sf):
    return S.stratified_folds(tickets(spark, sf), "type_ticket").select("ID", "type_ticket", "fold")


# --- evaluation ----------------------------------------------------------------------------------

def _sql_class_scores(by: str = "") -> str:
    key, on = (f"{by}, ", f"AND a.{by} = b.{by}") if by else ("", "")
    return f"""lab AS (SELECT {key}urgence AS label FROM predictions UNION SELECT {key}urgence_pred FROM predictions),
  scores AS (SELECT {('b.' + by + ', ') if by else ''}b.label, count(*) FILTER (WHERE a.urgence = b.label AND a.urgence_pred = b.label) AS tp,
    count(*) FILTER (WHERE a.urgence = b.label) AS support, count(*) FILTER (WHERE a.urgence_pred = b.label) AS predicted
    FROM lab b JOIN predictions a ON (a.urgence = b.label OR a.urgence_pred = b.label) {on} GROUP BY ALL),
  sc AS (SELECT *, CASE WHEN predicted > 0 THEN tp::double / predicted ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp::double / support ELSE 0 END AS recall, 2.0::double * tp / (support + predicted) AS f1 FROM scores)"""


@query(f"WITH {SQL_PREDICTIONS}, {_sql_class_scores()} SELECT round(sum(tp)::double / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, sum(support)::bigint AS n FROM sc")
def accuracy_f1(spark, sf):
    return E.accuracy_f1(predictions(spark, sf), "urgence", "urgence_pred").select(*r6("accuracy", "f1_macro"), "n")


@query(f"WITH {SQL_PREDICTIONS}, {_sql_class_scores('split')} SELECT split, round(sum(tp)::double / sum(support), 6) AS accuracy, round(avg(f1), 6) AS f1_macro, sum(support)::bigint AS n FROM sc GROUP BY 1")
def metrics_by_split(spark, sf):
    return E.accuracy_f1(predictions(spark, sf), "urgence", "urgence_pred", ["split"]).select("split", *r6("accuracy", "f1_macro"), "n")


@query(f"""WITH {SQL_PREDICTIONS}, {_sql_class_scores()}
  SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM sc UNION ALL
  SELECT 'accuracy', round(sum(tp)::double / sum(support), 6), round(sum(tp)::double / sum(support), 6), round(sum(tp)::double / sum(support), 6), sum(support)::bigint FROM sc UNION ALL
  SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint FROM sc UNION ALL
  SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
    round(sum(f1 * support) / sum(support), 6), sum(support)::bigint FROM sc""")
def class_report(spark, sf):
    return E.class_report(predictions(spark, sf), "urgence", "urgence_pred").select("label", *r6("precision", "recall", "f1"), "support")


@query(f"""WITH {SQL_PREDICTIONS} SELECT l.pos, l.label, {", ".join(f"count(*) FILTER (WHERE p.urgence_pred = '{v}') AS \"{v}\"" for v in URGENCY_LABELS)}
  FROM (VALUES (0, 'Basse'), (1, 'Moyenne'), (2, 'Haute')) l(pos, label) LEFT JOIN predictions p ON p.urgence = l.label GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    return E.confusion_matrix(predictions(spark, sf), "urgence", "urgence_pred", URGENCY_LABELS)


@query(f"WITH {SQL_PREDICTIONS} SELECT urgence AS label, urgence_pred AS predicted, count(*) AS n FROM predictions GROUP BY 1, 2")
def confusion_cells(spark, sf):
    return E.confusion_cells(predictions(spark, sf), "urgence", "urgence_pred")


def _sql_regression(source: str, y: str, p: str, by: str = "") -> str:
    return f"""SELECT {by + ', ' if by else ''}count(*) AS n, round(avg(abs({p} - {y})), 6) AS mae, round(sqrt(avg(({p} - {y}) * ({p} - {y}))), 6) AS rmse,
  round(1 - avg(({p} - {y}) * ({p} - {y})) / var_pop({y}), 6) AS r2, round(min({p}), 6) AS pred_min, round(max({p}), 6) AS pred_max,
  round(avg({p}), 6) AS pred_mean, round(stddev_pop({p}), 6) AS pred_std FROM {source} {'GROUP BY ' + by if by else ''}"""


_REG = ("mae", "rmse", "r2", "pred_min", "pred_max", "pred_mean", "pred_std")


@query("WITH guess AS (SELECT l_returnflag, l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem) " + _sql_regression("guess", "y", "p", "l_returnflag"))
def regression_metrics(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    return E.regression_metrics(lines, "y", "p", ["l_returnflag"]).select("l_returnflag", "n", *r6(*_REG))


@query(f"WITH {SQL_PREDICTIONS} " + _sql_regression("predictions", "temps_resolution", "temps_resolution_pred", "split"))
def regression_by_split(spark, sf):
    return E.regression_metrics(predictions(spark, sf), "temps_resolution", "temps_resolution_pred", ["split"]).select("split", "n", *r6(*_REG))


def _errors(spark, sf):
    return P.with_errors(predictions(spark, sf), "temps_resolution", "temps_resolution_pred")


_ERR = f"WITH {SQL_PREDICTIONS}, e AS (SELECT *, abs(temps_resolution_pred - temps_resolution) AS abs_error FROM predictions)"


@query(f"""{_ERR}, b AS (SELECT 0 AS pos, '<5h' AS bucket, count(*) FILTER (WHERE abs_error < 5) AS n FROM e UNION ALL
  SELECT 1, '<10h', count(*) FILTER (WHERE abs_error < 10) FROM e UNION ALL SELECT 2, '<20h', count(*) FILTER (WHERE abs_error < 20) FROM e UNION ALL
  SELECT 3, '>=20h', count(*) FILTER (WHERE abs_error >= 20) FROM e) SELECT pos, bucket, n, round(n * 100.0::double / (SELECT count(*) FROM e), 6) AS pct FROM b""")
def error_buckets(spark, sf):
    return E.error_buckets(_errors(spark, sf)).select("pos", "bucket", "n", *r6("pct"))


@query(f"{_ERR} SELECT urgence_pred, round(avg(abs_error), 6) AS mae, count(*) AS n FROM e GROUP BY 1")
def mae_by_group(spark, sf):
    return E.mae_by_group(_errors(spark, sf)).select("urgence_pred", *r6("mae"), "n")


def _comparison(spark, sf):
    t = predictions(spark, sf)
    runs = [E.regression_metrics(t, "temps_resolution", c, ["split"]).withColumnRenamed("split", "dataset")
            for c in ("temps_resolution_old", "temps_resolution_pred")]
    return E.compare_runs(*runs)


def _sql_run(p: str) -> str:
    return (f"SELECT split AS dataset, avg(abs({p} - temps_resolution)) AS mae, 1 - avg(({p} - temps_resolution) * ({p} - temps_resolution)) / "
            "var_pop(temps_resolution) AS r2 FROM predictions GROUP BY 1")


_RUNS = f"WITH {SQL_PREDICTIONS}, o AS ({_sql_run('temps_resolution_old')}), n AS ({_sql_run('temps_resolution_pred')})"


@query(f"""{_RUNS} SELECT o.dataset, round(o.mae, 6) AS mae_old, round(o.r2, 6) AS r2_old, round(n.mae, 6) AS mae_new, round(n.r2, 6) AS r2_new,
  round(n.mae - o.mae, 6) AS mae_diff, round(n.r2 - o.r2, 6) AS r2_diff FROM o JOIN n ON o.dataset = n.dataset""")
def compare_runs(spark, sf):
    return _comparison(spark, sf).select("dataset", *r6("mae_old", "r2_old", "mae_new", "r2_new", "mae_diff", "r2_diff"))


@query(f"""{_RUNS}, g AS (SELECT max(o.r2) FILTER (WHERE o.dataset = 'train') - max(o.r2) FILTER (WHERE o.dataset = 'test') AS a,
    max(n.r2) FILTER (WHERE o.dataset = 'train') - max(n.r2) FILTER (WHERE o.dataset = 'test') AS b,
    max(o.mae) FILTER (WHERE o.dataset = 'test') - max(o.mae) FILTER (WHERE o.dataset = 'train') AS c,
    max(n.mae) FILTER (WHERE o.dataset = 'test') - max(n.mae) FILTER (WHERE o.dataset = 'train') AS d FROM o JOIN n ON o.dataset = n.dataset)
  SELECT round(a, 6) AS r2_gap_old, round(b, 6) AS r2_gap_new, round(c, 6) AS mae_gap_old, round(d, 6) AS mae_gap_new, round(a - b, 6) AS r2_gap_reduction,
    round((a - b) / a * 100, 4) AS r2_gap_reduction_pct, round(c - d, 6) AS mae_gap_reduction, b < a AS reduced FROM g""")
def overfit_gap(spark, sf):
    return E.overfit_gap(_comparison(spark, sf)).select(*r6("r2_gap_old", "r2_gap_new", "mae_gap_old", "mae_gap_new", "r2_gap_reduction"),
                                                        F.round("r2_gap_reduction_pct", 4).alias("r2_gap_reduction_pct"), *r6("mae_gap_reduction"), "reduced")


@query(f"WITH {SQL_PREDICTIONS} SELECT urgence AS label FROM predictions UNION SELECT urgence_pred FROM predictions")
def label_union(spark, sf):
    return E.class_scores(predictions(spark, sf), "urgence", "urgence_pred").select("label")


@query(f"""{_ERR} SELECT "ID", round(temps_resolution_pred - temps_resolution, 6) AS error, round(abs_error, 6) AS abs_error,
  round(greatest(temps_resolution_pred - 20, 0), 2) AS clamped FROM e WHERE urgence_pred = 'Haute'""")
def prediction_errors(spark, sf):
    e = P.keep_value(_errors(spark, sf), "urgence_pred", "Haute")
    return e.select("ID", *r6("error", "abs_error"), F.round(P.clamp_non_negative(F.col("temps_resolution_pred") - 20), 2).alias("clamped"))


