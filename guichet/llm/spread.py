"""Boilerplate lines by the number of sites that hold them: sketches first, exact counts where those are too close to tell."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import WORD, text_key
from .lines import normal_line
from .registry import query, table

#: A line held by more sites than this is boilerplate.
MAX_SITES = 5
#: Sketch size (log2 of its registers), and the band around the limit, in standard errors, that is counted exactly.
LOG_K, BAND = 10, 6.0


def line_table(docs: DataFrame, site_col: str, text_col: str) -> DataFrame:
    """(k1, k2, site, line): the text keys, site hash (null for none) and line hash of every line with a word, stored.

    Texts are normalised once; what follows reads hashes.
    """
    k1, k2 = text_key(F.col(text_col))
    site = F.when(F.col(site_col).isNotNull(), F.xxhash64(F.lit(37), F.col(site_col)))
    lines = docs.select(k1.alias("k1"), k2.alias("k2"), site.alias("site"), F.explode(F.split(text_col, "\n")).alias("_text")).filter(F.col("_text").rlike(WORD))
    return settle(lines.select("k1", "k2", "site", F.xxhash64(normal_line(F.col("_text"))).alias("line")), "lines")


def spread_lines(lines: DataFrame, max_sites: int = MAX_SITES) -> DataFrame:
    """(line, sites_estimate): hashes of the lines of a ``line_table`` that more than ``max_sites`` sites hold.

    Each line's sketch of its sites is merged by aggregation, so a line of a third of all rows is one small state
    per task. An estimate within BAND standard errors of the limit doesn't decide: such lines are counted exactly,
    by distinct (line, site) pairs, and only those. A null site is no site. Lines are compared in lower case with
    single spaces, by 64-bit hash.
    """
    held = lines.filter("site IS NOT NULL").select("site", "line")
    often = held.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") > max_sites).select(F.col("line").alias("_line"))  # rarer lines can't be on so many sites
    sketched = held.join(often, F.col("line") == F.col("_line"), "left_semi").groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"))
    sketched = settle(sketched.select("line", F.hll_sketch_estimate("sketch").alias("estimate")), "sketches")
    slack = BAND * 1.04 / (1 << LOG_K) ** 0.5
    low, high = max_sites * (1 - slack) - 1, max_sites * (1 + slack) + 1
    near = sketched.filter(F.col("estimate").between(low, high)).select(F.col("line").alias("_line"), "estimate")
    pairs = held.join(near, F.col("line") == F.col("_line")).groupBy("line", "site").agg(F.first("estimate").alias("estimate"))
    exact = pairs.groupBy("line").agg(F.count("*").alias("sites"), F.first("estimate").alias("estimate")).filter(F.col("sites") > max_sites)
    return sketched.filter(F.col("estimate") > high).select("line", F.col("estimate").alias("sites_estimate")).union(exact.select("line", F.col("estimate").alias("sites_estimate")))


def without_spread_lines(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text", max_sites: int = MAX_SITES) -> DataFrame:
    """(id, n_lines, n_removed, text) for every row: its text without the lines that more than ``max_sites`` sites hold.

    All copies of such a line go, whatever their site. Lines without a word stay and are not counted. A null text
    stays null; equal texts are cleaned alike, repeated rows each. Only texts with a line to remove are cut again.
    """
    lines = line_table(docs, site_col, text_col)
    gone = spread_lines(lines, max_sites).select(F.col("line").alias("_gone"))
    cuts = lines.join(gone, F.col("line") == F.col("_gone")).groupBy("k1", "k2").agg(F.collect_set("line").alias("_cut")).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_cut")
    k1, k2 = text_key(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), k1.alias("k1"), k2.alias("k2")).join(cuts, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
    step = rows.select("id", "text", "_cut", F.inline(F.array(F.struct(F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines")))))
    cut = lambda line: line.rlike(WORD) & F.array_contains("_cut", F.xxhash64(normal_line(line)))
    n_lines = F.size(F.filter("_lines", lambda line: line.rlike(WORD))).cast("long")
    step = step.select("id", "text", "_cut", n_lines.alias("n_lines"), F.size("_lines").alias("_n"), F.inline(F.array(F.struct(F.when(F.col("_cut").isNotNull(), F.filter("_lines", lambda line: ~cut(line))).alias("_stay")))))
    removed = F.when(F.col("_cut").isNull(), 0).otherwise(F.col("_n") - F.size("_stay")).cast("long")
    return step.select("id", "n_lines", removed.alias("n_removed"), F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join("_stay", "\n")).alias("text"))


OP4_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, * FROM documents),
l AS (SELECT r, source, pos, line, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm
    FROM (SELECT r, source, unnest(range(1, len(s) + 1)) AS pos, unnest(s) AS line FROM (SELECT r, source, string_split(text, chr(10)) AS s FROM d))),
gone AS (SELECT norm FROM l WHERE norm <> '' GROUP BY norm HAVING count(DISTINCT source) > {MAX_SITES}),
m AS (SELECT l.*, gone.norm IS NOT NULL AS cut FROM l LEFT JOIN gone ON l.norm = gone.norm),
t AS (SELECT r, count(*) FILTER (norm <> '') AS n_lines, count(*) FILTER (cut) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT cut), '') AS text FROM m GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, t.text FROM d LEFT JOIN t USING (r)
"""


@query(OP4_SQL)
def op4_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that spread over sites."""
    return without_spread_lines(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
