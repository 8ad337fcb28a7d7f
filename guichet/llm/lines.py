"""Quality rules on whole texts, with boilerplate lines found by their frequency across the documents of a host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .common import SPACE, WORD, ascii_lower, text_key, words_of
from .registry import query, table

#: A line is boilerplate on a host if more distinct texts hold it than both of these allow.
MIN_DOCS, MAX_SHARE = 20, 0.01
#: A line that more distinct texts of a host hold than this is boilerplate whatever their share.
MANY_DOCS = 1_000
#: A text fails the base rules with fewer words than this.
MIN_WORDS = 10
#: A document is depleted if fewer words, or a smaller share of its words, than this stay.
LEFT_WORDS, LEFT_SHARE = 5, 0.3
#: Words in a repetition window, and the percentage of words in repeated windows that fails a text.
WINDOW, MAX_REPEATED = 5, 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normal_line(line: Column) -> Column:
    """A line in lower case with single spaces between its words."""
    return F.trim(F.regexp_replace(ascii_lower(line), SPACE, " "))


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and new columns. A generator stands between, so later expressions read values and don't repeat their making."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _with_next(values: str, f) -> Column:
    """f(element, next element) along an array; after the last comes null."""
    return F.zip_with(F.col(values), F.slice(values, F.lit(2), F.size(values)), f)


def base_metrics(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """``keep``, COUNTS and base_failed for each row; a null or empty text counts nothing and fails.

    Windows are compared as 64-bit hashes. Only a text with equal windows sorts them; the words they cover follow
    from the gaps between their places. All of it stays inside the row, in time n log n.
    """
    text = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = _once(text, keep, _words=words_of(F.col("_text")), _lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)),
                  word_chars=F.length(F.regexp_replace("_text", SPACE, "")).cast("long"),
                  n_symbols=F.length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long"))
    kept = [*keep, "word_chars", "n_symbols"]
    found = _once(found, kept, n_words=F.size("_words").cast("long"), n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                  _words=F.transform("_words", lambda w: F.xxhash64(w)))
    kept += ["n_words", "n_dup_lines"]
    whole = F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))
    columns = F.arrays_zip(*[F.slice("_words", F.lit(k + 1), whole) for k in range(WINDOW)])
    found = _once(found, kept, _windows=F.transform(columns, lambda s: F.xxhash64(s)))
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = _once(found, kept, _sorted=F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    found = _once(found, [*kept, "_sorted"], _same=_with_next("_sorted", lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))))
    before = F.concat(F.array(F.lit(False)), F.col("_same"))
    marked = F.zip_with(F.zip_with("_same", F.slice(before, F.lit(1), F.size("_same")), lambda a, b: a | b), "_sorted", lambda m, s: F.when(m, s["i"]))
    found = _once(found, kept, _places=F.sort_array(F.filter(marked, lambda i: i.isNotNull())))
    gaps = _with_next("_places", lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    found = found.select(*kept, F.coalesce(F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.select(*keep, *COUNTS, failed.alias("base_failed"))


def line_verdicts(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
                  min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, left_words: int = LEFT_WORDS, left_share: float = LEFT_SHARE, many_docs: int | None = MANY_DOCS) -> tuple[DataFrame, DataFrame]:
    """Quality verdicts and the lines to remove.

    The first table has, for each row, id, h (host), k1 and k2 (text), COUNTS, base_failed, words_left and kept.
    The second has the removed lines as (_h, _k1, _k2, line).

    Lines are hashed in lower case with single spaces. Among the texts that pass the base rules, each host's
    distinct texts that hold a line are counted, copies as one. A line that more than ``min_docs`` texts and
    ``max_share`` of the host's texts hold, or more than ``many_docs`` texts unless that is None, is removed, but stays in the text with the host's smallest id among
    them, so that the first of a group of copies is whole. A text is kept if at least ``left_words`` words and
    ``left_share`` of its words stay. Equal texts of a host, repeated rows among them, get one verdict; null hosts
    are one host; null ids sort first.
    """
    keyed = docs.select(F.col(id_col).alias("id"), text_key(F.col(host_col))[0].alias("h"), *[k.alias(n) for k, n in zip(text_key(F.col(text_col)), ("k1", "k2"), strict=True)], F.col(text_col).alias("text"))
    rows = settle(base_metrics(keyed, ["id", "h", "k1", "k2"], "text"), "metrics")
    texts = rows.filter(~F.col("base_failed")).groupBy("h", "k1", "k2").agg(F.count("*").alias("copies"), F.min(F.struct("id")).alias("least"))
    lines = keyed.select("h", "k1", "k2", F.explode(F.split("text", "\n")).alias("line")).select("h", "k1", "k2", normal_line(F.col("line")).alias("line")).filter("line <> ''")
    words = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    held = lines.select("h", "k1", "k2", F.xxhash64("line").alias("line"), words.alias("words")).groupBy("h", "k1", "k2", "line").agg(F.sum("words").alias("words"))
    held = settle(held.join(texts, ["h", "k1", "k2"]).select("h", "k1", "k2", "line", (F.col("words") / F.col("copies")).cast("long").alias("words"), "least"), "lines")
    often = held.groupBy("h", "line").agg(F.count("*").alias("n"), F.min(F.struct("least", "k1", "k2")).alias("first")).filter(F.col("n") > min_docs)
    sizes = texts.groupBy("h").agg(F.count("*").alias("texts")).withColumnRenamed("h", "_h")
    often = often.join(sizes, F.col("h") == F.col("_h")).filter((F.col("n") > max_share * F.col("texts")) | F.coalesce(F.col("n") > F.lit(many_docs), F.lit(False)))
    often = often.select(F.col("h").alias("_h"), F.col("line").alias("_line"), F.col("first.k1").alias("f1"), F.col("first.k2").alias("f2"))
    gone = held.join(often, (F.col("h") == F.col("_h")) & (F.col("line") == F.col("_line")) & ~((F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2"))))
    gone = gone.select("_h", F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "line", "words")
    lost = gone.groupBy("_h", "_k1", "_k2").agg(F.sum("words").alias("lost"))
    out = rows.join(lost, (F.col("h") == F.col("_h")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left").drop("_h", "_k1", "_k2")
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    out = out.withColumn("words_left", left).drop("lost")
    kept = ~F.col("base_failed") & (F.col("words_left") >= left_words) & (F.col("words_left") >= left_share * F.col("n_words"))
    return out.withColumn("kept", kept), gone.select("_h", "_k1", "_k2", "line")


def clean_documents(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", **limits) -> DataFrame:
    """The kept rows of ``docs``, all columns, with boilerplate lines cut from ``text_col``. Arguments as for line_verdicts."""
    verdicts, gone = line_verdicts(docs, id_col, host_col, text_col, **limits)
    texts = verdicts.filter("kept").select(F.col("h").alias("_vh"), F.col("k1").alias("_v1"), F.col("k2").alias("_v2")).distinct()
    cuts = gone.groupBy("_h", "_k1", "_k2").agg(F.collect_set("line").alias("_cut"))
    texts = texts.join(cuts, (F.col("_vh") == F.col("_h")) & (F.col("_v1") == F.col("_k1")) & (F.col("_v2") == F.col("_k2")), "left").select("_vh", "_v1", "_v2", "_cut")
    k1, k2 = text_key(docs[text_col])
    joined = docs.join(texts, (text_key(docs[host_col])[0] == F.col("_vh")) & (k1 == F.col("_v1")) & (k2 == F.col("_v2")))
    stay = F.array_join(F.filter(F.split(docs[text_col], "\n"), lambda line: ~F.array_contains("_cut", F.xxhash64(normal_line(line)))), "\n")
    cleaned = F.when(F.col("_cut").isNull(), docs[text_col]).otherwise(stay)
    return joined.select(*[cleaned.alias(c) if c == text_col else docs[c] for c in docs.columns])


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
pos AS (SELECT r, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}),
gram AS (SELECT pos.r, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g FROM pos JOIN d USING (r)),
twice AS (SELECT r, i FROM gram QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range({WINDOW}) t(k) GROUP BY r),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.r, doc_id, source, text, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN covered ON covered.r = d.r LEFT JOIN dup ON dup.r = d.r),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m),
t AS (SELECT source, text, min(doc_id) AS least FROM f WHERE NOT base_failed GROUP BY ALL),
tl AS (SELECT source, text, least, trim(regexp_replace(translate(unnest(string_split(text, chr(10))), '{"ABCDEFGHIJKLMNOPQRSTUVWXYZ"}', '{"abcdefghijklmnopqrstuvwxyz"}'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS l FROM t),
h AS (SELECT source, text, least, l, sum(length(l) - length(replace(l, ' ', '')) + 1) AS words FROM tl WHERE l <> '' GROUP BY ALL),
host AS (SELECT source, count(*) AS texts FROM t GROUP BY ALL),
o AS (SELECT h.source, l, min(least) AS least FROM h JOIN host ON h.source IS NOT DISTINCT FROM host.source GROUP BY h.source, l, texts HAVING count(*) > {MIN_DOCS} AND (count(*) > {MAX_SHARE} * texts OR count(*) > {MANY_DOCS})),
lost AS (SELECT h.source, text, sum(words) AS lost FROM h JOIN o ON h.source IS NOT DISTINCT FROM o.source AND h.l = o.l AND h.least <> o.least GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND n_words - coalesce(lost, 0) >= {LEFT_WORDS} AND n_words - coalesce(lost, 0) >= {LEFT_SHARE} * n_words AS kept, (n_words - coalesce(lost, 0))::BIGINT AS words_left
FROM f LEFT JOIN lost ON f.source IS NOT DISTINCT FROM lost.source AND f.text = lost.text
"""


@query(OP3_SQL)
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts and the verdict of the base rules and of the lines it keeps."""
    verdicts, _ = line_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(F.col("id").alias("doc_id"), *COUNTS, "base_failed", "kept", "words_left")
