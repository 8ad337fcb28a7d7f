"""Resampling towards a target distribution by the importance of hashed word n-grams; equal lines are counted once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranks import sorted_rank
from ..session import settle
from .common import slices, text_key
from .registry import query, table

#: Longest n-gram, buckets of n-grams, per cent of the documents drawn, least words of those, and the seed of the draw.
GRAMS, BUCKETS, PER_CENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024
#: A line that holds more than one in so many of all line occurrences is sent to every task: fewer lines than this can be.
HOT = 1_000
#: Words whose bucket a task remembers.
KNOWN = 1 << 18
BATCH_BYTES = 8_000_000

#: Bytes that belong to a word stay, A-Z in lower case; all other bytes become blanks.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def gram_words(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and digits and of characters beyond ASCII."""
    return text.translate(_WORDS).split()


class Buckets:
    """The bucket of a feature: the crc32 of its bytes modulo their number, remembered for a bounded number of them."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def __call__(self, feature: bytes) -> int:
        found = self.known.get(feature)
        if found is None:
            found = zlib.crc32(feature) % self.buckets
            if len(self.known) < KNOWN:
                self.known[feature] = found
        return found


def inside(words: list[bytes], grams: int) -> list[bytes]:
    """All runs of 1 to ``grams`` words of one line."""
    out = list(words)
    for m in range(2, grams + 1):
        out += [b" ".join(words[i:i + m]) for i in range(len(words) - m + 1)]
    return out


def across(lines: list[list[bytes]], grams: int) -> list[bytes]:
    """All runs of 2 to ``grams`` words of a text that begin in one line and end in a later one."""
    words = [w for line in lines for w in line]
    out, first = [], 0
    for line in lines:
        if not line:
            continue
        end = first + len(line)  # runs that begin in this line and reach over its end
        for i in range(max(first, end - grams + 1), end):
            out += [b" ".join(words[i:i + m]) for m in range(end - i + 1, min(grams, len(words) - i) + 1)]
        first = end
    return out


def _bucket_lists(df: DataFrame, text_col: str, keep: list[str], buckets: int, grams: int, crossing: bool) -> DataFrame:
    """``keep``, n_words and the bucket of every feature: those inside the lines of ``text_col``, or those across its lines."""
    given = df.select(*keep, F.col(text_col).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = Buckets(buckets)
        for batch in slices(batches, "_text", BATCH_BYTES):
            n_words, values, ends = [], [], [0]
            for text in batch.column("_text").to_pylist():
                lines = [gram_words(line) for line in (text or "").encode().split(b"\n")]
                features = across(lines, grams) if crossing else [f for words in lines for f in inside(words, grams)]
                values += [bucket(f) for f in features]
                n_words.append(sum(map(len, lines)))
                ends.append(len(values))
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(n_words, pa.int64()), found], [*keep, "n_words", "buckets"])

    kinds = [f"{c} {given.schema[c].dataType.simpleString()}" for c in keep]
    return given.mapInArrow(run, ", ".join([*kinds, "n_words long", "buckets array<int>"]))


def line_features(texts: DataFrame, text_col: str, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(l1, l2, times, n_words, buckets): the features of every distinct line, made once, and how often the line occurs; stored.

    Lines are counted before they are shuffled, so a line of a third of all rows is one row a task. Lines are told
    apart by their whole text; two 64-bit hashes stand for them afterwards. Lines without a word are left out.
    """
    lines = texts.select(F.explode(F.split(text_col, "\n")).alias("line")).filter(_has_word(F.col("line"))).groupBy("line").agg(F.count("*").alias("times"))
    l1, l2 = text_key(F.col("line"))
    return settle(_bucket_lists(lines.select(l1.alias("l1"), l2.alias("l2"), "times", "line"), "line", ["l1", "l2", "times"], buckets, grams, False), "line-features")


def cross_features(texts: DataFrame, keep: list[str], text_col: str, grams: int, buckets: int = BUCKETS) -> DataFrame:
    """``keep`` and the buckets of the n-grams across lines, for every row with any; stored."""
    made = _bucket_lists(texts.filter(F.contains(text_col, F.lit("\n"))), text_col, keep, buckets, grams, True)
    return settle(made.filter(F.size("buckets") > 0).select(*keep, F.lit(1).cast("long").alias("times"), "buckets"), "cross-features")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[0-9A-Za-z]|[^\x00-\x7F]")


def bucket_counts(features: list[DataFrame], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the occurrences of each bucket's features. A task adds its rows in one array of ``buckets`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            lists = batch.column("buckets")
            np.add.at(total, lists.flatten().to_numpy(), np.repeat(batch.column("times").to_numpy(), lists.value_lengths().to_numpy()))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": some, "n": total[some]}, pa.schema([("bucket", pa.int32()), ("n", pa.int64())]))

    parts = [f.select("times", "buckets").mapInArrow(run, "bucket int, n long") for f in features]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.union(part)
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket floor(1000 ln) of its smoothed share of the target's features over its share of the source's.

    Both are ``bucket_counts``; the driver receives ``buckets`` numbers at most.
    """
    s = source.select("bucket", F.col("n").alias("s"))
    both = s.join(target.select("bucket", F.col("n").alias("t")), "bucket", "full").fillna(0, ["s", "t"])
    held = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
    counts = np.zeros((2, buckets))
    for row in held:
        counts[:, row.bucket] = row.s, row.t
    n, m = counts.sum(1) + buckets
    return np.floor(1_000 * np.log((counts[1] + 1) * n / ((counts[0] + 1) * m))).astype(np.int64)


def _weighed(features: DataFrame, keep: list[str], gain: np.ndarray) -> DataFrame:
    """``keep``, n_features and the sum of the gains of the row's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            sizes = lists.value_lengths().to_numpy()
            sums = np.r_[0, np.cumsum(gain[lists.flatten().to_numpy()])]
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sizes.astype(np.int64)), pa.array(sums[ends] - sums[ends - sizes])], [*keep, "n_features", "weight"])

    kinds = [f"{c} {features.schema[c].dataType.simpleString()}" for c in keep]
    return features.select(*keep, "buckets").mapInArrow(run, ", ".join([*kinds, "n_features long", "weight long"]))


def importance(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, weight) for every row: the gain of the target over all documents, summed over the row's features.

    Features are runs of 1 to ``grams`` consecutive words. A newline separates words, so a text's features are those
    inside its lines and those across them: the first are made and weighed once for each distinct line of the corpus
    and added as often as the line occurs, the second are made for each text and added apart.

    Lines meet their weights by two 64-bit hashes. The few lines that hold a thousandth or more of all occurrences
    are broadcast (fewer than HOT by arithmetic), their occurrences dealt by text. Null and empty texts have no
    features and weigh 0; repeated rows are rows of their own; an empty target or table leaves the smoothed shares.
    """
    k1, k2 = text_key(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), F.col(text_col).alias("text"))
    goal = target.select(F.col(target_col).alias("text"))
    lines, wanted = line_features(rows, "text", grams, buckets), line_features(goal, "text", grams, buckets)
    source_parts, target_parts = [lines], [wanted]
    if grams > 1:
        source_parts.append(cross_features(rows, ["id", "k1", "k2"], "text", grams, buckets))
        target_parts.append(cross_features(goal, [], "text", grams, buckets))
    gain = gains(bucket_counts(source_parts, buckets), bucket_counts(target_parts, buckets), buckets)

    weights = settle(_weighed(lines, ["l1", "l2", "times", "n_words"], gain), "line-weights")
    total = weights.agg(F.coalesce(F.sum("times"), F.lit(0))).first()[0]
    often = F.col("times") * HOT > total
    hot = F.broadcast(weights.filter(often).select(F.col("l1").alias("h1"), F.col("l2").alias("h2"), F.struct("n_words", "n_features", "weight").alias("hot")))
    rest = weights.filter(~often).select(F.col("l1").alias("r1"), F.col("l2").alias("r2"), F.struct("n_words", "n_features", "weight").alias("rest"))

    # a null line stands for the row itself, so rows without words stay
    place = rows.select("id", "k1", "k2", F.explode(F.concat(F.array(F.lit(None).cast("string")), F.filter(F.coalesce(F.split("text", "\n"), F.array().cast("array<string>")), _has_word))).alias("line"))
    l1, l2 = text_key(F.col("line"))
    place = place.select("id", "k1", "k2", F.when(F.col("line").isNull(), 1).otherwise(0).alias("row"), l1.alias("l1"), l2.alias("l2"))
    place = place.join(hot, (F.col("l1") == F.col("h1")) & (F.col("l2") == F.col("h2")), "left")
    alone = (F.col("row") == 1) | F.col("hot").isNotNull()
    place = place.select("id", "k1", "k2", "row", "hot", F.when(alone, F.col("k1")).otherwise(F.col("l1")).alias("l1"), F.when(alone, F.xxhash64("id")).otherwise(F.col("l2")).alias("l2"), alone.alias("alone"))
    place = place.join(rest, (F.col("l1") == F.col("r1")) & (F.col("l2") == F.col("r2")) & ~F.col("alone"), "left")
    part = lambda c: F.coalesce(F.col(f"hot.{c}"), F.col(f"rest.{c}"), F.lit(0)).alias(c)
    place = place.select("id", "k1", "k2", "row", part("n_words"), part("n_features"), part("weight"))
    if grams > 1:
        over = _weighed(source_parts[1], ["id", "k1", "k2"], gain)
        place = place.union(over.select("id", "k1", "k2", F.lit(0), F.lit(0).cast("long"), "n_features", "weight"))
    sums = place.groupBy("id", "k1", "k2").agg(F.sum("row").alias("rows"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "weight")])
    share = lambda c: F.expr(f"{c} div rows").alias(c)  # noqa: E731  (equal rows were added up)
    sums = sums.select("id", "rows", *[share(c) for c in ("n_words", "n_features", "weight")])
    blocks = sums.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr("(rows - 1) div 10000"))))
    return blocks.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.lit(10_000), F.col("rows") - 10_000 * F.col("block"))))).drop("rows", "block", "copy")


def drawn(weighed: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) for every row of ``importance``: ``per_cent`` of those with ``least_words`` words have a rank.

    score is the weight plus a Gumbel number that the seed and the id alone give, in thousandths, so the highest
    scores are a draw without replacement by weight. Ties go to the smaller id. Rows without id draw alike, and
    repeated rows follow one another. Ranks come from ranges of the scores, never from one sorted task.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1_000 * F.log(-F.log((h + 0.5) / 4_294_967_296.0)))
    scored = settle(weighed.withColumn("score", F.col("weight") + noise), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    last = able.count() * per_cent // 100
    ranked = sorted_rank(able.withColumn("below", -F.col("score")), [], ["below", "id"]).drop("below")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= last, F.col("rank").cast("long")))
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


OP13_SQL = rf"""
WITH RECURSIVE crc_table AS (SELECT i AS byte, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)),
words AS (
    SELECT 's' AS side, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
    UNION ALL SELECT 't', item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
steps AS (
    SELECT w, hex(encode(w)) AS x, 0 AS pos, 4294967295::BIGINT AS crc FROM (SELECT DISTINCT w FROM words)
    UNION ALL
    SELECT w, x, pos + 1, xor(v, crc >> 8) FROM steps JOIN crc_table ON byte = xor(crc & 255, ('0x' || substr(x, 2 * pos + 1, 2))::BIGINT) WHERE 2 * pos < length(x)),
bucket AS (SELECT w, xor(crc, 4294967295) % {BUCKETS} AS b FROM steps WHERE 2 * pos = length(x)),
held AS (SELECT side, id, b FROM words JOIN bucket USING (w)),
counts AS (SELECT b, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM held GROUP BY b),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (t_all + {BUCKETS})::DOUBLE)))::BIGINT AS g FROM counts, totals),
weighed AS (SELECT id, count(*) AS n, sum(g)::BIGINT AS weight FROM held JOIN gain USING (b) WHERE side = 's' GROUP BY id),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weighed ON doc_id = id),
ranked AS (SELECT *, n_features >= {LEAST_WORDS} AS able, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () AS n_able FROM scored)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score, CASE WHEN able AND place <= {PER_CENT} * n_able // 100 THEN place END::BIGINT AS rank FROM ranked
"""


@query(OP13_SQL)
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight and score towards the benchmark texts, and its rank among those drawn."""
    found = drawn(importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
