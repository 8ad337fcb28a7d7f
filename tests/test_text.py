import re
import unicodedata

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from guichet.functions import draws, text as T, vectors as V

SAMPLES = [
    "", "   ", "un", " deux mots ", "a\tb\nc\x0bd\x0ce\rf", " espace insécable　", "\x1cg\x1dh\x85i",
    "Été À Ç œuvre ﬁn ½ é", "l'accès au partage n°42_b x y", "ПРИВЕТ йод", "一二 三四", None,
]


def fold(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(spark, values, expr):
    return [r.x for r in frame(spark, values).select("i", expr.alias("x")).orderBy("i").collect()]


def test_strip_and_word_count_follow_python(spark):
    assert column(spark, SAMPLES, T.strip(T.text_or_empty("t"))) == [(s or "").strip() for s in SAMPLES]
    assert column(spark, SAMPLES, T.word_count("t")) == [len((s or "").split()) for s in SAMPLES]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=30), min_size=20, max_size=40))
def test_strip_and_word_count_on_random_text(spark, values):
    assert column(spark, values, T.strip("t")) == [s.strip() for s in values]
    assert column(spark, values, T.word_count("t")) == [len(s.split()) for s in values]


def test_full_text_joins_and_strips(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b "), (" a", "b")], "titre string, texte string")
    assert [r[0] for r in df.select(T.full_text("titre", "texte")).collect()] == ["", "a", "b", "a b"]


def test_tokens(spark):
    texts = [s for s in SAMPLES if s]
    plain = column(spark, texts, T.tokens("t", fold=False))
    assert plain == [re.findall(r"\b\w\w+\b", s.lower()) for s in texts]
    full = column(spark, texts, T.tokens("t"))
    assert full == [re.findall(r"\b\w\w+\b", fold(s.lower())) for s in texts]


def test_fold_accents_is_full_decomposition(spark):
    texts = ["Été À Ç naïve", "e\u0301te\u0301", "йод ΆΈ", "ａｂ", "ﬁn ½ ǆ ﷺ", "한국어 각", "𝐀𝟙 𑂚", "", "plain", "ⅷ №"]
    assert column(spark, texts, T.fold_accents("t")) == [fold(s) for s in texts]
    assert spark.createDataFrame([(None,)], "t string").select(T.fold_accents("t")).first()[0] is None


def test_fold_accents_over_all_of_unicode(spark):
    texts = ["".join(chr(p) for p in range(start, start + 256) if not 0xD800 <= p < 0xE000 and p) for start in range(0, 0x30000, 256)]
    assert column(spark, texts, T.fold_accents("t")) == [fold(s) for s in texts]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(T.ngrams("w")).collect()] == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert [r[0] for r in df.select(T.ngrams("w", 2, 3)).collect()] == [["a b", "b c", "a b c"], [], []]


def test_small_text_helpers(spark):
    df = spark.createDataFrame([("l1\nl2\nl3\nl4\nl5", 7.9, {"a": "x"})], "t string, p double, m map<string,string>")
    r = df.select(T.first_lines("t").alias("h"), T.percent_bar("p").alias("b"), T.preview("t", 4).alias("p"), T.metadata_get("m", "a").alias("a"),
                  T.metadata_get("m", "zz").alias("z"), T.contains_any("t", ["L9".lower(), "l3"]).alias("c")).first()
    assert (r.h, r.b, r.p, r.a, r.z, r.c) == ("l1\nl2\nl3\nl4", "███", "l1\nl", "x", "N/A", True)


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    rows = df.select(V.cosine("a", "b").alias("c"), V.squared_l2("a", "b").alias("d"), V.l2_norm("a").alias("n"), V.to_distance(V.cosine("a", "b")).alias("x")).collect()
    assert [round(r.c, 9) for r in rows] == [0.96, 0.0]
    assert [r.d for r in rows] == [2.0, 2.0] and rows[0].n == 5.0 and rows[1].x == 1.0


def test_draws_are_stable_and_spread(spark):
    df = spark.range(20000).select(draws.draw_long(draws.draw_key(42, F.col("id"))).alias("d"))
    r = df.agg(F.min("d").alias("lo"), F.avg((F.col("d") % 10 == 3).cast("double")).alias("share"), F.count_distinct("d").alias("n")).first()
    assert r.lo >= 0 and abs(r.share - 0.1) < 0.01 and r.n == 20000


def test_now_text(spark):
    r = spark.range(1).select(T.now_text().alias("iso"), T.now_text("yyyy-MM-dd HH:mm:ss").alias("plain")).first()
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}", r.iso) and re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", r.plain)


def test_words_are_counted_without_asking_every_white_space_range_of_each_character(spark):
    import time

    slow = F.regexp_count("t", F.lit(f"[^{T.WHITESPACE_SET}]+"))
    texts = spark.range(0, 16, 1, 4).select(F.repeat(F.lit("quelques mots é d'un texte court\n"), 8_000).alias("t")).localCheckpoint()
    assert texts.filter(T.word_count("t") != slow).isEmpty()
    took = []
    for counted in (T.word_count("t"), slow):
        start = time.monotonic()
        texts.agg(F.sum(counted)).collect()
        took.append(time.monotonic() - start)
    assert took[0] < 0.6 * took[1]


def test_words_are_split_at_the_white_space_of_python_and_nothing_else(spark):
    points = [p for p in range(0x11000) if not 0xD800 <= p < 0xE000] + [0x10FFFF]
    rows = spark.createDataFrame([(f"a{chr(p)}b", len(f"a{chr(p)}b".split())) for p in points], "t string, n int")
    assert rows.filter(T.word_count("t") != F.col("n")).isEmpty()
