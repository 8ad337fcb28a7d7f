import math
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from guichet.operators import search as R, tfidf as W
from guichet.sources import stores

TEXTS = ["le chat noir dort", "le chat blanc et le chien", "un chien noir noir", "été Été ete", "", "x y z", "le le le le chat"]


def brute(texts, min_df, max_features, sublinear):
    grams = []
    for t in texts:
        w = re.findall(r"\w\w+", t.lower())
        grams.append(Counter(w + [" ".join(p) for p in zip(w, w[1:])]))
    df, cf = Counter(), Counter()
    for g in grams:
        df.update(g.keys())
        cf.update(g)
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-cf[t], t))[:max_features]
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    vectors = []
    for g in grams:
        v = {t: (1 + math.log(n) if sublinear else n) * idf[t] for t, n in g.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        vectors.append({t: x / norm for t, x in v.items()})
    return idf, vectors


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text_full string").repartition(3)


@pytest.mark.parametrize("min_df,max_features,sublinear", [(1, 1000, False), (2, 50, True), (1, 5, True), (1, 1, False)])
def test_tfidf_matches_the_formula(spark, min_df, max_features, sublinear):
    config = W.TfidfConfig(min_df=min_df, max_features=max_features, sublinear=sublinear)
    idf, vectors = brute(TEXTS, min_df, max_features, sublinear)
    model = W.fit_tfidf(docs(spark, TEXTS), config)
    got = {r.term: r.idf for r in model.vocab.collect()}
    assert got.keys() == idf.keys() and all(math.isclose(got[t], idf[t]) for t in idf)
    weights = {(r.id, r.term): r.weight for r in W.tfidf_weights(model, docs(spark, TEXTS), "id").collect()}
    want = {(i, t): x for i, v in enumerate(vectors) for t, x in v.items()}
    assert weights.keys() == want.keys() and all(math.isclose(weights[k], want[k]) for k in want)


@pytest.mark.parametrize("low,high,min_df,size", [(1, 2, 2, 12), (1, 3, 1, 7), (2, 3, 1, 5), (1, 1, 2, 4), (1, 2, 1, 10_000)])
def test_candidates_hold_the_vocabulary_and_few_pairs(spark, low, high, min_df, size):
    pick = np.random.default_rng(low + high + size)
    texts = [" ".join(f"w{min(int(x), 400)}" for x in pick.zipf(1.3, 60)) for _ in range(60)] + ["", "w1 w1 w1 w1"]
    config = W.TfidfConfig(low=low, high=high, min_df=min_df, max_features=size)
    df = W.terms_stage(config).transform(docs(spark, texts))
    every = W.term_statistics(df)
    want = [tuple(r) for r in W.vocabulary(every, len(texts), config).collect()]
    for stats in (W.candidate_statistics(docs(spark, texts), config), W.candidate_statistics(df, config, terms="terms")):
        assert sorted(tuple(r) for r in W.vocabulary(stats, len(texts), config).collect()) == sorted(want)
        rows = {tuple(r) for r in stats.collect()}
        assert rows <= {tuple(r) for r in every.collect()}
        assert size > 1_000 or len(rows) < every.count() / 2


def test_null_text_and_unknown_terms(spark):
    model = W.fit_tfidf(docs(spark, TEXTS), W.TfidfConfig())
    odd = spark.createDataFrame([(1, None), (2, "inconnu totalement"), (3, "chat inconnu")], "id int, text_full string")
    assert {(r.id, r.term) for r in W.tfidf_weights(model, odd, "id").collect()} == {(3, "chat")}
    with pytest.raises(ValueError, match="empty vocabulary"):
        W.fit_tfidf(docs(spark, ["", "x"]), W.TfidfConfig())


def test_fold_vocabularies_equal_separate_fits(spark):
    df = docs(spark, TEXTS).withColumn("fold", F.col("id") % 3)
    config = W.TfidfConfig(min_df=2, max_features=6, sublinear=True)
    for i, vocab in enumerate(W.fit_fold_vocabularies(df, config, "fold", 3)):
        alone = W.fit_tfidf(df.filter(F.col("fold") != i), config).vocab.drop("index")
        assert {tuple(r) for r in vocab.collect()} == {tuple(r) for r in alone.collect()}


def test_search_finds_the_right_note(spark, corpus):
    index = stores.build_tfidf_index(corpus, replace(W.INDEX_TFIDF, fold_accents=True), "text")
    wanted = {"a": ("huile de chaîne", "chaine"), "b": ("à quelle hauteur la selle", "selle"), "c": ("farine pour levain", "levain"), "d": ("buee du four", "four"), "e": ("pousser la pâte", "petrir")}
    asked = spark.createDataFrame([*((q, text) for q, (text, _) in wanted.items()), ("none", "zzz qqq")], "query_id string, text string")
    hits = R.tfidf_search(asked, index.model, index.vectors, 3).collect()
    first = {r.query_id: r.id for r in hits if r["rank"] == 1}
    assert first == {q: note for q, (_, note) in wanted.items()} | {"none": "chaine"}
    assert Counter(r.query_id for r in hits) == dict.fromkeys([*wanted, "none"], 3)
    assert [(r.id, r.similarity) for r in hits if r.query_id == "none"] == [("chaine", 0.0), ("four", 0.0), ("levain", 0.0)]
    only = R.tfidf_search(asked, index.model, index.vectors, 3, fill_zero=False)
    assert only.filter("query_id = 'none'").count() == 0 and only.filter("similarity <= 0").count() == 0


def vectors(spark, n, dim, seed, name):
    x = np.random.default_rng(seed).integers(-3, 4, (n, dim)).astype(float)
    x[0] = 0
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, embedding array<double>").repartition(4)


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
def test_dense_search_matches_brute_force_on_both_paths(spark, monkeypatch, metric):
    d, docs_df = vectors(spark, 300, 4, 1, "id")  # few distinct values: many exact ties
    q, asked = vectors(spark, 7, 4, 2, "query_id")
    want = []
    for i, v in enumerate(q):
        if metric == "cosine":
            s = [round(float(v @ x / (np.linalg.norm(v) * np.linalg.norm(x))), 9) if v.any() and x.any() else 0.0 for x in d]
        else:
            s = [-float(((v - x) ** 2).sum()) for x in d]
        best = sorted(range(len(d)), key=lambda j: (-s[j], j))[:5]
        want += [(i, r + 1, j) for r, j in enumerate(best)]
    key = lambda df: sorted((r.query_id, r["rank"], r.id) for r in df.collect())
    assert key(R.dense_search(asked, docs_df, 5, metric)) == want
    monkeypatch.setattr(R, "MAX_QUERIES", 4)
    monkeypatch.setattr(R, "DOCS_PER_GROUP", 50)
    assert key(R.dense_search(asked, docs_df, 5, metric)) == want


def test_dense_search_edge_cases(spark):
    docs_df = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("n", None), ("z", [0.0, 0.0])], "id string, embedding array<float>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<float>")
    rows = R.dense_search(asked, docs_df, 10).orderBy("rank").collect()
    assert [(r.id, r.similarity, r.distance) for r in rows] == [("a", 1.0, 0.0), ("b", 1.0, 0.0), ("z", 0.0, 1.0)]
    assert R.dense_search(asked.limit(0), docs_df, 3).count() == 0
    with pytest.raises(ValueError):
        R.dense_search(asked, docs_df, 3, "manhattan")


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
def test_vectors_without_a_number_hide_no_hits(spark, metric):
    nan = float("nan")
    rows = [(i, [nan, 1.0] if i % 17 == 3 else [float(i), 1.0]) for i in range(60)] + [(99, [float("inf"), 0.0])]
    docs_df = spark.createDataFrame(rows, "id long, embedding array<double>").coalesce(1)
    asked = spark.createDataFrame([("q", [10.0, 1.0]), ("bad", [nan, 0.0])], "query_id string, embedding array<double>")
    hits = R.dense_search(asked, docs_df, 3, metric).collect()
    assert [r.id for r in sorted(hits, key=lambda r: r["rank"])][0] == 10 and len(hits) == 3 and {r.query_id for r in hits} == {"q"}


def test_vectors_of_another_length_fail(spark):
    docs_df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0, 0.0])], "id long, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0, 0.0])], "query_id string, embedding array<double>")
    with pytest.raises(Exception, match="entries"):
        R.dense_search(asked, docs_df, 3).collect()


def test_tiny_distances_are_told_apart(spark):
    docs_df = spark.createDataFrame([(i, [1.0 + (5 - i) * 1e-5, 0.0]) for i in range(5)], "id long, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    hits = R.dense_search(asked, docs_df, 2, "l2sq").orderBy("rank").collect()
    assert [r.id for r in hits] == [4, 3] and hits[0].distance == pytest.approx(1e-10, rel=1e-6)


def test_index_survives_storage(spark, corpus, tmp_path):
    index = stores.build_tfidf_index(corpus, W.INDEX_TFIDF, "text")
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        stores.load_tfidf_index(spark, path)
    stores.save_tfidf_index(index, path)
    broken = stores.TfidfIndex(index.model, index.vectors, corpus.select(F.raise_error(F.lit("lost")).alias("id")))
    with pytest.raises(Exception, match="lost"):
        stores.save_tfidf_index(broken, path)
    assert stores.load_tfidf_index(spark, path).chunks.count() == 6  # a failed build changes nothing
    first = {p.name for p in (tmp_path / "index").glob("build-*")}
    stores.save_tfidf_index(index, path)  # a rebuild replaces the old tables
    assert len({p.name for p in (tmp_path / "index").glob("build-*")} & first) == 1  # what is left is the broken build's
    loaded = stores.load_tfidf_index(spark, path)
    asked = spark.createDataFrame([("q", "levain four")], "query_id string, text string")
    a = R.tfidf_search(asked, index.model, index.vectors, 6).orderBy("rank").collect()
    assert a == R.tfidf_search(asked, loaded.model, loaded.vectors, 6).orderBy("rank").collect()
    assert loaded.chunks.count() == 6 and loaded.model.vocab.count() == index.model.size


def test_embedding_hook_and_dense_store(spark, corpus, tmp_path):
    def letters():
        def predict(texts):
            return np.array([[float(str(t).count(c)) for c in "aeiou"] for t in texts], dtype=np.float32)

        return predict

    path = str(tmp_path / "dense")
    stores.save_dense_index(stores.embed(corpus, letters), path, "letters")
    store = stores.load_dense_index(spark, path, "letters")
    asked = stores.embed(corpus.select(F.col("id").alias("query_id"), "text"), letters)
    best = R.dense_search(asked, store, 1).collect()
    assert {(r.query_id, r.id) for r in best} == {(r.id, r.id) for r in corpus.collect()}
    with pytest.raises(ValueError, match="letters"):
        stores.load_dense_index(spark, path, "other")


def test_weights_meet_their_terms_without_a_shuffle_of_the_weights(spark):
    model = W.fit_tfidf(docs(spark, TEXTS), W.TfidfConfig())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = W.tfidf_weights(model, docs(spark, TEXTS), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
