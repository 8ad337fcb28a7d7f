"""Every corpus operator on awkward rows, on nothing, and against SQL or a brute-force version."""

import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from guichet.llm import decontaminate, kdtree, lines, logbilinear, mixture, packing, secrets, simhash, spread, urls
from guichet.llm.catalog import ORACLES, QUERIES
from guichet.llm.common import byte_words, running_offset
from guichet.llm.components import components
from tests_llm_paths import SF


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def documents(duck):
    return duck.execute("SELECT doc_id, text, source FROM documents ORDER BY 1").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str) == want


# Simhash


def union_find(nodes, pairs):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_query(spark, duck):
    texts = {d: byte_words(t.encode()) for d, t, _ in documents(duck)}
    fp = {d: simhash.fingerprint(w) for d, w in texts.items()}
    ids = sorted(fp)
    groups = union_find(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fp[a] ^ fp[b]).bit_count() <= 2])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_pigeonhole"](spark, SF).collect()}
    assert got == {d: (f"{fp[d]:016x}", groups[d]) for d in ids}


def test_simhash_odd_rows(odd, nothing):
    got = simhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.id, set()).add((r.fp, r.component_id))
    assert by_id[2] == by_id[3] == by_id[4] == {(0, 2)}
    assert by_id[6] == by_id[1] and len(by_id[1]) == 1
    assert simhash.near_groups(nothing).count() == 0


def test_fingerprint_by_hand():
    import xxhash
    words = [b"a", b"b", b"c", b"a", b"b", b"c"]
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(4)]
    assert simhash.fingerprint(words) == sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) > 2)
    assert simhash.fingerprint([]) == 0
    assert simhash.fingerprint([b"a", b"b"]) == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("radius, block", [(2, 8192), (6, 8192), (2, 8), (6, 8)])
def test_links_keep_components(spark, monkeypatch, radius, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    r = random.Random(radius)
    fps = {r.getrandbits(64) for _ in range(60)}
    for center in list(fps)[:6]:
        for _ in range(60):
            fps.add(center ^ sum({1 << r.randrange(64) for _ in range(r.randint(1, radius + 3))}))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    nodes = spark.createDataFrame([(f, f) for f in fps], "node long, fp long").repartition(3)
    got = {x.node: x.root for x in components(simhash.links(nodes, radius)).collect()}
    want = union_find(fps, [(a, b) for k, a in enumerate(fps) for b in fps[k + 1:] if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= radius])
    assert {f: got.get(f, f) for f in fps} == want


def test_plan_spends_the_pigeonhole_sum():
    r = np.random.default_rng(0)
    bits = np.hstack([r.integers(0, 2, (500, 64)), np.ones((500, 1), int)]).astype(float)
    for radius in (0, 1, 2, 5, 8):
        parts = simhash.plan(bits.T @ bits, radius)
        assert sorted(b for g, _ in parts for b in g) == list(range(64))
        assert sum(e for _, e in parts) == radius - len(parts) + 1


def test_components_of_a_chain(spark):
    n = 300
    links = spark.range(n - 1).selectExpr("id AS a", "id + 1 AS b").union(spark.createDataFrame([(1000, 1001), (5, 5), (None, 3)], "a long, b long"))
    got = dict(rows_of(components(links)))
    assert got == {k: 0 for k in range(n)} | {1000: 1000, 1001: 1000}


def test_near_copies_dropped(spark, odd, nothing):
    base = [f"word{i}" for i in range(200)]
    other = base[:100] + [f"else{i}" for i in range(100)]
    made = [(1, " ".join(base)), (2, "\n".join(base).upper()), (3, " ".join([*base[:50], "new", *base[51:]])), (4, " ".join(other)), (None, " ".join(base)), (1, " ".join(base))]
    df = spark.createDataFrame(made, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_copies(df).collect()) == [1, 4]
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id) == [1, 2, 5, 7, 9, 10]
    assert simhash.drop_near_copies(nothing).count() == 0


@pytest.mark.parametrize("near,common", [(4, 8), (1, 2)])
def test_near_copies_against_brute_force(spark, monkeypatch, near, common):
    monkeypatch.setattr(simhash, "NEAR", near)
    monkeypatch.setattr(simhash, "COMMON", common)
    r, texts = random.Random(4), []
    words = lambda n: [f"w{int(r.paretovariate(0.7))}x{r.randrange(4)}" for _ in range(n)]
    for k in range(40):
        base = [f"v{k}u{i}" for i in range(84)]  # 80 shingles; 20 more make the similarity 0.8, 21 more less
        texts += [base, base + [f"e{k}u{i}" for i in range(20 + k % 2)]]
        base = words(r.randint(20, 120))
        texts.append(base)
        for _ in range(2):
            other = [w if r.random() > 0.025 else f"n{r.randrange(10**6)}" for w in base]
            texts.append(other[r.randrange(4):])
    hot = words(90)
    texts += [[w if r.random() > 0.02 else f"n{r.randrange(10**6)}" for w in hot] for _ in range(40)]
    sets = [set(simhash.shingles(" ".join(t).encode().split(), 5)) for t in texts]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    want = set(union_find(range(len(sets)), pairs).values())
    df = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    assert {x.doc_id for x in simhash.drop_near_copies(df).collect()} == want



# Quality rules


def brute_metrics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    filled = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(filled) - len(set(filled)), len(covered)


def test_base_metrics_on_odd_rows(odd, nothing):
    got = sorted((tuple(r) for r in lines.base_metrics(odd, ["doc_id"], "text").select("doc_id", *lines.COUNTS).collect()), key=str)
    assert got == sorted(((r.doc_id, *brute_metrics(r.text)) for r in odd.select("doc_id", "text").collect()), key=str)
    assert lines.line_verdicts(nothing)[0].count() == 0


def test_line_frequency_spares_the_first_copy(spark):
    shared = "this line of nine words is on every page"
    texts = [(k, f"{shared}\n" + " ".join(f"own{k}x{i}" for i in range(20)), "h") for k in range(30)]
    texts += [(100 + k, f"{shared}\nonly few words k{k}", "h") for k in range(5)] + [(200, texts[7][1], "h"), (300, f"{shared} and one more", "other"), (None, None, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string")
    verdicts = {r.id: r for r in lines.line_verdicts(df)[0].collect()}
    assert verdicts[0].words_left == 29 and verdicts[1].words_left == 20 and verdicts[200].words_left == 20
    assert not any(verdicts[100 + k].kept for k in range(5)) and verdicts[300].kept and not verdicts[None].kept
    cleaned = {r.doc_id: r.text for r in lines.clean_documents(df).collect()}
    assert cleaned[0] == texts[0][1] and cleaned[1] == texts[1][1].split("\n")[1] and 100 not in cleaned and cleaned[300] == f"{shared} and one more"


def test_large_hosts_lose_lines_that_many_texts_hold(spark):
    line = "all rights reserved by the host of this page"
    df = spark.range(110_000).selectExpr("id AS doc_id", "'a' AS source", f"concat_ws(' ', transform(sequence(1, 12), k -> concat('w', id, 'x', k))) || if(id < 1050, '\n{line}', '') AS text")
    held = lines.clean_documents(df).filter(F.col("text").contains(line))
    assert [r.doc_id for r in held.select("doc_id").collect()] == [0]
    assert lines.clean_documents(df, many_docs=None).filter(F.col("text").contains(line)).count() == 1050
    assert lines.line_verdicts(df)[0].filter("id < 1050").agg(F.sum(F.col("n_words") - F.col("words_left"))).first()[0] == 1049 * len(line.split())



def test_clean_documents_keeps_columns(odd, nothing):
    out = lines.clean_documents(odd)
    assert out.columns == odd.columns
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == [1, 1, 5, 6, 7, 8, 10]
    assert lines.clean_documents(nothing).count() == 0


# Site spread


def test_site_spread(spark, odd, nothing):
    rows = [(k, f"everywhere  Line\nonly {k}", f"s{k}") for k in range(8)] + [(20 + k, "five sites\nx", f"s{k}") for k in range(5)] + [(30, None, "s1"), (31, "everywhere line", None), (31, "everywhere line", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in spread.without_spread_lines(df, max_sites=5).collect()), key=str)
    want = [(k, 2, 1, f"only {k}") for k in range(8)] + [(20 + k, 2, 0, "five sites\nx") for k in range(5)] + [(30, 0, 0, None), (31, 1, 1, ""), (31, 1, 1, "")]
    assert got == sorted(want, key=str)
    assert spread.without_spread_lines(odd).count() == odd.count()
    assert spread.without_spread_lines(nothing).count() == 0


def test_site_spread_far_from_the_limit(spark):
    df = spark.range(3_000).selectExpr("id AS doc_id", "concat('on all sites\n', CASE WHEN id < 150 THEN 'on some' ELSE 'x' || id END) AS text", "concat('site', id) AS source")
    got = spread.without_spread_lines(df, max_sites=100).groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in got} == {1: 2850, 2: 150}


# Language model


def test_language_model(spark, duck):
    texts = {d: t.encode().lower().split() for d, t, _ in documents(duck)}
    counts = Counter()
    for d, w in texts.items():
        if zlib.crc32(str(d).encode()) % 5 != 1:
            counts.update([*w, None])
    n, v = sum(counts.values()), len(counts)
    held = [0, 0.0, 0.0]
    for r in QUERIES["op1_log_bilinear"](spark, SF).collect():
        tokens = [*texts[r.doc_id], None]
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1, len(tokens), sum(counts[t] > 0 for t in tokens), n)
        if r.held_out:
            held = [held[0] + len(tokens), held[1] + r.base_score, held[2] + r.score]
    assert held[2] / held[0] > held[1] / held[0] + 0.05  # better than token frequencies on texts not learned from


def test_model_is_normalised():
    r = np.random.default_rng(3)
    p = logbilinear.Parameters.fresh(np.full(logbilinear.CLASSES, 1 / logbilinear.CLASSES))
    p.target[:] = r.normal(0, 0.5, p.target.shape)
    a, b, log_z = p.tables()
    for w1, w2 in r.integers(0, logbilinear.CLASSES, (5, 2)):
        assert np.exp(a[w1].astype(float) + b[w2] - log_z[w1, w2]).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_on_odd_rows(odd, nothing):
    got = logbilinear.score_documents(odd).collect()
    assert len(got) == odd.count()
    assert all(r.n_tokens == 1 for r in got if r.id in (2, 3, 4)) and all(math.isfinite(r.score) for r in got)
    twins = [tuple(r) for r in got if r.id == 1]
    assert len(twins) == 2 and twins[0] == twins[1]
    assert logbilinear.score_documents(nothing).count() == 0


def test_language_model_without_training_rows(spark):
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1][:3]
    got = logbilinear.score_documents(spark.createDataFrame([(k, "a b") for k in ids], "doc_id long, text string")).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, pytest.approx(r.base_score, abs=1e-9) == 0) for r in got] == [(True, 0, 0, True)] * 3


# Packing


def test_best_fit_against_search():
    r = random.Random(0)
    for _ in range(100):
        length = r.choice([7, 8, 33, 100])
        sizes = [r.randint(1, length) for _ in range(r.randint(0, 60))]
        bins = []
        for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
            room = [(length - sum(sizes[i] for i in b) - sizes[k], j) for j, b in enumerate(bins)]
            room = [x for x in room if x[0] >= 0]
            bins[min(room)[1]].append(k) if room else bins.append([k])
        got = packing.best_fit(sizes, length)
        assert sorted(i for b in got for i in b) == list(range(len(sizes)))
        assert sorted(sum(sizes[i] for i in b) for b in got) == sorted(sum(sizes[i] for i in b) for b in bins)


def test_packing_round_trip(spark, duck, odd, nothing):
    for df, texts in ((spark.read.parquet(f"{SF}/documents.parquet"), {d: t for d, t, _ in documents(duck)}), (odd.filter("doc_id <> 1"), {r.doc_id: r.text for r in odd.collect()})):
        rows = packing.pack_tokens(df, length=256).collect()
        ids, places, found = packing.matrix(rows, "ids", 256), packing.matrix(rows, "positions", 256), {}
        for r, tokens, place in zip(rows, ids, places, strict=True):
            assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 256
            for doc, offset, a, b in zip(r.doc_ids, r.offsets, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
                assert place[a:b].tolist() == list(range(b - a))
                found.setdefault(doc, []).append((offset, tokens[a:b].tolist()))
        for doc, parts in found.items():
            tokens = [t for _, part in sorted(parts) for t in part]
            assert tokens[-1] == packing.END and packing.encoding(packing.VOCABULARY).decode(tokens[:-1]) == (texts[doc] or "")
        assert set(found) == {r.doc_id for r in df.select("doc_id").collect()}
    assert packing.pack_tokens(nothing).count() == 0


# URLs


def test_url_rules(spark):
    urls_ = ["http://a.b.net/x", "https://EXAMPLE.net/en/1?q", "http://notexample.net/en/1", "https://x.example.com/de/2#f", "http://foo.org/fr/", "http://org/fr/x", "http://net", "no scheme", None, "", "x://h/p://q"]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(urls_)], "page_id long, url string")
    host, path = urls.host_and_path(F.col("url"))
    rule, verdict = urls.rule_for(F.col("host"), F.col("path"))
    got = df.withColumn("host", host).withColumn("path", path).select("host", "path", rule, verdict).collect()
    assert [tuple(r) for r in got] == [
        ("a.b.net", "/x", "net/", "block"), ("example.net", "/en/1", "example.net/en/", "allow"), ("notexample.net", "/en/1", "net/", "block"), ("x.example.com", "/de/2", "example.com/de/", "block"),
        ("foo.org", "/fr/", "org/fr/", "allow"), ("org", "/fr/x", "org/fr/", "allow"), ("net", "", None, None), ("", "", None, None), ("", "", None, None), ("", "", None, None), ("h", "/p://q", None, None)]


def test_url_trees_on_held_out_urls(spark):
    """Machine-made URLs against readable ones: the trees must tell unseen ones apart by their looks."""
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeioulnrst") for _ in range(r.randint(4, 9)))
    good = [f"https://{word()}.example.org/{word()}/{word()}" for _ in range(300)]
    bad = [f"http://{r.getrandbits(40):x}.example.org/{r.getrandbits(64):x}?{word()}={r.getrandbits(30)}&s={r.getrandbits(30)}" for _ in range(300)]
    rows = [(u, 0.0) for u in good] + [(u, 1.0) for u in bad]
    r.shuffle(rows)
    host, path = urls.host_and_path(F.col("url"))
    df = urls.lexical(spark.createDataFrame(rows, "url string, label double").withColumn("host", host).withColumn("path", path)).withColumn("key", F.xxhash64("url"))
    model, counts, prior = urls.train(df.filter("key % 4 <> 0"))
    from pyspark.ml.feature import VectorAssembler
    held = model.transform(VectorAssembler(inputCols=urls.FEATURES, outputCol="features").transform(urls.with_suffixes(df.filter("key % 4 = 0"), counts, prior, own=False)))
    assert held.filter("prediction = label").count() / held.count() > 0.95


def test_url_query_and_odd_rows(spark, duck, nothing):
    got = QUERIES["op5_url_trees"](spark, SF).collect()
    assert len(got) == duck.execute("SELECT count(*) FROM pages").fetchone()[0]
    assert all(r.verdict in ("allow", "block") and (r.rule is None or r.verdict == dict((t, k) for k, t in urls.RULES)[r.rule]) for r in got)
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (2, "http://a.net/" + "b" * 100_000, "z")], "page_id long, url string, host string")
    assert sorted((r.id, r.rule, r.verdict) for r in urls.judge(df).collect() if r.rule) == [(2, "net/", "block")]
    assert urls.judge(df).count() == 3 and urls.judge(df.limit(0)).count() == 0


def test_entropy(spark):
    df = spark.createDataFrame([("",), ("aaaa",), ("abab",), ("abcd",)], "t string")
    assert [r[0] for r in df.select(urls.entropy(F.col("t"))).collect()] == [0.0, 0.0, 1.0, 2.0]


# Shards


def test_kd_tree(spark, duck, odd, nothing):
    got = QUERIES["op6_kd_tree"](spark, SF).collect()
    texts = {d: t.encode() for d, t, _ in documents(duck)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {d: (len(t) + 8, zlib.crc32(t)) for d, t in texts.items()}
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = kdtree.kd_shards(odd, shards=3).collect()
    texts = kdtree.kd_shards(odd, shards=3, with_text=True).collect()
    assert sorted((str(r.id), str(r.text)) for r in texts) == sorted((str(r.doc_id), str(r.text)) for r in odd.collect())
    assert len(got) == odd.count() and {r.shard for r in got} <= {0, 1, 2}
    assert kdtree.kd_shards(nothing, shards=4).count() == 0


def test_kd_tree_balance(spark):
    """A third of all rows are copies of one text; ties, nulls and one dimension without spread."""
    df = spark.range(6_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'same text for all' ELSE repeat('x', CAST(20 + id % 50 AS INT)) || id END AS text",
                                       "CASE WHEN id % 7 = 0 THEN NULL ELSE concat('s', id % 11) END AS source", "'en' AS lang", "id % 50 AS n_chars")
    got = kdtree.kd_shards(df, shards=7).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r.b for r in got]
    assert len(sizes) == 7 and max(sizes) < 1.02 * sum(sizes) / 7 and min(sizes) > 0.98 * sum(sizes) / 7
    whole = kdtree.kd_shards(df, target_bytes=50_000)
    assert whole.agg(F.countDistinct("shard")).first()[0] == -(-sum(sizes) // 50_000)


def test_equal_texts_share_a_shard(spark):
    """Groups up to a tenth of a shard are whole, a larger one is spread."""
    df = spark.range(4_000).selectExpr("id AS doc_id", "CASE WHEN id < 1500 THEN 'one text for many' WHEN id < 2000 THEN concat('small group of equal texts ', id % 100) ELSE concat('text ', id, ' alone') END AS text",
                                       "concat('s', id % 5) AS source", "'en' AS lang", "id % 50 AS n_chars")
    got = kdtree.kd_shards(df, shards=8).join(df.select(F.col("doc_id").alias("id"), "text"), "id")
    per = {r.text: r for r in got.groupBy("text").agg(F.count("*").alias("n"), F.countDistinct("shard").alias("shards")).collect()}
    assert per["one text for many"].shards > 1 and all(r.shards == 1 for t, r in per.items() if t != "one text for many")
    sizes = [r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert max(sizes) < 1.05 * sum(sizes) / 8 and min(sizes) > 0.95 * sum(sizes) / 8


def test_running_offset(spark):
    df = spark.range(500).selectExpr("id", "id % 2 = 0 AS g", "id % 7 AS w")
    for groups in (["g"], []):
        got = running_offset(df, groups, ["id"], "w", "at", 500, per_piece=20).collect()
        spans = {}
        for r in got:
            spans.setdefault(r.g if groups else 0, []).append((r["at"], r.w))
        for s in spans.values():
            at = 0
            for start, w in sorted(s):
                assert start == at
                at += w


# Mixture


def test_mixture(spark, duck):
    got = QUERIES["op7_block_mixture"](spark, SF).collect()
    source = {d: s for d, _, s in documents(duck)}
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r.taken <= 2 * r.size
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    want, full = waterfill(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 2 * mixture.BLOCK
    assert sorted(got) == sorted(QUERIES["op7_block_mixture"](spark, SF).collect())


def signed(n):
    return n - (1 << 64) if n >= 1 << 63 else n


def spark_hash(*values):
    """xxhash64 of 32-bit (a pair of value and 4) and 64-bit integers, as Spark chains it."""
    h = 42
    for v in values:
        raw = v[0].to_bytes(4, "little", signed=True) if isinstance(v, tuple) else v.to_bytes(8, "little", signed=True)
        h = xxhash.xxh64_intdigest(raw, seed=h)
    return signed(h)


def brute_permutation(s, epoch, n):
    out = []
    for x in range(n):
        for k in range(1, mixture.ROUNDS + 1):
            other = (spark_hash((37, 4), (s, 4), epoch, (k, 4)) % n - x) % n
            if spark_hash((41, 4), (s, 4), epoch, (k, 4), max(x, other)) % 2:
                x = other
        out.append(x)
    return out


def test_taken_words_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(d, rng.choice(["a", "a", "a", "b", "c", None]), " ".join(["w"] * rng.choice([0, 1, 7, 30, 400]))) for d in range(150)]
    block, shard = 10, 64
    m = mixture.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), block=block, shard=shard)
    order = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(t.split())
    target, _ = waterfill(sizes)
    blocks = {s: -(-sizes[s] // block) for s in order}
    slots = {s: math.floor(target[s] * blocks[s] / sizes[s] + 0.5) for s in order}
    bounds, total = [], 0
    for s in order:
        bounds.append((total, total + slots[s], s))
        total += slots[s]
    placed = [(k // shard, k % shard) for k in range(total)]
    drawn = [next(s for lo, hi, s in bounds if lo <= spark_hash((19, 4), a, b) % total < hi) for a, b in placed]
    assert Counter(drawn) != slots
    seen, surplus = Counter(), 0
    for s in drawn:
        seen[s] += 1
        surplus += seen[s] > slots[s]
    got = {(r.shard, r.place): (order[r.s], r.slot) for r in m.placed.collect()}
    assert set(got) == set(placed) and sum(got[p][0] != s for p, s in zip(placed, drawn, strict=True)) == surplus
    assert sorted(got.values(), key=str) == sorted(((s, j) for s in order for j in range(slots[s])), key=str)
    uses = Counter()
    for k, s in enumerate(order):
        for epoch in range(-(-slots[s] // blocks[s])):
            ring = brute_permutation(k, epoch, blocks[s])
            assert sorted(ring) == list(range(blocks[s]))
            uses.update((s, b) for b in ring[:slots[s] - epoch * blocks[s]])
    assert uses == Counter((order[r.s], r.block) for r in m.placed.collect())
    at, want = Counter(), {}
    for d, s, t in sorted(rows, key=lambda r: r[0]):
        n = len(t.split())
        want[d] = sum(uses[s, i // block] for i in range(at[s], at[s] + n))
        at[s] += n
    assert {r.id: r.taken for r in mixture.taken_words(m).collect()} == want


def waterfill(sizes):
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in full)) / (sum(weight[s] for s in sizes if s not in full) or 1)
        over = {s for s in sizes if s not in full and level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in sizes}, full
        full |= over


def test_mixed_documents(spark, odd, nothing):
    out = mixture.mixed_documents(odd)
    assert out.columns == odd.columns
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    have = {}
    for r in odd.collect():
        have.setdefault(r.doc_id, Counter()).update(words(r.text))
    for r in out.select("doc_id", "text").collect():
        assert not Counter(words(r.text)) - have[r.doc_id]
    assert mixture.taken_words(mixture.mix(odd)).count() == odd.count()
    assert mixture.mixed_documents(nothing).count() == 0 and mixture.taken_words(mixture.mix(nothing)).count() == 0


def test_mixture_shards(spark):
    df = spark.range(400).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', 100) AS text")
    m = mixture.mix(df, block=10, shard=100)
    placed = m.placed.collect()
    assert sorted((r.shard, r.place) for r in placed) == [(k // 100, k % 100) for k in range(len(placed))]
    per = Counter((r.shard, r.s) for r in placed)
    slots = {r.s: r.slots for r in m.sources.collect()}
    for (shard, s), n in per.items():
        if shard < len(placed) // 100:
            expected = 100 * slots[s] / len(placed)
            assert abs(n - expected) < 6 * (expected ** 0.5) + 1
    uses = Counter((r.s, r.block) for r in placed)
    for s in slots:
        assert max(n for (t, _), n in uses.items() if t == s) - min([n for (t, _), n in uses.items() if t == s]) <= 1


# Decontamination


def test_leaks(spark, duck, odd, nothing):
    items = {i: decontaminate.squeezed(t.encode()) for i, t in duck.execute("SELECT item_id, text FROM benchmark").fetchall()}
    want = {(d, i) for d, t, _ in documents(duck) for i, b in items.items() if b in decontaminate.squeezed(t.encode())}
    got = QUERIES["op9_qgram_decontamination"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= want and want
    texts = {d: t for d, t, _ in documents(duck)}
    for r in got:
        if (r.doc_id, r.item_id) in want:
            assert decontaminate.squeezed(texts[r.doc_id][r.start:r.end].encode()) == items[r.item_id]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.leaks(odd, bench).count() == 0 and decontaminate.leaks(nothing, bench).count() == 0 and decontaminate.leaks(odd, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(odd, bench).count() == odd.count()
    clean = decontaminate.without_leaks(spark.read.parquet(f"{SF}/documents.parquet"), bench, pass_bytes=2_000)
    assert {r.doc_id for r in clean.select("doc_id").collect()} == set(texts) - {r.doc_id for r in got}


def edits(a, b):
    """Least edits that turn a into some substring of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_edited_passages():
    r = random.Random(5)
    syllable = ["ka", "to", "mi", "ren", "sol", "ba", "vu", "nel", "shi", "or"]
    text = lambda n: " ".join("".join(r.choice(syllable) for _ in range(r.randint(1, 4))) for _ in range(n)).encode()
    items = [(k, text(r.randint(6, 60))) for k in range(30)] + [(99, b"too short"), (98, None)]
    matcher = decontaminate.Matcher(decontaminate.Index.build(items))
    for k, item in items[:30]:
        for share in (0.0, 0.03, 0.3):
            b = bytearray(item)
            for _ in range(int(len(b) * share)):
                at, kind = r.randrange(len(b)), r.randrange(3)
                if kind == 0:
                    b[at] = r.randrange(97, 123)
                elif kind == 1:
                    del b[at]
                else:
                    b.insert(at, r.randrange(97, 123))
            whole = decontaminate.squeezed(text(40) + b" " + bytes(b) + b" " + text(40))
            found = {f[1] for f in matcher.search([whole])}
            exact = any(edits(p, whole) <= decontaminate.budget(len(p)) for _, p in decontaminate.pieces_of(decontaminate.squeezed(item)))
            assert (k in found) == exact, (k, share)


def prose(r, least, most):
    """Words of random syllables, from ``least`` to ``most`` bytes."""
    syllable, size, out = ["ka", "to", "mi", "ren", "sol", "ba", "vu", "nel", "shi", "or"], r.randint(least, most), ""
    while len(out) < size:
        out += "".join(r.choice(syllable) for _ in range(r.randint(1, 4))) + " "
    return decontaminate.squeezed(out[:size].encode())


def test_excerpts_at_random_places():
    r = random.Random(7)
    items = [(k, prose(r, 66, 400)) for k in range(60)]
    matcher = decontaminate.Matcher(decontaminate.Index.build(items))
    for k, item in items:
        at = r.randint(0, len(item) - 63)
        whole = decontaminate.squeezed(prose(r, 100, 300) + b" " + item[at:at + 63] + b" " + prose(r, 100, 300))
        assert k in {f[1] for f in matcher.search([whole])}, (k, at)
        assert not matcher.search([prose(r, 500, 2_000)])



def test_every_occurrence_is_a_row():
    r = random.Random(8)
    items = [(k, prose(r, 30, 400)) for k in range(40)]
    matcher = decontaminate.Matcher(decontaminate.Index.build(items))
    for k, item in items:
        whole, want = prose(r, 80, 200), []
        for _ in range(3):
            want.append((0, k, len(whole) + 1, len(whole) + 1 + len(item), 0))
            whole += b" " + item + b" " + prose(r, 80, 200)
        assert sorted(matcher.search([whole])) == want
    k, item = max(items, key=lambda x: len(x[1]))  # each copy has lost another half
    half = len(item) // 2
    parts = [prose(r, 100, 100), item[:half].strip(), prose(r, 300, 300), item[half:].strip(), prose(r, 100, 100)]
    whole = b" ".join(parts)
    clean = whole.index(parts[2]), whole.index(parts[2]) + len(parts[2])
    found = sorted(matcher.search([whole]))
    assert len(found) == 2 and found[0][3] <= clean[0] + 2 and found[1][2] >= clean[1] - 2


def test_rulers_stay_cheap_and_exact():
    def line(k, ruler):
        return k, b"item %d begins with these words " % k + ruler + b" and closes with %d others" % (7 * k)

    for ruler, length in ((b"-" * 80, 2_000), (b"-=" * 40, 4_000), (b"+----" * 16, 4_000)):
        matcher = decontaminate.Matcher(decontaminate.Index.build([line(k, ruler) for k in range(50)]))
        begun = time.process_time()
        found = matcher.search([b"a text " + (ruler * length)[:length] + b" end", b"a text " + ruler[:40] + b" end"])
        assert time.process_time() - begun < 10
        assert {(t, k) for t, k, *_ in found} == {(0, k) for k in range(50)}  # 40 places of a ruler are no piece of 48
        assert all(5 <= b < e <= 7 + length + 5 for _, _, b, e, _ in found)


def test_blocks_of_a_benchmark_give_the_same_rows(spark, duck):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    once, often = (sorted(map(tuple, decontaminate.leaks(docs, bench, pass_bytes=b).collect())) for b in (1_000_000, 3_000))
    assert once and once == often



# Secrets


def brute_spans(text):
    out = [(m.start(), m.end(), "assign") for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 8]
    out += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


def test_base_spans(duck):
    made = ["password=short Token : 'abcdefgh' AKIA12345 AKIAAKIA1234567890 " + "0" * 31 + " " + "a" * 40, "é" * 5 + "API_KEY=\"aaaa.bbbb-cc\"", "pa\u017fsword=12345678", "secret==x token=password=abcdefgh123", ""]
    for text in [*made, *(t for _, t, _ in documents(duck))]:
        assert secrets.base_spans(text) == brute_spans(text)


def test_secret_query(spark, duck):
    import hashlib
    texts = {d: t for d, t, _ in documents(duck)}
    for r in QUERIES["op10_secret_charnet"](spark, SF).collect():
        base = brute_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, _, k in base) for kind in secrets.KINDS)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("net:")] == [x for x in joined.split(",") if x]


def test_network_finds_unlisted_keys(spark, odd, nothing):
    r = random.Random(6)
    sign = lambda signs, n: "".join(r.choice(signs) for _ in range(n))
    words = lambda: " ".join(sign("abcdefgilmnorstu", r.randint(2, 9)) for _ in range(12))
    texts = []
    for _ in range(400):
        texts.append(f"{words()} token = \"{sign('0123456789abcdef', 40)}\" {words()}")
        texts.append(f"{words()} {sign('abcdeilnorst', 6)}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com {words()} 2024-{r.randint(1, 12):02}-{r.randint(1, 28):02}-report {r.randint(10**13, 10**14)}")
        texts.append(f"{words()} AKIA{sign('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 16)} {words()}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    net = secrets.train(df)
    probe = [(k, f"{words()} {sign('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 36)}7 {words()}") for k in range(50)]
    probe += [(100 + k, f"{words()} {sign('abcdeilnorst', 6)}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com {words()}") for k in range(50)]
    found = {x.id: len(x.added) for x in secrets.scan(spark.createDataFrame(probe, "doc_id long, text string"), net).collect()}
    assert sum(found[k] > 0 for k in range(50)) >= 40 and sum(found[100 + k] > 0 for k in range(50)) <= 2
    assert secrets.scan(odd, net).count() == odd.count() and secrets.scan(nothing, net).count() == 0
    assert secrets.train(nothing).threshold == 1.0


def test_network_sees_keys_without_digits(spark):
    assert secrets.candidates("ab qwErTyUi, QWERTYUIOPasdf x") == [(3, 11), (13, 27)]
    r = random.Random(7)
    sign = lambda signs, n: "".join(r.choice(signs) for _ in range(n))
    words = lambda: " ".join(sign("abcdefgilmnorstu", r.randint(2, 14)) for _ in range(12))
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    texts = []
    for _ in range(400):
        texts.append(f"{words()} token = \"{sign(letters + '0123456789', r.randint(16, 40))}\" {words()}")
        texts.append(f"{words()} {sign('abcdeilnorst', 6)}.{r.randint(10, 99)}@mail{r.randint(1, 9)}.example.com {words()} 2024-{r.randint(1, 12):02}-report")
    net = secrets.train(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert net.recall >= 0.95
    probe = [(k, f"{words()} {sign(letters, 20)} {words()}") for k in range(50)] + [(100 + k, words()) for k in range(50)]
    found = {x.id: len(x.added) for x in secrets.scan(spark.createDataFrame(probe, "doc_id long, text string"), net).collect()}
    assert sum(found[k] > 0 for k in range(50)) >= 40 and sum(found[100 + k] > 0 for k in range(50)) <= 5



def key_texts(n, seed=8):
    r = random.Random(seed)
    sign = lambda signs, n: "".join(r.choice(signs) for _ in range(n))
    words = lambda: " ".join(sign("abcdefgilmnorstu", r.randint(2, 14)) for _ in range(12))
    return [f"{words()} token = \"{sign('0123456789abcdefABCDEF', r.randint(8, 40))}\" {words()} {r.randint(10**9, 10**11)} {words()}" for _ in range(n)]


def test_every_window_takes_part_in_training(spark):
    texts = key_texts(301)
    frame = lambda t: spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").coalesce(2)
    net, again, more = (secrets.train(frame(t), sample=20) for t in (texts[:300], texts[:300], texts))
    values = lambda n: np.concatenate([n.embed.ravel(), n.kernel.ravel(), n.bias, n.out])
    assert np.array_equal(values(net), values(again)) and net.threshold == again.threshold
    assert not np.allclose(values(net), values(more), atol=1e-6)


def test_threshold_comes_from_all_held_out_windows(spark):
    texts = key_texts(400)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    net = secrets.train(df, sample=10)
    rows = [(secrets.window_row(secrets.classes(t), s, min(e - s, secrets.SEEN)), min(e - s, secrets.SEEN)) for t in texts for s, e, g in secrets._labelled(t) if g == secrets.FOUND]
    x, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert len(x) >= 400 and (net.probability(net.rows(x, n)) >= net.threshold).mean() >= 0.9
    z, y, times = secrets._logits(df.select("text"), net)
    others = sum(len(secrets.windows(s, e)) for t in texts for s, e in secrets.candidates(t, secrets.base_spans(t)))
    assert times[y == 0].sum() == others and times[y > 0].sum() == 3 * len(x)


def test_logits_in_bins_give_the_threshold_of_all():
    r = np.random.default_rng(9)
    z, y = r.integers(-200, 200, 5_000) * secrets.BIN, (r.random(5_000) < 0.1).astype(float)
    both, times = np.unique(np.column_stack([z, y]), axis=0, return_counts=True)
    one, many = secrets.CharNet.fresh().settle(both[:, 0], both[:, 1], times, 0.95), secrets.CharNet.fresh().settle(z, y, np.ones(len(z)), 0.95)
    assert np.isclose(one.threshold, many.threshold) and np.isclose(one.recall, many.recall) and np.isclose(one.precision, many.precision) and one.recall >= 0.95


def test_training_gradient():
    r = np.random.default_rng(10)
    net = secrets.CharNet.fresh()
    net.bias = r.normal(0, 0.3, len(net.bias))
    coded, starts, lengths = r.integers(0, 97, 4_000).astype(np.uint8), np.sort(r.integers(0, 3_900, 60)), r.integers(1, secrets.SEEN + 1, 60)
    y, weights, values = (r.random(60) < 0.3).astype(float), r.random(60) / 60, net.values()

    def loss(row):
        m, total = net.with_values(row), 0.0
        for s, n, label, weight in zip(starts, lengths, y, weights, strict=True):
            seen = m.embed[coded[s:s + n + 2 * secrets.CONTEXT]]
            top = np.max([seen[p:p + m.width].ravel() @ m.kernel for p in range(len(seen) - m.width + 1)], axis=0)
            z = np.maximum(top + m.bias, 0) @ m.out + m.shift
            total += weight * (np.logaddexp(0, z) - label * z)
        return total

    grads = net.gradient(coded, starts, lengths, y, weights)
    flat = np.concatenate([grads[n].ravel() for n in secrets.NAMES] + [[grads["shift"]]])
    for k in [*r.choice(len(flat), 12), len(flat) - 1, len(flat) - 2, len(flat) - 30]:
        step = np.zeros(len(flat))
        step[k] = 1e-5
        assert np.isclose((loss(values + step) - loss(values - step)) / 2e-5, flat[k], rtol=1e-2, atol=1e-5)


def test_training_on_odd_tables(spark, odd):
    frame = lambda texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    secrets.train(odd)
    many = secrets.train(frame(["token=abcdefgh12345 zzzzzzzz1 " * 20_000]))
    assert many.recall >= 0.95
    assert secrets.train(frame([None, "", "nothing here"])).threshold == 1.0 and secrets.train(frame(["password=abcdefgh1"])).threshold == 1.0


def test_threshold_keeps_recall_where_classes_overlap():
    r = np.random.default_rng(4)
    x, y = r.integers(2, 97, (600, secrets.WIDTH)).astype(np.uint8), (r.random(600) < 0.3).astype(float)
    net = secrets.CharNet.fresh().calibrate(x, y, n := r.integers(8, secrets.SEEN + 1, 600), 0.95)
    over = net.probability(net.rows(x, n)) >= net.threshold
    assert over[y > 0].mean() >= 0.95 and net.recall == over[y > 0].mean() and net.precision == y[over].mean()


def test_windows_share_one_convolution(monkeypatch):
    r = random.Random(5)
    net = secrets.CharNet.fresh()
    text = "".join(r.choice("abcdefgh01 =.") for _ in range(900)) + "k" * 130
    coded = secrets.classes(text)
    spans = [w for s, e in secrets.candidates(text) for w in secrets.windows(s, e)]
    starts, lengths = (np.array(c) for c in zip(*spans, strict=True))
    want = []
    for s, n in spans:
        seen = net.embed[coded[s:s + n + 2 * secrets.CONTEXT]]
        places = [seen[p:p + net.width].ravel() @ net.kernel for p in range(len(seen) - net.width + 1)]
        want.append(np.maximum(np.max(places, axis=0) + net.bias, 0) @ net.out + net.shift)
    for places in (100, 1 << 16):
        monkeypatch.setattr(secrets, "PLACES", places)
        assert np.allclose(net.raw(coded, starts, lengths), want, atol=1e-4)
    assert np.allclose(net.rows(np.array([secrets.window_row(coded, *w) for w in spans]), lengths), want, atol=1e-4)


def test_candidates_are_what_base_spans_leave():
    r = random.Random(6)
    for _ in range(500):
        text = "".join(r.choice("aB3/ ") for _ in range(r.randrange(90)))
        base = sorted((s := r.randrange(90), s + r.randrange(1, 12), "x") for _ in range(r.randrange(4)))
        free = "".join(" " if any(s <= i < e for s, e, _ in base) else c for i, c in enumerate(text))
        assert secrets.candidates(text, base) == secrets.candidates(free), (text, base)


def test_a_text_with_very_many_findings_ends_soon(spark):
    text = "token=abcdefgh12345 zzzzzzzz1 " * 40_000
    net = secrets.CharNet.fresh()
    rows = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), net).select(F.size("base").alias("n")).collect()
    assert [r.n for r in rows] == [40_000]


def test_parity_sketches_never_reject_similar_sets():
    r = np.random.default_rng(8)
    told = 0
    for _ in range(300):
        n, m, both = r.integers(0, 900, 3)
        x = r.integers(-(1 << 63), (1 << 63) - 1, n + m + both)
        a, b = np.unique(x[:n + both]), np.unique(x[n:])
        apart = len(np.setxor1d(a, b))
        (na, pa_), (nb, pb) = simhash.parity_sketch(a), simhash.parity_sketch(b)
        assert (na, nb) == (len(a), len(b)) and simhash.least_apart(pa_, pb) <= apart
        told += simhash.least_apart(pa_, pb) > (na + nb) / 9 + 1e-6
        assert simhash.least_apart(pa_, pa_) == 0
    assert told > 150
