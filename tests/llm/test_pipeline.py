"""The pipeline, stage by stage, against what each stage promises."""

import re
import zlib
from collections import Counter

import pytest

import corpus_pipeline
from guichet.llm import decontaminate, simhash
from guichet.llm.common import byte_words
from tests_llm_paths import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, in order."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns_and_lengths(stages):
    for df in stages[:-1]:
        assert df.columns == COLUMNS and df.filter("n_chars <> length(text)").count() == 0


def test_copies_go_and_first_stay(stages):
    before = {r.doc_id: byte_words(r.text.encode()) for r in stages[0].collect()}
    after = {r.doc_id for r in stages[1].collect()}
    sets = {d: set(simhash.shingles(w, 5)) for d, w in before.items()}
    for d, words in before.items():
        same = [x for x in before if before[x] == words]
        assert len(after & set(same)) <= 1
        if d not in after:  # something like it stayed, directly or through others that went
            assert max(len(sets[d] & sets[x]) / len(sets[d] | sets[x]) for x in before if x != d) > 0.6
    kept = sorted(after)
    close = [(a, b) for k, a in enumerate(kept) for b in kept[k + 1:] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert not close


def test_no_leaks_left(stages, duck):
    items = [decontaminate.squeezed(t.encode()) for t, in duck.execute("SELECT text FROM benchmark").fetchall()]
    before, after = ({r.doc_id: decontaminate.squeezed(r.text.encode()) for r in df.collect()} for df in stages[1:3])
    leaked = {d for d, t in before.items() if any(i in t for i in items)}
    assert leaked and not leaked & set(after) and set(after) <= set(before)


def test_mixture_and_shards(stages):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sizes = {r.doc_id: words(r.text) for r in stages[2].collect()}
    taken = Counter()
    for r in stages[3].collect():
        taken[r.doc_id] += words(r.text)
    assert all(0 < taken[d] <= 2 * sizes[d] for d in taken)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.01 * sum(sizes.values())
    mixed = Counter((r.doc_id, r.text) for r in stages[3].collect())
    shards = stages[4].collect()
    assert Counter((r.doc_id, r.text) for r in shards) == mixed  # the shards hold the texts, as often as the mix has them
    assert all(r.size == len(r.text.encode()) + 8 and r.text_crc32 == zlib.crc32(r.text.encode()) for r in shards)


def _spied(monkeypatch):
    from guichet.llm import simhash

    sizes = []

    def settle(df, name="settled", path=None, settle=simhash.settle):
        out = settle(df, name, path)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(simhash, "settle", settle)
    return sizes


def test_unlike_texts_under_frequent_shingles_make_no_pairs(spark, monkeypatch):
    import random

    from guichet.llm import simhash

    rng, sizes = random.Random(5), _spied(monkeypatch)
    monkeypatch.setattr(simhash, "COMMON", 1_000)  # nothing counts as common, so the passage is in the prefixes
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(60))) for i in range(60)]
    kept = simhash.drop_near_copies(spark.createDataFrame([*rows, (99, rows[7][1] + " ende")], "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    assert [n for name, n in sizes if name == "candidates"][1] == 0


def test_fingerprints_propose_pairs_that_the_sets_decide(spark):
    from guichet.llm import simhash

    words = [f"wort{i}" for i in range(400)]
    texts = {3: words, 5: [*words, "ende"], 8: words[::-1], 9: [*words[:399], "anders"]}
    given = spark.createDataFrame([(k, " ".join(t).encode()) for k, t in texts.items()], "node long, text binary")
    fp = {k: simhash.fingerprint([w.encode() for w in t]) for k, t in texts.items()}
    near = {(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 6}
    got = {(r.a, r.b) for r in simhash.fingerprint_pairs(given, 6).collect()}
    assert got and got <= near and {(3, 5), (3, 9), (5, 9)} >= got
    roots = {r.node: r.root for r in simhash.components(simhash.similar_links(given, 5, 0.8)).collect()}
    assert roots == {3: 3, 5: 3, 9: 3}
