"""Periodic runs against a search for every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from guichet.llm.catalog import QUERIES
from guichet.llm.common import byte_words
from guichet.llm.periods import periodic_runs, runs_of
from tests_llm_paths import SF


def brute(words, least=6, times=4):
    """(start, length, period): each longest stretch of every period, unless a smaller period holds in it."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length >= max(least, times * q) and not any(all(words[j] == words[j + p] for j in range(s, s + length - p)) for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(r):
    words, letters = [], r.choice([1, 2, 3, 5])
    while len(words) < r.randrange(0, 90):
        block = [r.randrange(letters) for _ in range(r.randrange(1, 9))]
        words += (block * r.randrange(1, 8))[:r.randrange(1, 60)]
    return words


@pytest.mark.parametrize("times", [4, 5])
def test_runs_equal_brute_force(times):
    r = random.Random(times)
    for _ in range(600):
        words = random_words(r)
        assert [tuple(x) for x in runs_of(np.array(words, np.int64), 6, times).tolist()] == brute(words, 6, times), words


def test_fewer_repetitions_than_the_proof_needs_are_refused():
    with pytest.raises(ValueError):
        runs_of(np.zeros(9, np.int64), times=3)


def test_runs_do_not_cross_texts_and_a_long_repetitive_text_ends_soon():
    assert runs_of(np.array([1, 1, 1, -1, 1, 1, 1])).tolist() == []
    n = 400_000
    assert runs_of(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]
    assert runs_of(np.arange(n) % 99_991).tolist() == [[0, n, 99_991]]


def test_periodic_runs_on_awkward_rows(spark, odd, nothing):
    rows = periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    words = {(r.doc_id, tuple(w.decode() for w in (r.text or "").encode().split())) for r in odd.select("doc_id", "text").collect()}
    want = {(d, tuple(brute(w)) if len(w) < 1_000 else ()) for d, w in words}
    assert {(r.id, tuple((x.start, x.length, x.period) for x in r.runs)) for r in rows} == want
    assert {r.collapsed for r in rows if r.id in (2, 3, 4)} == {""}
    assert [r.collapsed for r in rows if r.id == 9] == ["é ü 漢字"]
    assert periodic_runs(nothing).count() == 0


def test_query_equals_brute_force(spark, duck):
    got = {r.doc_id: r.asDict() for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(got) == len(docs)
    found = 0
    for doc, text in docs:
        words = [w.decode() for w in (text or "").encode().split()]
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words) if n < 2_000 else [tuple(x) for x in runs_of(np.unique(words, return_inverse=True)[1]).tolist()]
        found += bool(runs)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        assert got[doc] == {
            "doc_id": doc, "n_runs": len(runs), "start": top[0], "length": top[1], "period": top[2],
            "exponent_milli": 1_000 * top[1] // top[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(collapsed(words, runs).encode()).hexdigest(),
        }
    assert found > 10


def test_words_split_at_the_six_white_space_characters():
    assert byte_words("a\x1cb\x85c d e\x0bf".encode()) == ["a\x1cb\x85c d".encode(), b"e", b"f"]
