"""Importance resampling against weights computed from whole texts, without lines."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from guichet.llm.resample import across, drawn, gram_words, importance, inside

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_in(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def features(text, grams):
    words = words_in(text)
    return [" ".join(words[i:i + m]).encode() for m in range(1, grams + 1) for i in range(len(words) - m + 1)]


def brute(docs, goal, grams, buckets):
    s, t = (Counter(zlib.crc32(f) % buckets for x in texts for f in features(x, grams)) for texts in ((x for _, x in docs), goal))
    n, m = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1_000 * math.log((t[b] + 1) * n / ((s[b] + 1) * m))) for b in {*s, *t}}
    return sorted(((d, len(words_in(x)), len(f := features(x, grams)), sum(gain[zlib.crc32(y) % buckets] for y in f)) for d, x in docs), key=str)


def test_features_inside_and_across_lines_are_all_features():
    r = random.Random(4)
    for _ in range(400):
        text = "".join(r.choice("ab9Éß .,\n\n\t") for _ in range(r.randrange(60)))
        for grams in (1, 2, 3, 5):
            lines = [gram_words(line) for line in text.encode().split(b"\n")]
            made = [f for line in lines for f in inside(line, grams)] + across(lines, grams)
            assert sorted(made) == sorted(features(text, grams)), (text, grams)


@pytest.mark.parametrize("grams", [1, 3])
def test_importance_on_awkward_rows(spark, odd, nothing, grams):
    goal = spark.createDataFrame([(1, "the cat sat home\nagain the cat"), (2, None), (3, ""), (1, "the cat sat home\nagain the cat")], "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted((tuple(r) for r in importance(odd, goal, grams=grams, buckets=500).collect()), key=str)
    assert got == brute(docs, [r.text for r in goal.collect()], grams, 500)
    assert importance(nothing, goal, grams=grams).count() == 0
    got = sorted((tuple(r) for r in importance(odd, goal.limit(0), grams=grams, buckets=500).collect()), key=str)
    assert got == brute(docs, [], grams, 500)


def test_a_hot_line_and_equal_rows(spark):
    docs = [(k % 700, f"Shared line of all\nown{k % 700} word\nShared line of all") for k in range(1_400)] + [(None, "x")] * 3
    goal = ["shared own7"]
    got = importance(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(g,) for g in goal], "text string"), buckets=400)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, goal, 1, 400)


def test_drawn_ranks(spark):
    rows = [(k // 2 if k < 40 else k, 5 + k % 40, k, (k * 37) % 100) for k in range(400)] + [(None, 50, 1, 10_000)]
    got = [r.asDict() for r in drawn(spark.createDataFrame(rows, "id long, n_words long, n_features long, weight long"), per_cent=10, least_words=20).collect()]
    assert len(got) == len(rows)

    def score(d, weight):
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        return weight + math.floor(-1_000 * math.log(-math.log((h + 0.5) / 4_294_967_296)))

    assert all(r["score"] == score(r["id"], r["weight"]) for r in got)
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-score(r[0], r[3]), -1 if r[0] is None else r[0]))
    want = able[:len(able) * 10 // 100]
    picked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in picked] == list(range(1, len(want) + 1))
    assert [(r["score"], r["id"]) for r in picked] == [(score(r[0], r[3]), r[0]) for r in want]
