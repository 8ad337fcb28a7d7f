"""An index that grows by segments against one that is built anew."""

import os

import pytest

from guichet.operators import search as R
from guichet.sources import segments as S


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, embedding array<double>")


def stored(spark, path):
    return sorted(((r.id, r.embedding) for r in S.read(spark, path).collect()), key=str)


def test_changes_give_the_hits_of_a_rebuild(spark, tmp_path):
    path, state = str(tmp_path / "index"), {}
    steps = [({i: [float(i), 1.0] for i in range(12)}, []), ({3: [0.5, 9.0], 20: [2.0, 2.0]}, [5, 99]), ({5: [1.0, 7.0]}, [3]), ({}, [0]), ({0: [4.0, 4.0], 1: [9.0, 1.0]}, [0, 2])]
    for added, deleted in steps:
        before = {s.segment for s in S.segments(spark, path)}
        files = {s: sorted(os.listdir(os.path.join(path, s, "rows"))) for s in before}
        S.change(path, frame(spark, list(added.items())), frame(spark, [(i, None) for i in deleted]), merge=False)
        state = {i: v for i, v in state.items() if i not in deleted} | added
        assert stored(spark, path) == sorted(state.items(), key=str)
        after = S.segments(spark, path)
        assert len(after) == len(before) + 1 and after[-1].n_rows == len(added)
        assert all(sorted(os.listdir(os.path.join(path, s, "rows"))) == f for s, f in files.items())
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, [5.0, 1.0])], "query_id long, embedding array<double>")
    hits = lambda docs: sorted((r.query_id, r["rank"], r.id) for r in R.dense_search(asked, docs, 4).collect())
    assert hits(S.read(spark, path)) == hits(frame(spark, list(state.items())))
    assert S.merge_segments(spark, path, whole=True) and not S.merge_segments(spark, path, whole=True)
    assert stored(spark, path) == sorted(state.items(), key=str)
    assert [(s.n_rows, s.n_gone) for s in S.segments(spark, path)] == [(len(state), 0)]
    assert S.drop_unused(spark, path) == len(steps) and stored(spark, path) == sorted(state.items(), key=str)


def test_part_of_the_segments_is_merged(spark, tmp_path):
    path = str(tmp_path / "index")
    S.change(path, frame(spark, [(i, [1.0]) for i in range(500)]))
    first = S.segments(spark, path)[0].segment
    for k in range(4):
        S.change(path, frame(spark, [(k, [2.0]), (1000 + k, [3.0])]), frame(spark, [(100 + k, None)]))
    used = S.segments(spark, path)
    assert len(used) == 2 and used[0].segment == first and used[1].n_rows == 8
    want = {i: [1.0] for i in range(500)} | {k: [2.0] for k in range(4)} | {1000 + k: [3.0] for k in range(4)}
    assert stored(spark, path) == sorted(((i, v) for i, v in want.items() if not 100 <= i < 104), key=str)


@pytest.mark.parametrize("sizes, start", [([], 0), ([5], 1), ([100, 5, 5, 5], 4), ([100, 5, 5, 5, 5], 1), ([10, 5, 5, 5], 0), ([0, 0, 0, 0], 0)])
def test_first_to_merge(sizes, start):
    assert S._first_to_merge(sizes, 4) == start


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path / "index")
    with pytest.raises(FileNotFoundError):
        S.read(spark, path)
    S.change(path, frame(spark, []))
    S.change(path, frame(spark, [(None, [1.0]), (1, [1.0]), (1, [2.0])]))
    S.change(path, frame(spark, [(None, [3.0])]), frame(spark, [(None, None)]))
    assert stored(spark, path) == [(1, [1.0]), (1, [2.0]), (None, [1.0]), (None, [3.0])]
    S.change(path, frame(spark, [(1, [4.0])]))
    assert stored(spark, path) == [(1, [4.0]), (None, [1.0]), (None, [3.0])]
