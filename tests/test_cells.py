"""Approximate search over cells against the exact one."""

import numpy as np
import pytest

from guichet.operators import cells as C, search as R


def frame(spark, x, name="id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, embedding array<double>")


def clustered(seed, n, dim=12, groups=30):
    rng = np.random.default_rng(seed)
    return np.random.default_rng(0).normal(0, 5, (groups, dim))[rng.integers(0, groups, n)] + rng.normal(0, 1, (n, dim))


def rows(df):
    return sorted((r.query_id, r["rank"], r.id) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2sq"])
def test_all_probes_are_exact_and_tuned_probes_find_most(spark, metric, monkeypatch):
    docs, asked = frame(spark, clustered(1, 1_500)), frame(spark, clustered(2, 60), "query_id")
    monkeypatch.setattr(C, "PART_ROWS", 40)  # cells in parts, queries in blocks
    monkeypatch.setattr(C, "BLOCK_QUERIES", 25)
    index = C.build_cells(docs, metric, cell_rows=60)
    exact = R.dense_search(asked, docs, 5, metric)
    assert rows(C.cell_search(asked, index, 5, probes=10_000)) == rows(exact)
    tuned = C.tune_probes(index, 5)
    assert 1 <= tuned.probes < len(index.centres) / 2
    assert C.recall(C.cell_search(asked, tuned, 5), exact) >= 0.9
    assert index.rows.count() == 1_500 and index.rows.groupBy("cell", "part").count().agg({"count": "max"}).first()[0] < 120


def test_distances_to_centres_are_held_in_bounded_slices(spark, monkeypatch):
    monkeypatch.setattr(C, "DISTANCES", 200)
    x, centres = clustered(3, 90), clustered(4, 40)
    batch = frame(spark, x).toArrow().combine_chunks().to_batches()[0]
    held = list(C._from_centres(batch, "embedding", centres, (centres * centres).sum(1)))
    assert sum(some.num_rows for some, _ in held) == 90 and max(far.size for _, far in held) <= 200
    order = np.argsort(((x[:, None] - centres) ** 2).sum(2), axis=1, kind="stable")
    for n in (1, 7, 40):  # a row for each of the nearest cells, each with its vector
        got = C._nearest(frame(spark, x).withColumnRenamed("embedding", "v"), "id", centres, n).collect()
        assert {(r.id, r.cell) for r in got} == {(i, c) for i in range(90) for c in order[i, :n].tolist()} and len(got) == 90 * n
        assert all(r.v == x[r.id].tolist() for r in got)


def test_vectors_without_numbers_are_left_out(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, [1.0, 0.0]), (6, [0.0, None])], "id long, embedding array<double>")
    index = C.tune_probes(C.build_cells(docs), 2)
    asked = docs.withColumnRenamed("id", "query_id")
    got = {(r.query_id, r["rank"]): (r.id, r.similarity) for r in C.cell_search(asked, index, 3).collect()}
    assert got == {(1, 1): (1, 1.0), (1, 2): (5, 1.0), (1, 3): (4, 0.0), (5, 1): (1, 1.0), (5, 2): (5, 1.0), (5, 3): (4, 0.0), (4, 1): (1, 0.0), (4, 2): (4, 0.0), (4, 3): (5, 0.0)}
    assert C.build_cells(docs.filter("id = 2")) is None
    assert C.cell_search(asked.limit(0), index).count() == 0
    with pytest.raises(ValueError):
        C.cell_search(asked, None)
