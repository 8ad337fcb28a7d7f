import datetime as dt

import numpy as np
import pytest

from guichet.plans.stored import letter_shares
from guichet.sources import sketches, stores, tables

DAY = dt.datetime(2024, 5, 1)


@pytest.fixture(scope="module")
def visits(spark):
    rng = np.random.default_rng(4)
    rows = [(DAY + dt.timedelta(hours=int(rng.integers(0, 24 * 6))), "abc"[int(rng.integers(0, 3))], int(rng.integers(0, 900)), float(v)) for v in rng.gamma(2, 10, 9_000)]
    rows += [(DAY, "b", None, None), (None, None, 7, 1.0), (DAY, "empty", None, None)]
    return spark.createDataFrame(rows, "ts timestamp, kind string, who long, worth double")


def test_merged_days_are_near_the_exact_profile(spark, visits, tmp_path):
    path = str(tmp_path / "days")
    days = sketches.daily_sketches(visits, "ts", "kind", "who", "worth")
    sketches.store_days(days, path)
    sketches.store_days(days.filter("day = DATE '2024-05-03'"), path)
    got = {r.label: r for r in sketches.merged_profile(sketches.read_days(spark, path)).collect()}
    rows = visits.collect()
    assert set(got) == {r.kind for r in rows} and sum(r.pct for r in got.values()) == pytest.approx(100)
    for kind, r in got.items():
        mine = [x for x in rows if x.kind == kind]
        values = np.array([x.worth for x in mine if x.worth is not None])
        assert (r.n, r.n_values) == (len(mine), len(values))
        assert abs(r.n_keys - len({x.who for x in mine} - {None})) <= 0.065 * r.n_keys + 1e-9
        if not len(values):
            assert (r.total, r.least, r.most, r.q50) == (None,) * 4
            continue
        assert (r.total, r.least, r.most) == (pytest.approx(values.sum()), values.min(), values.max())
        for q in (25, 50, 75):
            assert abs((values < r[f"q{q}"]).mean() - q / 100) <= 0.01 or len(values) < 100


def test_a_range_of_days_reads_only_its_files(spark, visits, tmp_path):
    path = str(tmp_path / "days")
    sketches.store_days(sketches.daily_sketches(visits, "ts", "kind", "who", "worth"), path)
    some = sketches.read_days(spark, path, "2024-05-02", "2024-05-03")
    assert {str(r.day) for r in some.select("day").distinct().collect()} == {"2024-05-02", "2024-05-03"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert sketches.merged_profile(some).agg({"n": "sum"}).first()[0] == visits.filter("to_date(ts) BETWEEN '2024-05-02' AND '2024-05-03'").count()
    nothing = sketches.daily_sketches(visits.limit(0), "ts", "kind", "who", "worth")
    assert sketches.merged_profile(nothing).count() == 0


def test_only_the_given_splits_are_replaced(spark, tmp_path):
    path = str(tmp_path / "stage")
    rows = spark.createDataFrame([("1", "train", "Haute"), ("2", "test", "Basse"), ("3", "validation", "Basse")], "ID string, split string, urgence_pred string")
    tables.write_table(rows, path, split="split")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "stage").glob("split=t*/*.parquet")}
    tables.replace_splits(spark.createDataFrame([("4", "validation", "Haute")], rows.schema), path)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "stage").glob("split=t*/*.parquet")} == before
    assert {(r.ID, r.split) for r in tables.read_stage(spark, path, "urgence").collect()} == {("1", "train"), ("2", "test"), ("4", "validation")}
    part = tables.read_stage(spark, path, "urgence", ["validation"])
    assert [r.ID for r in part.collect()] == ["4"] and "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().executedPlan().toString()


def test_embedder_runs_in_batches(spark, corpus):
    got = {r.id: r.embedding for r in stores.embed(corpus, letter_shares, batch_size=2).collect()}
    texts = {r.id: r.text for r in corpus.collect()}
    assert set(got) == set(texts)
    for name, text in texts.items():
        assert got[name] == pytest.approx([text.lower().count(chr(c)) / len(text) for c in range(97, 123)], abs=1e-6)
