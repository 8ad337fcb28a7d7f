import collections
import random

import pytest
from pyspark.sql import Window, functions as F

from guichet.operators import ranks, sampling as S
from guichet.operators import quality as Q
from guichet.operators.ranks import bucketed_rank


def tickets(spark, sizes):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "ID string, urgence string").repartition(5)


SOURCE = {"Basse": 726, "Moyenne": 34, "Haute": 6}
BALANCED = {"Basse": 726, "Moyenne": 406, "Haute": 319}


def test_targets_of_the_published_class_counts(spark):
    assert S.target_counts(S.oversample_targets(tickets(spark, SOURCE))) == BALANCED
    already = {"Basse": 10, "Moyenne": 9, "Haute": 8}
    assert S.target_counts(S.oversample_targets(tickets(spark, already))) == already


def test_oversample_hits_targets_with_unique_ids(spark):
    out = S.oversample(tickets(spark, SOURCE), "urgence", BALANCED, origin_col="origin").collect()
    assert collections.Counter(r.urgence for r in out) == BALANCED
    assert len({r.ID for r in out}) == len(out)
    copies = collections.defaultdict(list)
    for r in out:
        assert r.ID == r.origin or r.ID.startswith(r.origin + "_dup_")
        if r.ID != r.origin:
            copies[r.origin].append(int(r.ID.rsplit("_", 1)[1]))
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in copies.values())
    again = S.oversample(tickets(spark, SOURCE).repartition(2), "urgence", BALANCED).collect()
    assert {r.ID for r in again} == {r.ID for r in out}


def test_one_row_copied_many_times(spark):
    target = 3 * S.COPIES_PER_TASK_ROW + 7
    out = S.oversample(tickets(spark, {"Basse": 3, "Haute": 1}), "urgence", {"Haute": target})
    r = out.filter("urgence = 'Haute'").agg(F.count("*").alias("n"), F.count_distinct("ID").alias("u")).first()
    assert (r.n, r.u) == (target, target)
    assert out.filter("urgence = 'Basse'").count() == 3


def test_split_sizes(spark):
    df = S.stratified_split(tickets(spark, BALANCED))
    assert {r.split: r["count"] for r in df.groupBy("split").count().collect()} == {"train": 1015, "validation": 218, "test": 218}
    share = {(r.urgence, r.split): r["count"] for r in df.groupBy("urgence", "split").count().collect()}
    for c, n in BALANCED.items():
        assert abs(share[c, "train"] - 0.7 * n) <= 1 and abs(share[c, "test"] - share[c, "validation"]) <= 1
    assert df.select("ID").distinct().count() == sum(BALANCED.values())
    other = {r.ID: r.split for r in S.stratified_split(tickets(spark, BALANCED), seed=7).collect()}
    assert any(other[r.ID] != r.split for r in df.collect())


def test_tiny_classes_still_get_exact_quotas(spark):
    for sizes in ({"a": 1, "b": 1}, {"a": 1, "b": 20, "c": 3}, {"a": 10}):
        rows = S.stratified_split(tickets(spark, sizes)).collect()
        got = collections.Counter((r.urgence, r.split) for r in rows)
        table = spark.createDataFrame(list(sizes.items()), "__class string, n long")
        want = {(r["__class"], s): n for r in S.split_quotas(table).collect() for s, n in zip(("train", "validation", "test"), r.quota) if n}
        assert got == want


def test_grouped_split_keeps_copies_together(spark):
    b = S.oversample(tickets(spark, SOURCE), "urgence", BALANCED, origin_col="origin")
    df = S.stratified_split(b, group_col="origin")
    assert df.groupBy("origin").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert df.count() == sum(BALANCED.values())
    mixed = spark.createDataFrame([("1", "a", "g"), ("2", "b", "g")], "ID string, urgence string, origin string")
    with pytest.raises(ValueError, match="more than one"):
        S.stratified_split(mixed, group_col="origin")


def test_folds(spark):
    df = S.stratified_folds(tickets(spark, BALANCED), "urgence")
    per = collections.Counter((r.urgence, r.fold) for r in df.collect())
    for c, n in BALANCED.items():
        counts = [per[c, i] for i in range(5)]
        assert sum(counts) == n and max(counts) - min(counts) <= 1
    totals = [sum(per[c, i] for c in BALANCED) for i in range(5)]
    assert max(totals) - min(totals) <= 1
    small = S.stratified_folds(tickets(spark, {"a": 2, "b": 9}), "urgence").collect()
    assert collections.Counter(r.urgence for r in small) == {"a": 2, "b": 9}
    with pytest.raises(ValueError):
        S.stratified_folds(tickets(spark, {"a": 2}), "urgence")


def test_bucketed_rank_equals_row_number(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.md5(F.col("id").cast("string")).alias("d"))
    got = bucketed_rank(df, ["k"], ["d"], F.substring("d", 1, 2))
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy("d")))
    assert got.select("k", "d", F.col("rank").cast("int")).exceptAll(want).count() == 0 and got.count() == 5000


def test_ranking_is_dealt_to_bounded_tasks_and_null_keys_are_keys(spark, monkeypatch):
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    given = [(None if i % 50 == 0 else i // 3, i) for i in range(6_000)]
    got = ranks.sorted_rank(spark.createDataFrame(given, "k int, d int"), ["k"], ["d"]).withColumn("task", F.spark_partition_id())
    places = {}
    for k, d in sorted(given, key=lambda r: r[1]):
        places.setdefault(k, []).append(d)
    rows = got.collect()
    assert {(r.k, r.d, r["rank"]) for r in rows} == {(k, d, n) for k, held in places.items() for n, d in enumerate(held, 1)} and len(rows) == 6_000
    sizes = collections.Counter(r.task for r in rows if r.k is not None)
    assert len(sizes) > 30 and max(sizes.values()) < 400


def test_unique_ids_with_one_hot_id(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("name"), F.col("id").alias("row"))
    out = {r.row: r.unique for r in S.unique_ids(df, "name", ["row"], out="unique").collect()}
    assert len(set(out.values())) == 3000
    assert out[0] == "hot" and out[3] == "hot_dup_1" and out[2997] == "hot_dup_999" and out[1] == "x1"


def test_unique_ids_with_ties_only(spark):
    df = spark.range(1000).select(F.lit("same").alias("name"), F.lit(1).alias("row"))
    got = {r.name for r in S.unique_ids(df, "name", ["row"]).collect()}
    assert got == {"same"} | {f"same_dup_{i}" for i in range(1, 1000)}


def test_many_targets_stay_a_table(spark):
    targets = spark.range(50).selectExpr("CAST(id AS string) AS urgence", "id AS target")
    with pytest.raises(ValueError, match="distinct"):
        S.target_counts(targets, most=10)


def test_oversample_with_repeated_ids(spark):
    rows = [("a", "x", i) for i in range(5)] + [("b", "x", 9), ("c", "y", 1), ("c", "y", 1), (None, "x", 3), ("d", None, 4)]
    df = spark.createDataFrame(rows, "ID string, urgence string, v int")
    out = S.oversample(df, "urgence", {"x": 20, "y": 6}, origin_col="origin").collect()
    assert collections.Counter(r.urgence for r in out) == {"x": 20, "y": 6, None: 1}
    named = [r.ID for r in out if r.origin is not None]
    assert len(set(named)) == len(named)
    for origin in "abc":
        n = sum(r.origin == origin for r in out)
        assert {r.ID for r in out if r.origin == origin} == {origin} | {f"{origin}_dup_{i}" for i in range(1, n)}
    assert {(r.origin, r.v) for r in out} == {(i, v) for i, _, v in rows}


def test_thousands_of_classes(spark):
    df = spark.range(10_000).selectExpr("CAST(id AS string) AS ID", "CAST(id % 5000 AS string) AS urgence")
    targets = spark.range(5000).selectExpr("CAST(id AS string) AS urgence", "2 + id % 3 AS target")
    out = S.oversample(df, "urgence", targets)
    wrong = out.groupBy("urgence").count().join(targets, "urgence").filter("count <> target").count()
    assert wrong == 0 and out.count() == sum(2 + i % 3 for i in range(5000))
    parts = S.stratified_split(df)
    assert {r.split: r["count"] for r in parts.groupBy("split").count().collect()} == {"train": 7000, "validation": 1500, "test": 1500}


def test_rows_without_a_class_are_split_too(spark):
    rows = [(str(i), "a" if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "ID string, urgence string")
    parts = S.stratified_split(df)
    assert collections.Counter((r.urgence, r.split) for r in parts.collect()) == {
        ("a", "train"): 56, ("a", "validation"): 12, ("a", "test"): 12, (None, "train"): 14, (None, "validation"): 3, (None, "test"): 3}
    folds = collections.Counter((r.urgence, r.fold) for r in S.stratified_folds(df, "urgence").collect())
    assert folds == {("a", i): 16 for i in range(5)} | {(None, i): 4 for i in range(5)}
    assert {r.lost for r in Q.reconcile_split(df, parts).collect()} == {0}
    assert {r.lost for r in Q.reconcile_split(df, parts.filter("urgence IS NOT NULL")).collect()} == {20}
