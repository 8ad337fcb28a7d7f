import math

import pytest

from guichet.operators import evaluation as E, features as X

PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")] * 1 + [("b", "d")] * 1


def pairs(spark):
    return spark.createDataFrame(PAIRS, "y string, p string")


def test_scores_over_the_union_of_labels(spark):
    r = E.accuracy_f1(pairs(spark), "y", "p").first()
    f1 = {"a": 2 * 5 / (7 + 6), "b": 2 * 3 / (4 + 5), "c": 0.0, "d": 0.0}
    assert math.isclose(r.accuracy, 8 / 12) and math.isclose(r.f1_macro, sum(f1.values()) / 4) and r.n == 12
    s = {x.label: x for x in E.class_scores(pairs(spark), "y", "p").collect()}
    assert math.isclose(s["a"].precision, 5 / 6) and math.isclose(s["b"].recall, 3 / 4) and s["d"].support == 0 and s["c"].f1 == 0.0


def test_report_and_confusion(spark):
    r = {x.label: x for x in E.class_report(pairs(spark), "y", "p").collect()}
    assert math.isclose(r["macro avg"].recall, (5 / 7 + 3 / 4) / 4) and r["weighted avg"].support == 12
    assert math.isclose(r["weighted avg"].recall, 8 / 12)
    m = E.confusion_matrix(pairs(spark), "y", "p", ["b", "a", "zz"]).orderBy("pos").collect()
    assert [(x.label, x.b, x.a, x.zz) for x in m] == [("b", 3, 0, 0), ("a", 2, 5, 0), ("zz", 0, 0, 0)]


def test_regression(spark):
    df = spark.createDataFrame([("t", 1.0, 2.0), ("t", 3.0, 3.0), ("t", 5.0, 1.0), ("u", 2.0, 2.0), ("u", None, 1.0)], "g string, y double, p double")
    r = {x.g: x for x in E.regression_metrics(df, "y", "p", ["g"]).collect()}
    assert math.isclose(r["t"].mae, 5 / 3) and math.isclose(r["t"].rmse, math.sqrt(17 / 3)) and math.isclose(r["t"].r2, 1 - 17 / 8)
    assert r["u"].n == 1 and r["u"].r2 is None and math.isclose(r["t"].pred_std, math.sqrt(2 / 3))


def test_published_gap(spark):
    old = spark.createDataFrame([("train", 2.41, 0.985), ("validation", 7.50, 0.795), ("test", 7.48, 0.720)], "dataset string, mae double, r2 double")
    new = spark.createDataFrame([("train", 6.119, 0.8928), ("validation", 8.312, 0.8558), ("test", 8.736, 0.7722)], "dataset string, mae double, r2 double")
    g = E.overfit_gap(E.compare_runs(old, new)).first()
    assert math.isclose(g.r2_gap_old, 0.2650, abs_tol=1e-9) and math.isclose(g.r2_gap_new, 0.1206, abs_tol=1e-9)
    assert math.isclose(g.r2_gap_reduction_pct, 54.49, abs_tol=0.01) and g.reduced
    assert math.isclose(g.mae_gap_old, 5.07, abs_tol=1e-9) and math.isclose(g.mae_gap_new, 2.617, abs_tol=1e-9)


def test_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 4.9, 5.0, 10.0, 20.0, 99.0)], "abs_error double")
    assert [(x.bucket, x.n) for x in E.error_buckets(df).orderBy("pos").collect()] == [("<5h", 2), ("<10h", 3), ("<20h", 4), (">=20h", 2)]


def test_feature_helpers(spark):
    df = spark.createDataFrame([("a", 1.0, 7.0), ("a", 2.0, 7.0), ("b", 6.0, 7.0)], "c string, x double, k double")
    w = {r.c: r.weight for r in X.class_weights(df, "c").collect()}
    assert w == {"a": 0.75, "b": 1.5}
    s = X.standardize(df, ["x", "k"]).collect()
    sd = math.sqrt(14 / 3)
    assert [round(r.x_scaled, 9) for r in s] == [round((v - 3) / sd, 9) for v in (1, 2, 6)] and {r.k_scaled for r in s} == {0.0}
    stages, hot = X.fit_one_hot(df, ["c"])
    unseen = spark.createDataFrame([("b",), ("zz",), (None,)], "c string")
    for stage in stages:
        unseen = stage.transform(unseen)
    assert [r.d for r in X.to_dense(unseen, hot[0], "d", max_size=2).collect()] == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]
    with pytest.raises(Exception, match="over 1 stays sparse"):
        X.to_dense(unseen, hot[0], "d", max_size=1).collect()
