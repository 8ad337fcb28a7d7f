import math
import statistics

import pytest
from pyspark.sql import functions as F

from guichet.operators import prepare as P, profile as D, quality as Q
from guichet.schema import TICKET_COLUMNS


def test_columns_checked_and_reordered(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, a int, c int")
    with pytest.raises(ValueError, match="missing"):
        Q.check_columns(df, ["a", "zz"])
    with pytest.warns(UserWarning):
        assert Q.check_columns(df, ["a", "b"]).columns == ["a", "b"]
    assert len(TICKET_COLUMNS) == 8


def test_unique_and_domain_checks(spark):
    df = spark.createDataFrame([("1", "Basse"), ("1", "Haute"), ("2", "Autre"), ("3", None)], "ID string, urgence string")
    with pytest.raises(ValueError, match="not unique"):
        Q.check_unique(df)
    with pytest.raises(ValueError, match="Autre"):
        Q.check_domain(df)
    assert {(r.urgence, r.n) for r in Q.domain_violations(df).collect()} == {("Autre", 1), (None, 1)}
    Q.check_unique(df.filter("ID <> '1'"))
    Q.check_domain(df.filter("ID = '1'"))


def test_input_status(spark):
    df = spark.createDataFrame([(None, None), (" ", " "), ("mot", ""), ("deux", "mots")], "titre string, texte string")
    assert [r.status for r in Q.input_status(df).collect()] == ["empty", "empty", "too_short", "ok"]


def test_normalisation(spark):
    df = spark.createDataFrame([("Très haute",), ("Haute",), (None,)], "urgence string")
    assert sorted(str(r.urgence) for r in P.normalize_values(df).collect()) == ["Haute", "Haute", "None"]
    assert P.normalization_count(df).first().n_replaced == 1


def test_chunks(spark):
    df = spark.createDataFrame([("7", "T", "C", "Haute", None, 2.5, "corps")],
                               "ID string, titre string, categorie string, urgence string, type_ticket string, temps_resolution double, text_full string")
    r = P.build_chunks(df, 100).first()
    assert r.chunk == "Ticket ID: 7\nTitre: T\nCatégorie: C\nUrgence: Haute\nType: \nTemps de résolution: 2.5 heures\n\nTexte: corps"
    assert r.metadata.asDict() == {"id": "7", "categorie": "C", "urgence": "Haute", "type_ticket": None}
    many = df.unionByName(df.withColumn("ID", F.lit("2"))).unionByName(df.withColumn("ID", F.lit("1")))
    assert [r.id for r in P.build_chunks(many, 2).collect()] == ["1", "2"]


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0, -1.0, 2.0], [0.0, 0.0, -4.0, 9.0], [1.5] * 50 + [2.5] * 50, [float(i * i % 97) - 40 for i in range(501)],
                                    [1e-9, -1e300, 1e300, 0.0, 2.0, 2.0]])
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    r = D.numeric_profile(df, "v").first()
    assert r.median == statistics.median(values) and r.n == len(values)
    if len(values) > 1 and max(map(abs, values)) < 1e6:
        assert math.isclose(r.std, statistics.stdev(values), abs_tol=1e-9)


def test_value_counts(spark):
    df = spark.createDataFrame([(v,) for v in ["b"] * 3 + ["a"] * 3 + ["c"] * 2 + [None]], "v string")
    assert [(r.v, r.n, r.pct) for r in D.value_counts(df, "v").collect()] == [("a", 3, 37.5), ("b", 3, 37.5), ("c", 2, 25.0)]
    assert [r.v for r in D.top_values(df, "v", 2).collect()] == ["a", "b"]
    ordered = D.value_counts_in_order(df, "v", ["c", "zz", "a"]).collect()
    assert [(r.v, r["rank"], len(r.bar)) for r in ordered] == [("c", 1, 12), ("a", 3, 18)]
    assert D.distinct_counts(df, ["v"]).first().n_distinct == 3
    approx = D.distinct_counts(df, ["v"], approximate=True).first().n_distinct
    assert approx == 3
