import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from guichet import session
from guichet.sources import models_dir, runlog, tables
from guichet.streaming import monitor


def test_ticket_csv_keeps_quotes_breaks_and_blanks(spark, tmp_path):
    rows = [("1", 'il a dit "non",\npuis; rien', " titre ", "C", "Haute", 1.5, "Demande", 3, "t"), ("2", "x", "CrÃ©ation compte AD", "C", "Basse", None, None, 0, "u")]
    df = spark.createDataFrame(rows, tables.BALANCED_SCHEMA)
    paths = {s: str(tmp_path / s) for s in ("train", "validation", "test")}
    for p in paths.values():
        tables.write_csv(df, p)
        tables.write_csv(df, p)
    back = tables.read_split_csvs(spark, paths)
    assert back.count() == 6
    assert {tuple(r) for r in back.filter("split = 'test'").drop("split").collect()} == set(rows)
    with pytest.raises(Exception):
        tables.read_tickets_csv(spark, paths["train"], "a string, b string").collect()


def test_stage_tables(spark, tmp_path):
    path = str(tmp_path / "stage")
    with pytest.raises(FileNotFoundError, match="urgence"):
        tables.read_stage(spark, path, "urgence")
    df = spark.createDataFrame([("1", "train", "Haute"), ("2", "test", "Basse")], "ID string, split string, urgence_pred string")
    tables.write_table(df, path, split="split")
    tables.write_table(df, path, split="split")
    assert tables.read_stage(spark, path, "urgence").count() == 2
    plan = tables.read_stage(spark, path, "urgence").filter("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ValueError, match="categorie_pred"):
        tables.read_stage(spark, path, "categorie")


def test_documents_json(spark, corpus, tmp_path):
    path = str(tmp_path / "docs")
    tables.write_documents(corpus, path)
    key = lambda df: sorted((r.id, r.text, sorted(r.metadata.items())) for r in df.collect())
    assert key(tables.read_documents(spark, path)) == key(corpus)
    one = tmp_path / "array.json"
    one.write_text(json.dumps([{"id": "a", "text": "b", "metadata": {"k": "v"}}, {"id": "c", "text": "d", "metadata": {}}], indent=2))
    assert [r.id for r in tables.read_documents(spark, str(one), array_file=True).collect()] == ["a", "c"]


def test_run_log_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "runs")
    runlog.append_metadata(spark, path, {"urgency": {"acc": 0.1}, "time": {"mae": 1}})
    runlog.append_metadata(spark, path, {"urgency": {"acc": 0.9}})
    got = {r.model: json.loads(r.payload) for r in runlog.read_metadata(spark, path).collect()}
    assert got == {"urgency": {"acc": 0.9}, "time": {"mae": 1}}


def test_monitor_drops_late_rows_and_matches_batch(spark, tmp_path):
    base = dt.datetime(2024, 1, 1, 0, 0)
    at = lambda m: base + dt.timedelta(minutes=m)
    schema = "ts timestamp_ntz, urgence string"
    first = [(at(5), "Basse"), (at(20), "Haute"), (at(50), "Basse"), (at(200), "Basse")]
    late = [(at(10), "Basse"), (at(195), "Haute"), (at(400), "Haute")]
    source = str(tmp_path / "in")
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        counts = monitor.class_distribution_stream(stream, "ts", "urgence")
        monitor.write_closed_windows(counts, str(tmp_path / "out"), str(tmp_path / "state"), once=True).awaitTermination()

    run()
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(source)
    run()
    out = spark.read.parquet(str(tmp_path / "out"))
    got = {(r.window_start.hour, r.urgence): r.n for r in out.collect()}
    assert got == {(0, "Basse"): 2, (0, "Haute"): 1, (3, "Basse"): 1, (3, "Haute"): 1}
    share = {(r.window_start.hour, r.urgence): round(r.pct, 2) for r in monitor.with_window_share(out).collect()}
    assert share[0, "Basse"] == 66.67 and share[3, "Haute"] == 50.0


def test_settled_tables_are_deleted_when_asked(spark, tmp_path):
    assert session.shared_dir(spark)
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")
    before = session.written(spark)
    kept = session.settle(spark.range(100).withColumn("y", F.col("id") * 2))
    assert kept.count() == 100
    path = (session.written(spark) - before).pop()
    session.forget(spark, {path})
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert session.written(spark) == before


@pytest.mark.parametrize("line", ["1,only,three", "2,a,b,c,Haute,douze,Demande,3,t", "3,a,b,c,Haute,1.5,Demande,3,t,one more"])
def test_malformed_csv_rows_fail_or_are_routed(spark, tmp_path, line):
    path = str(tmp_path / "bad.csv")
    names = [f.split()[0] for f in tables.BALANCED_SCHEMA.split(", ")]
    good = "9,x,y,z,Basse,2.0,Demande,1,u"
    (tmp_path / "bad.csv").write_text(",".join(names) + "\n" + good + "\n" + line + "\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        tables.read_tickets_csv(spark, path, tables.BALANCED_SCHEMA).collect()
    for multi_line in (True, False):
        rows = tables.read_tickets_csv(spark, path, tables.BALANCED_SCHEMA, multi_line=multi_line, malformed="bad").collect()
        assert [r.bad for r in rows] == [None, line]


def test_only_a_missing_path_means_no_model(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="urgency"):
        models_dir.check_model_exists(spark, "urgency", str(tmp_path))
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        models_dir.check_model_exists(spark, "urgency", "nosuchscheme://place")
