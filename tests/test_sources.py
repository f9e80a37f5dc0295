import json

import pytest
from pyspark.sql import functions as F

from penprint import session
from penprint.sources import readers, writers

AWKWARD = ['line one\nline two, "quoted"', "plain", "tab\tand 'single'", 'ends with backslash \\', '""', "é, ü"]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(AWKWARD)], "text string, label int")
    writers.write_corpus(df, f"{tmp_path}/c", "csv")
    back = readers.read_labeled_csv(spark, f"{tmp_path}/c")
    assert {(r["text"], int(r["label"])) for r in back.collect()} == {tuple(r) for r in df.collect()}
    assert dict(back.dtypes)["label"] == "double"


def test_csv_layouts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,generated\n1,"a\nb",1.0\n2,c,0\n')
    got = readers.read_labeled_csv(spark, f"{tmp_path}/a.csv", readers.LAYOUT_A_SCHEMA, ("text", "generated"))
    assert [tuple(r) for r in got.collect()] == [("a\nb", 1.0), ("c", 0.0)]
    with pytest.raises(ValueError, match="label"):
        readers.read_labeled_csv(spark, f"{tmp_path}/a.csv")


def test_json_collections(spark, tmp_path):
    (tmp_path / "posts.json").write_text(json.dumps([{"text": "a", "x": 1}, {"y": 2}, "loose", {"text": "b\nc"}]))
    (tmp_path / "made.json").write_text(json.dumps([{"text": "d"}]))
    df = readers.read_source_collections(spark, [f"{tmp_path}/posts.json"], [f"{tmp_path}/made.json"])
    assert {tuple(r) for r in df.collect()} == {("a", 0, "posts"), ("b\nc", 0, "posts"), ("d", 1, "made")}
    with pytest.raises(ValueError):
        readers.read_source_collections(spark, [], [])


def test_lines(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("  one \n\n\t\ntwo\n")
    assert [r[0] for r in readers.read_text_lines(spark, f"{tmp_path}/lines.txt").collect()] == ["one", "two"]


def test_metrics_and_log(spark, tmp_path):
    df = spark.createDataFrame([(0.5, (1, 2))], "roc_auc double, nested struct<a:int,b:int>")
    writers.write_metrics(df, f"{tmp_path}/m")
    assert spark.read.json(f"{tmp_path}/m").first()["nested"]["b"] == 2
    for run in ("one", "two"):
        writers.append_run_log(df.select("roc_auc"), f"{tmp_path}/log", run, dataset_size=10, seed=42)
    log = spark.read.json(f"{tmp_path}/log")
    assert {r["run_id"] for r in log.collect()} == {"one", "two"}
    assert log.where("dataset_size = 10 and seed = 42 and logged_at is not null").count() == 2
    fact = writers.run_metadata(spark, dataset_size=3, model_type="m").first()
    assert fact["dataset_size"] == 3 and fact["training_date"]


def test_parquet_round_trip(spark, tmp_path, corpus):
    writers.write_corpus(corpus, f"{tmp_path}/p")
    assert readers.read_corpus(spark, f"{tmp_path}/p").exceptAll(corpus).count() == 0


def test_small_inputs_are_spread_and_large_ones_left(spark, tmp_path, corpus):
    corpus.coalesce(1).write.parquet(f"{tmp_path}/s")
    df = spark.read.parquet(f"{tmp_path}/s")
    assert session.spread(df, "doc_id", 12).rdd.getNumPartitions() == 12
    assert session.spread(df, "doc_id", 1) is df


def test_columns_in_another_order(spark, tmp_path):
    for name, text in (("a", "text,label\nx,1\nx,1\n"), ("b", 'label,text\n0,"y, z"\n'), ("c", "text,label\nw,\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    rows = readers.read_labeled_csv(spark, f"{tmp_path}", id_col="doc_id")
    assert sorted((r["text"], r["label"]) for r in rows.collect()) == sorted([("x", 1.0), ("x", 1.0), ("y, z", 0.0), ("w", None)], key=str) or {
        (r["text"], r["label"]) for r in rows.collect()
    } == {("x", 1.0), ("y, z", 0.0), ("w", None)}
    assert rows.count() == rows.select("doc_id").distinct().count() == 4
    assert {r[0] for r in rows.select("doc_id").collect()} == {r[0] for r in rows.select("doc_id").collect()}


def test_bad_files_fail_loudly(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("text,label\nx,one\n")
    with pytest.raises(Exception, match="(?i)malformed|one"):
        readers.read_labeled_csv(spark, f"{tmp_path}/bad.csv").collect()
    (tmp_path / "cut.json").write_text('[{"text": "a"}, {"te')
    with pytest.raises(Exception, match="no JSON array"):
        readers.read_source_collections(spark, [f"{tmp_path}/cut.json"], []).collect()
    (tmp_path / "mark.json").write_text('\ufeff[{"text": "a"}]')
    rows = readers.read_source_collections(spark, [f"{tmp_path}/mark.json"], [], id_col="doc_id")
    assert [r["text"] for r in rows.collect()] == ["a"] and rows.first()["doc_id"].endswith("mark.json:0")


def test_scratch_is_cleared(spark, corpus):
    cut = session.cut_lineage(corpus)
    assert cut.count() == corpus.count()
    path = session.scratch_path(spark, "x")
    corpus.write.parquet(path)
    session.remove_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_lineage_cut(spark, corpus):
    cut = session.cut_lineage(corpus.where(F.col("label") == 1))
    assert cut.count() == 200
    assert "Repartition" not in cut._jdf.queryExecution().optimizedPlan().toString()
