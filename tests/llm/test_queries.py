"""Registered queries against SQL or brute force, and the pipeline."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from penprint.llm import queries
from tests.llm.test_classifiers import auc
from tests.llm.test_repeats import brute_removed
from tools.check_queries import canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


def table(name):
    return duckdb.sql(f"SELECT * FROM '{FOLDER}/{name}.parquet'").df()


@pytest.mark.parametrize("entry", [e for e in queries.ENTRIES if e.sql], ids=lambda e: e.name)
def test_sql(spark, entry):
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = entry.run(spark, FOLDER)
    cursor = con.execute(entry.sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())


def test_op1(spark):
    got = {r.doc_id: r for r in queries.op1_toxicity(spark, FOLDER).collect()}
    docs, labels = table("documents"), table("labels")
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    # Few labels at this size; in English texts they show as words.
    english = labels.merge(docs[docs.lang == "en"], on="doc_id")
    assert auc([got[i].score for i in english.doc_id], english.toxic) > 0.75


def test_op2(spark):
    docs = table("documents")
    rows = [(int(i), (t or "").encode()) for i, t in zip(docs.doc_id, docs.text)]
    got = queries.op2_suffix_levels(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_removed(rows))


def test_op3(spark):
    docs = table("documents").sort_values("doc_id")
    start = 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_files(spark, FOLDER).collect()}
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, e in zip(docs.doc_id, encoder.encode_batch(docs.text.tolist(), add_special_tokens=False)):
        ids = np.array([*e.ids, 1], "<u4")
        assert got[i] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op5(spark):
    got = {r.doc_id: r for r in queries.op5_weighted_minhash(spark, FOLDER).collect()}
    docs = table("documents")
    bags = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in zip(docs.doc_id, docs.text.str.lower().str.split())}
    for i in bags:
        for j in bags:
            if j < i and bags[i] and bags[j]:
                shared = len(bags[i] & bags[j])
                alike = shared / (len(bags[i]) + len(bags[j]) - shared)
                if alike >= 0.84:
                    assert got[i].class_id == got[j].class_id
                if alike < 0.7:
                    assert got[i].class_id != got[j].class_id or got[i].class_size > 2
    assert sum(r.kept for r in got.values()) == len({r.class_id for r in got.values()})


def test_op10(spark):
    got = {r.doc_id: r for r in queries.op10_weak_labels(spark, FOLDER).collect()}
    labels = table("labels")
    labels = labels[labels.doc_id.isin(got)]
    assert auc([got[i].score for i in labels.doc_id], labels.quality) > 0.9


def test_pipeline(spark, empty):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        assert docs.select("doc_id").distinct().exceptAll(before.select("doc_id").distinct()).isEmpty()
    final = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, final.collect())) and whole.count() == docs.count()
    rows = empty
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER)
    assert rows.count() == 0


def test_pipeline_stages_bear_hard_rows(spark, hard):
    docs = hard
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "stage")
        assert docs.columns == hard.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count() > 0
