from collections import Counter

import brute
from pyspark.sql import functions as F

from penprint.operators import lexicon


def test_all_forms_agree(spark, corpus):
    terms = ["the", "again", "is", "17", "absent"]
    table = spark.createDataFrame([(t,) for t in terms + ["the", None]], "term string")
    texts = corpus.select("doc_id", "text").unionByName(
        spark.createDataFrame([(5000, ""), (5001, "none of them")], "doc_id long, text string")
    )
    want = {}
    for r in texts.collect():
        tokens = brute.words(r["text"].lower())
        want[r["doc_id"]] = (len(tokens), sum(t in terms for t in tokens))
    narrow = lexicon.lexicon_hits(texts, terms)
    assert {r["doc_id"]: (r["n_tokens"], r["hits"]) for r in narrow.collect()} == want
    for limit in (lexicon.BROADCAST_TERMS, 0):
        joined = lexicon.lexicon_hits_join(texts, table, broadcast_terms=limit)
        assert {r["doc_id"]: (r["n_tokens"], r["hits"]) for r in joined.collect()} == want


def test_hot_and_cold_terms(spark, corpus, monkeypatch):
    """With a high bar only some terms are hot: both ways are taken and add up."""
    monkeypatch.setattr(lexicon, "_HOT_SHARE", 0.1)
    table = spark.createDataFrame([("is",), ("again",), ("17",)], "term string")
    a = lexicon.lexicon_hits_join(corpus, table, broadcast_terms=0).collect()
    b = lexicon.lexicon_hits_join(corpus, table).collect()
    assert {tuple(r) for r in a} == {tuple(r) for r in b}


def test_counts(spark, corpus):
    tokens = Counter()
    for r in corpus.collect():
        tokens.update((r["doc_id"], t) for t in brute.words(r["text"].lower()))
    got = {(r["doc_id"], r["token"]): r["n"] for r in lexicon.token_counts(corpus).collect()}
    assert got == dict(tokens)
    total = lexicon.vocabulary(corpus).first()
    assert tuple(total) == (len({t for _, t in tokens}), sum(tokens.values()))
    row = lexicon.distinct_ratio(corpus.where("doc_id = 0")).first()
    assert (row["n_distinct"], row["n_tokens"]) == (9, 10)
    assert row["ratio"] == 0.9


def test_pairs(spark):
    rows = [(1, "It is used. It was seen; they are listed and are named"), (2, "is. edited"), (3, "is is ed ed"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["pairs"] for r in lexicon.adjacent_pairs(df).collect()}
    want = {i: sum(a in ("is", "are", "was") and b.endswith("ed") for a, b in zip(w, w[1:]))
            for i, w in ((i, brute.words(t.lower())) for i, t in rows)}
    assert got == want == {1: 3, 2: 0, 3: 1, 4: 0}
    odd = spark.createDataFrame([(1, "a+ bing a ring a+ ring")], "doc_id long, text string")
    assert lexicon.adjacent_pairs(odd, ["a+"], "ing").first()["pairs"] == 2


def test_bulky_lexicon_is_not_broadcast(spark, corpus, monkeypatch):
    monkeypatch.setattr(lexicon, "BROADCAST_BYTES", 3)
    table = spark.createDataFrame([("again",)], "term string")
    rows = lexicon.lexicon_hits_join(corpus, table).where("hits = 2").count()
    assert rows == 334


def test_empty_texts_take_no_part_in_the_join(spark, monkeypatch):
    rows = [(i, "" if i % 2 else f"word{i} known") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = spark.createDataFrame([("known",)], "term string")
    monkeypatch.setattr(lexicon, "BROADCAST_BYTES", 0)
    joined = lexicon.lexicon_hits_join(df, terms)
    assert {(r["doc_id"], r["n_tokens"], r["hits"]) for r in joined.collect()} == {(i, 0, 0) if i % 2 else (i, 2, 1) for i in range(400)}
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_filter_lets_every_term_pass_and_few_others(spark):
    terms = spark.range(3000).selectExpr("concat('term', id) as term")
    others = spark.range(20000).selectExpr("concat('other', id) as term")
    maybe = lexicon._term_filter(terms)
    assert lexicon._filtered(terms, maybe).where("not _maybe").count() == 0
    assert lexicon._filtered(others, maybe).where("_maybe").count() < 20
    nothing = lexicon._term_filter(terms.limit(0))
    assert lexicon._filtered(others, nothing).where("_maybe").count() == 0


def test_united_sketches(spark, corpus):
    texts = corpus.withColumn("part", F.col("doc_id") % 7)
    united = lexicon.united_vocabulary(lexicon.vocabulary_sketches(texts, "part", "label"), "label").collect()
    for r in united:
        exact = lexicon.vocabulary(texts.where(F.col("label") == r["label"])).first()
        assert r["n_tokens"] == exact["n_tokens"] and abs(r["n_distinct"] / exact["n_distinct"] - 1) < 0.02


def test_token_counts_are_made_in_tasks_of_few_texts(spark, monkeypatch):
    rows = [(i % 40, f"the word{i % 7} and the end") for i in range(200)] + [(None, "the null id"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = {}
    for i, text in rows:
        for t in (text or "").split():
            want[i, t] = want.get((i, t), 0) + 1
    monkeypatch.setattr(lexicon, "_TASK_BYTES", 100)
    counts = lexicon.token_counts(df)
    assert counts.rdd.getNumPartitions() > 40  # the texts' bytes decide, not one input task or the session's setting
    assert {(r["doc_id"], r["token"]): r["n"] for r in counts.collect()} == want
    terms = spark.createDataFrame([("the",), ("word3",)], "term string")
    hits = {r["doc_id"]: (r["n_tokens"], r["hits"]) for r in lexicon.lexicon_hits_join(df, terms, broadcast_terms=0).collect()}
    for i in {r[0] for r in rows}:
        own = {t: n for (d, t), n in want.items() if d == i}
        assert hits[i] == (sum(own.values()), own.get("the", 0) + own.get("word3", 0))
