import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from penprint.llm import toxicity as t
from penprint.llm import weak_labels as q
from tests.llm.conftest import prose

BAD = ["zorgle", "quampish", "vexnard", "brattle", "skunkwit"]


def labelled(rng, n):
    rows = []
    for i in range(n):
        words = prose(rng, 60).split(" ")
        toxic = int(i % 4 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    return rows


def auc(scores, labels):
    s, y = np.array(scores), np.array(labels)
    pairs = s[y == 1][:, None] - s[y == 0][None, :]
    return ((pairs > 0) + 0.5 * (pairs == 0)).mean()


def test_toxic_words_are_learned(spark):
    rows = labelled(random.Random(4), 400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = t.fit(docs, labels.filter(~t.held_out()))
    got = {r.doc_id: r for r in t.score_documents(docs, model).withColumn("held", t.held_out()).collect()}
    held = [r for r in rows if got[r[0]].held]
    assert len(held) > 40 and auc([got[r[0]].score for r in held], [r[2] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert t.fit(docs.repartition(7), labels.filter(~t.held_out())) == model


def test_copies_do_not_make_words_toxic():
    rng = random.Random(9)
    once = prose(rng, 80)
    assert not set(t.toxic_words([once] * 50, [prose(rng, 80) for _ in range(100)])) - set()


def test_toxicity_of_hard_texts(spark, hard, empty):
    rows = labelled(random.Random(4), 200)
    model = t.train_on([r[1] for r in rows if r[2]], [r[1] for r in rows if not r[2]])
    got = t.score_documents(hard.repartition(2), model).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 for r in got)
    assert t.score_documents(empty, model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert t.score_documents(hard, t.fit(hard, labels)).select("score").distinct().collect() == [(0.5,)]
    one_class = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None)], "doc_id long, toxic int")
    assert t.score_documents(hard, t.fit(hard, one_class)).filter("score <= 0.5").isEmpty()


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.7
    right = [0.95, 0.9, 0.85, 0.8]
    votes = np.stack([np.where(rng.random(20_000) < 0.1, 2, np.where(rng.random(20_000) < a, truth, ~truth)) for a in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = q.fit_label_model(patterns, counts)
    chance = np.exp(model.log_chance)
    for j, a in enumerate(right):
        assert abs(chance[1][j][1] - 0.9 * a) < 0.05 and abs(chance[0][j][0] - 0.9 * a) < 0.05
    assert ((model.posterior(votes) >= 0.5) == truth).mean() > 0.95


def test_quality_scores(spark, hard, empty):
    rng = random.Random(8)
    good = [" ".join(f"the {w} of" if k % 4 == 0 else w for k, w in enumerate(prose(rng, 90).split(" "))) for _ in range(150)]
    bad = ["%%% ".join(prose(rng, 60).split(" ")) for _ in range(20)] + ["!! ".join(prose(rng, 8).split(" ")) * 9 for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(good + bad)), "doc_id long, text string")
    got = {r.doc_id: r for r in q.score_quality(docs).collect()}
    assert auc([got[i].score for i in range(190)], [1] * 150 + [0] * 40) > 0.97
    assert np.mean([got[i].kept for i in range(150)]) > 0.95
    rows = q.score_quality(hard).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert q.score_quality(empty).count() == 0
    same = q.score_quality(hard).filter(F.col("doc_id") == 20).select("score").distinct().count()
    assert same == 1


def test_a_row_has_one_score_in_batches_of_any_size():
    rng = random.Random(9)
    texts = [prose(rng, 40) for _ in range(40)]
    weights = np.random.default_rng(2).standard_normal(q.FEATURES + 1).astype(np.float32)
    steps = np.zeros((40, len(q.LABELLERS)), np.int64)
    seen = set()
    for size in range(1, 41):
        x = q.hashed_features(pa.array(texts[40 - size :]), steps[:size])
        seen.add(q.linear_scores(x, weights)[-1])
    assert len(seen) == 1


def test_held_out_is_never_null(spark):
    rows = spark.createDataFrame([(None,), (0,), (1,)], "doc_id long").select(t.held_out().alias("h")).collect()
    assert [r.h for r in rows] == [False, *(zlib.crc32(str(i).encode()) % 5 == 0 for i in (0, 1))]
