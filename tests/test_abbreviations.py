"""Abbreviations and starters against plain Python counts, and what they spare."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from penprint.functions import tokens as tk
from penprint.functions.features import add_features
from penprint.operators import abbreviations as ab

NAMES = ["abel", "smith", "rosa", "king", "lund"]
VERBS = ["met", "saw", "paid", "left", "called"]
THINGS = ["the staff", "a friend", "two doctors", "the firm", "some people"]


def text_of(rng, n):
    """(text, true sentences)."""
    out = []
    for _ in range(n):
        kind = rng.randrange(4)
        if kind == 0:
            out.append(f"Dr. {rng.choice(NAMES)} {rng.choice(VERBS)} {rng.choice(THINGS)}.")
        elif kind == 1:
            out.append(f"They {rng.choice(VERBS)} {rng.choice(THINGS)}, e.g. {rng.choice(THINGS)} of Acme Inc. in town!")
        elif kind == 2:
            out.append(f"The {rng.choice(NAMES)} case was closed by {rng.choice(THINGS)}.")
        else:
            out.append(f'The office said "no" to Mr. {rng.choice(NAMES)} at 5 p.m. and {rng.choice(VERBS)}.')
    return " ".join(out), len(out)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    rows = [(i, *text_of(rng, rng.randint(3, 30))) for i in range(200)]
    rows += [(900, "", 0), (901, None, 0), (902, "one... two. 3. 4. (x.) 'y.'", 5), (903, "Inc. The end.", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(4)


def parsed(text):
    words = [w for w in re.split("[ \t\n\r\f\x0b]+", (text or "").lower()) if w]
    words = [re.sub(r"""^["'(\[{<]+""", "", w) for w in words]
    bare = [re.sub(r"""["')\]}>,;:!?]+$""", "", w) for w in words]
    types = [re.sub(r"\.+$", "", b) for b in bare]
    return [
        (t, bool(re.search(r"[^.]\.$", b)), bool(re.search(r"""[.!?]["')\]]*$""", w)), types[i + 1] if i + 1 < len(types) else None)
        for i, (t, b, w) in enumerate(zip(types, bare, words))
    ]


def loglik(k, n, p):
    return (k * math.log(max(p, 1e-300)) if k > 0 else 0) + ((n - k) * math.log(max(1 - p, 1e-300)) if n > k else 0)


def plain(texts):
    tokens = [x for t in texts for x in parsed(t)]
    is_type = re.compile(r"[^\W\d_]")
    n, c = Counter(), Counter()
    for t, period, _, _ in tokens:
        key = t if is_type.search(t) else ""
        n[key] += 1
        c[key] += period
    p = sum(c.values()) / sum(n.values())
    short = {}
    for t in n:
        if t and c[t]:
            letters = len(t.replace(".", ""))
            ll = -2 * (loglik(c[t], n[t], p) - loglik(c[t], n[t], 0.99))
            score = ll * math.exp(-letters) * (t.count(".") + 1) * letters ** -(n[t] - c[t])
            if score >= 0.3:
                short[t] = (n[t], c[t], score)
    after = Counter(f for t, period, ends, f in tokens if ends and f is not None and not (period and t in short))
    a, total = max(sum(after.values()), 1), sum(n.values())
    starts = {}
    for t, m in after.items():
        if t in n and t:
            rest = max(total - a, 1)
            score = -2 * (loglik(m, a, n[t] / total) + loglik(n[t] - m, rest, n[t] / total) - loglik(m, a, m / a) - loglik(n[t] - m, rest, (n[t] - m) / rest))
            if score >= 30 and m / a > n[t] / total:
                starts[t] = (n[t], m, score)
    return short, starts


def test_equal_plain_counts(texts):
    short, starts = plain([r.text for r in texts.collect()])
    got = ab.abbreviations(texts)
    assert {r["type"]: pytest.approx((r["n"], r["n_period"], r["score"])) for r in got.collect()} == short
    assert {"dr", "e.g", "inc", "mr", "p.m"} <= set(short) and not {"town", "people", "staff"} & set(short)
    found = {r["type"]: pytest.approx((r["n"], r["n_after"], r["score"])) for r in ab.sentence_starters(texts, got).collect()}
    assert found == starts and "they" in starts


def test_fewer_false_splits(texts):
    model = ab.learn_sentences(texts)
    own = texts.where("doc_id < 900")
    with_model = tk.sentences(F.col("text"), model.abbreviations, model.starters)
    off = own.select(F.sum(F.abs(F.size(tk.sentences(F.col("text"))) - F.col("n"))).alias("a"), F.sum(F.abs(F.size(with_model) - F.col("n"))).alias("b"))
    before, after = off.first()
    assert before > 1000 and after < before / 10  # "e.g. the" remains: "the" does begin sentences
    # A starter ends the sentence also after an abbreviation.
    assert own.sparkSession.createDataFrame([("We met Acme Inc. They left. Dr. Abel",)], "text string").select(with_model.alias("s")).first()["s"] == [
        "we met acme inc.", "they left.", "dr. abel"
    ]


def test_no_lists_change_nothing(texts):
    a = texts.select("doc_id", tk.sentences(F.col("text")).alias("s"))
    b = texts.select("doc_id", tk.sentences(F.col("text"), ("nosuchword",)).alias("s"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_take_the_lists(texts):
    counted = add_features(texts, abbreviations=("dr", "e.g", "inc", "mr", "p.m"), keep_counts=True)
    rows = counted.where("doc_id < 900").collect()
    assert sum(r["n_sentences"] == r["n"] for r in rows) > 190


def test_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ab.learn_sentences(empty) == ab.SentenceModel((), ())
