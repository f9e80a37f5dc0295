import random

import pytest
from pyspark.sql import functions as F

import brute
from penprint.functions import lexicons as lx
from penprint.functions import tokens as tk
from penprint.functions.features import FEATURES, add_features

TEXTS = {
    1: "I don't think it's done. We were amazed, but you're late!",
    2: "However, the robust framework was designed carefully; therefore, it delivers. "
       "Moreover, results are reviewed: all good.",
    3: "First part here.\n\nSecond part is quite a bit longer than that.\n\n\n\nThird.",
    4: "",
    5: "12345 678, 90!",
    6: "One sentence only without any stop",
    7: 'He said "stop." (She left.) Wait... what?!',
    8: "state-of-the-art and cutting-edge: 3.14, 1,000 items",
    9: "   \n\n  ",
    10: "Élan vital était noté. C'est fini.",
}

# Tokens, sentences and the features; clauses taken as one piece each.
GOLDEN = {
    1: (17, 2, 1.0, 0.0, 0.058824, 3.272727, 0.052632, 0.058824, 0.0, 0.0, 0.28, 0.0, 7.5, 1.0,
        0.176471, 0.176471, 0.5),
    2: (23, 2, 0.869565, 0.173913, 0.217391, 6.0625, 0.058824, 0.043478, 0.0, 0.391304, 0.018182,
        0.130435, 2.833333, 0.869565, 0.0, 0.0, 1.0),
    3: (16, 3, 0.8125, 0.0, 0.637377, 4.076923, 0.041667, 0.0, 3.399346, 0.0, 0.637377, 0.0, 14.0,
        0.8125, 0.0, 0.0, 0.0),
    4: (0, 0) + (0.0,) * 15,
    5: (5, 1, 1.0, 0.0, 0.0, 0.0, 0.142857, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 1.0, 0.0, 0.0, 0.0),
    6: (6, 1, 1.0, 0.0, 0.0, 4.833333, 0.0, 0.0, 0.0, 0.333333, 0.0, 0.0, 6.0, 1.0, 0.0, 0.0, 0.0),
    7: (16, 4, 0.875, 0.0, 0.395285, 3.571429, 0.166667, 0.0, 0.0, 0.0, 0.395285, 0.0, 14.0, 0.875,
        0.0, 0.0, 0.0),
    8: (8, 1, 1.0, 0.25, 0.0, 4.0, 0.076923, 0.125, 0.0, 0.25, 0.0, 0.0, 1.75, 1.0, 0.0, 0.0, 0.0),
    9: (0, 0) + (0.0,) * 15,
    10: (8, 2, 0.875, 0.0, 0.25, 4.4, 0.058824, 0.0, 0.0, 0.0, 0.25, 0.0, 7.0, 0.875, 0.0, 0.0, 0.0),
}

# Words per clause when full stops inside a clause end a sentence, counted by hand.
CLAUSES_WITH_SENTENCES = {1: 8.0, 2: 3.0, 3: 16.0, 5: 2.0, 6: 6.0, 7: 16.0, 8: 1.75, 10: 8.0}

PIECES = [
    "a", "word", "b.", "'", "s", "n't", "don't", "'s ", "it's", "'ll", "they'll", ",", ":", ";", "5",
    "3,000", ".", "..", "...", "!", "?", " ", " ", " ", "\n", "\n\n", "\t", "(", ")", '"', "]", "}",
    ">", "é", "Éa", " is", " was", "ed ", "used ", "However", "robust", "I", "you", "and", "N'T", "'S ",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string")


@pytest.fixture(scope="module")
def noise():
    draw = random.Random(7)
    return ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 60))) for _ in range(4000)]


def test_golden_rows(texts):
    df = add_features(texts, sentences_in_clauses=False, keep_counts=True)
    for row in df.collect():
        got = (row["n_tokens"], row["n_sentences"], *[row[f] for f in FEATURES])
        assert got == pytest.approx(GOLDEN[row["doc_id"]], abs=1e-6), row["doc_id"]


def test_clauses_are_tokenised_by_sentence(texts):
    got = {r["doc_id"]: r["avg_clause_length"] for r in add_features(texts).collect()}
    for doc_id, value in CLAUSES_WITH_SENTENCES.items():
        assert got[doc_id] == pytest.approx(value)


def test_golden_tokens(texts):
    got = {r[0]: r[1] for r in texts.select("doc_id", tk.words(F.col("text"))).collect()}
    assert got[1] == "i do n't think it 's done . we were amazed , but you 're late !".split()
    assert got[7] == 'he said " stop . " ( she left . ) wait ... what ? !'.split()


@pytest.mark.parametrize("sentences_in_clauses", [True, False])
def test_features_against_brute_force(spark, noise, sentences_in_clauses):
    df = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string").repartition(8)
    rows = add_features(df, sentences_in_clauses=sentences_in_clauses).collect()
    assert len(rows) == len(noise)
    for row in rows:
        want = brute.features(row["text"], sentences_in_clauses)
        assert [row[f] for f in FEATURES] == pytest.approx(want, abs=1e-9), repr(row["text"])


def test_tokens_against_brute_force(spark, noise):
    df = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    body = F.col("text")
    rows = df.select(
        "text", tk.words(body).alias("w"), tk.sentences(body).alias("s"), tk.clauses(body).alias("c"),
        tk.token_array(tk.spaced_words(body)).alias("as_written"),
    ).collect()
    for row in rows:
        lowered = row["text"].lower()
        assert row["w"] == brute.words(lowered)
        assert row["as_written"] == brute.words(row["text"])
        assert row["s"] == [s.strip(brute.BLANK) for s in brute.sentences(lowered)]


def test_every_feature_moves(spark, noise):
    df = spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string")
    top = add_features(df).agg(*[F.max(f).alias(f) for f in FEATURES]).first()
    assert all(top[f] > 0 for f in FEATURES)


def test_ratios_stay_between_zero_and_one(spark, noise):
    df = add_features(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string"))
    ratios = [f for f in FEATURES if f.endswith(("ratio", "density", "diversity")) and f != "passive_ratio"]
    outside = " or ".join(f"{f} < 0 or {f} > 1" for f in ratios)
    assert df.where(outside).count() == 0


def test_same_values_for_any_partitioning(spark, noise):
    df = spark.createDataFrame(list(enumerate(noise[:300])), "doc_id long, text string")
    one = {r["doc_id"]: r for r in add_features(df.coalesce(1)).collect()}
    many = {r["doc_id"]: r for r in add_features(df.repartition(8)).collect()}
    assert one == many


def test_null_text_counts_as_empty(spark):
    df = spark.createDataFrame([(1, None)], "doc_id long, text string")
    row = add_features(df).first()
    assert [row[f] for f in FEATURES] == [0.0] * 15 and row["text"] is None


def test_long_runs_stay_linear(spark):
    """Runs that would make a backtracking pattern quadratic."""
    runs = ["." * 200_000, "a" * 200_000, " " * 200_000 + "x", "," * 200_000, "'" * 200_000, "is " * 70_000]
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string").repartition(6)
    assert add_features(df).where("unique_word_ratio >= 0").count() == 6


def test_own_word_lists(spark):
    df = spark.createDataFrame([(1, "alpha beta beta gamma")], "doc_id long, text string")
    row = add_features(df, ai_words=["beta"], pronouns=["gamma", "alpha"]).first()
    assert (row["ai_word_ratio"], row["pronoun_ratio"]) == (0.5, 0.5)


def test_compat_word_list():
    assert len(lx.ai_words()) == 68 and "thus" in lx.ai_words()
    compat = lx.ai_words(compat=True)
    assert len(compat) == 67 and "thusfacilitate" in compat and "thus" not in compat


def test_plan_is_narrow_and_tokenises_once(texts):
    plan = add_features(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan
    # Words and clauses: one pass each over punctuation and clitics.
    assert plan.count(" $1 $2") == 2 and plan.count(" $0 ") == 2


def test_tokens_are_counted_without_arrays(spark):
    """Counts by pattern equal the arrays' sizes; a pair's first character is tried before its alternatives."""
    texts = [*TEXTS.values(), None, "", " \t a\u0001b\u0002c\u0002\u0002 d\f\x0be ", "x  y\u00a0z", "is used was  tired iswas wed are a ed"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("spaced", tk.spaced_clauses(F.lower("text")))
    plain = rf" (?:{'|'.join(lx.BE_FORMS)})(?= ++[^ ]*?ed )"
    line = tk.even_line(F.col("spaced"))
    rows = df.select(
        tk.token_count(F.col("spaced")).alias("n"), F.size(tk.token_array(F.col("spaced"))).alias("n_of_array"),
        F.regexp_count(line, F.lit(tk.pair_pattern(lx.BE_FORMS, "ed"))).alias("pairs"), F.regexp_count(line, F.lit(plain)).alias("plain"),
        (tk.mark_clauses(F.col("text")) == F.translate("text", ",;:", tk.CLAUSE * 3)).alias("same"),
    ).collect()
    assert all(r.n == r.n_of_array and r.pairs == r.plain and r.same is not False for r in rows) and any(r.pairs for r in rows)
    assert tk.pair_pattern(("is", "was"), "ed").startswith(" (?=[iw])")
    assert "array_remove" not in str(tk.token_count(F.col("spaced")))
