"""Pieces of any cut give the features of the whole text."""

import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from penprint.functions.features import FEATURES, add_features
from penprint.operators import long_texts
from penprint.operators.long_texts import cut_texts, piece_features
from tests.test_features import PIECES, TEXTS


def near(a, b):
    return {r["doc_id"]: tuple(round(r[f], 9) for f in FEATURES) for r in a.collect()} == {
        r["doc_id"]: tuple(round(r[f], 9) for f in FEATURES) for r in b.collect()
    }


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(11)
    glue = ["", " ", " "]
    noise = ["".join(rng.choice(PIECES) + rng.choice(glue) for _ in range(rng.randint(1, 120))) for _ in range(120)]
    prose = [
        " ".join(rng.choice(["we", "was", "used", "is", "tired.", "it's", "however,", "a", "b:", "\n\n", "end!", "robust", "don't"]) for _ in range(400))
        for _ in range(20)
    ]
    rows = [(i, t) for i, t in enumerate([*TEXTS.values(), *noise, *prose, "x" * 5000, "y " * 3000, None, "was\n\n\nused", "Σ ΑΣ ΑΣΑ"])]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_pieces_of_any_size(texts, size):
    assert near(piece_features(cut_texts(texts, size)), add_features(texts))


def test_pieces_of_uneven_cuts(spark, texts):
    rng = random.Random(12)
    rows = []
    for r in texts.collect():
        text, place = r.text or "", 0
        while text or not place:
            n = rng.choice([0, 1, 2, 5, 30, 200])
            rows.append((r.doc_id, 3 * place, text[:n]))
            text, place = text[n:], place + 1
    rng.shuffle(rows)
    pieces = spark.createDataFrame(rows, "doc_id long, place int, piece string")
    assert near(piece_features(pieces), add_features(texts))


def test_clauses_as_one_piece(texts):
    got = piece_features(cut_texts(texts, 40), sentences_in_clauses=False)
    assert near(got, add_features(texts, sentences_in_clauses=False))


def test_no_text_after_the_segments_is_shuffled(texts):
    shown = io.StringIO()
    with redirect_stdout(shown):
        piece_features(cut_texts(texts, 100)).explain("formatted")
    exchanges = [part for part in shown.getvalue().split("\n\n") if "Exchange" in part]
    assert exchanges and not any("_segment#" in part or "_t_line" in part for part in exchanges)


def test_distinct_words_of_short_and_long_texts(spark, texts, monkeypatch):
    """Words of a short text meet as a row a segment, those of a long one word by word; both equal the whole text's."""
    monkeypatch.setattr(long_texts, "WHOLE", 500)
    lengths = texts.select(F.length("text").alias("n")).collect()
    assert any((r.n or 0) > 500 for r in lengths) and any(0 < (r.n or 0) <= 500 for r in lengths)
    assert near(piece_features(cut_texts(texts, 100)), add_features(texts))
    segments = spark.createDataFrame([(1, "a b a c"), (1, "c d"), (2, ""), (3, "x " * 400)], "_id long, _segment string")
    rows = segments.select("_id", F.length("_segment").cast("double").alias("chars"))
    counts = long_texts._distinct_words(segments, rows)
    assert {(r["_id"], r.distinct) for r in counts.collect()} == {(1, 4.0), (3, 1.0)}
