"""A fixture with what operators must bear: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

import pytest

SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, size long, shard int, node string, key long, a string, b string"


def prose(rng, n):
    syllables = ["an", "er", "tion", "the", "ou", "re", "st", "ing", "né", "lä"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows_of(texts, ids=None):
    return [
        (i, t, None if k % 7 == 0 else f"s{k % 3}", "en", len(t or ""), 5, 1, "n", 9, "a", "b")
        for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts))
    ]


@pytest.fixture(scope="session")
def hard_texts():
    rng = random.Random(7)
    shared = prose(rng, 60)
    copy = prose(rng, 120)
    near = copy.split(" ")
    texts = [None, "", " \n\t ", "one", "One two three", "x" * 30_000, "ab " * 4000]
    texts += [prose(rng, rng.randint(5, 200)) for _ in range(40)]
    texts += [copy] * 12
    for i in range(10):
        words = list(near)
        words[10 * i + 3] = f"edit{i}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 30)} {shared} {prose(rng, 20)}" for _ in range(10)]
    texts += ["Ünï çödé ★ ﷽ 漢字 \U0001f600 end.", "a\x00b \r\n c", "tab\tand\x0bfeed\x0c.", "<|endoftext|> it's 12² ﬁne…"]
    return texts


@pytest.fixture(scope="session")
def hard(spark, hard_texts):
    """Ids ascend but for a null id and repeated rows."""
    rows = rows_of(hard_texts)
    rows += [(None, hard_texts[10], "s1", "en", 1, 5, 1, "n", 9, "a", "b"), rows[20], rows[20]]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
