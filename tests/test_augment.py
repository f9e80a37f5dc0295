import pytest

from penprint.operators import augment


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, f"because number {i} makes useful things, we use it. Really good indeed.") for i in range(2000)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def by_id(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_terms(spark):
    df = spark.createDataFrame([(1, "because we use good help")], "doc_id long, text string")
    assert by_id(augment.substitute_terms(df)) == {1: "becautilize we utilize effective facilitate"}
    assert by_id(augment.substitute_terms(df, whole_word=True)) == {1: "because we utilize effective facilitate"}


def test_terms_are_taken_as_they_stand(spark):
    df = spark.createDataFrame([(1, "c++ and c, a.b but axb, cc++")], "doc_id long, text string")
    got = augment.substitute_terms(df, {"c++": "cpp", "a.b": "$5\\\\x"}, whole_word=True).first()["text"]
    assert got == "cpp and c, $5\\\\x but axb, cc++"


def test_phrases_at_their_rate(texts):
    before = by_id(texts)
    after = by_id(augment.append_phrase(texts, ["one", "two"], 0.3, "p"))
    changed = [i for i in before if after[i] != before[i]]
    assert 0.25 < len(changed) / len(before) < 0.35
    ends = {after[i][len(before[i]):] for i in changed}
    assert ends == {" one", " two"}
    assert by_id(augment.append_phrase(texts.coalesce(1), ["one", "two"], 0.3, "p")) == after
    assert by_id(augment.append_phrase(texts, ["one", "two"], 0.3, "p", seed=7)) != after


def test_noise(texts):
    before, after = by_id(texts), by_id(augment.append_noise(texts))
    assert all(after[i].startswith(before[i]) for i in before)
    assert 0.7 < sum(after[i] != before[i] for i in before) / len(before) < 0.9
    dotted = by_id(augment.stretch_periods(texts))
    hit = [i for i in before if dotted[i] != before[i]]
    assert 0.15 < len(hit) / len(before) < 0.25
    assert dotted[hit[0]] == before[hit[0]].replace(".", "...")


def test_typos(spark, texts):
    before, after = by_id(texts), by_id(augment.inject_typos(texts))
    changed = 0
    for i in before:
        a, b = before[i].split(), after[i].split()
        differing = [(x, y) for x, y in zip(a, b) if x != y]
        assert len(a) == len(b) and len(differing) <= 1
        for x, y in differing:
            changed += 1
            assert x.isalpha() and len(x) > 4 and len(y) == len(x) + 1
            assert any(y == x[:p] + x[p] + x[p:] for p in range(1, len(x) - 1))
    assert 0 < changed < len(before) / 2
    short = spark.createDataFrame([(1, "three  spaced   words"), (2, "four  spaced tiny ones")], "doc_id long, text string")
    got = by_id(augment.inject_typos(short, rate=0.0))
    assert got == {1: "three  spaced   words", 2: "four spaced tiny ones"}


def test_typo_places(spark):
    """Exactly one place in fifteen is drawn, all different."""
    text = " ".join(["letters"] * 150)
    df = spark.createDataFrame([(i, text) for i in range(50)], "doc_id long, text string")
    for after in by_id(augment.inject_typos(df, rate=1.0)).values():
        assert sum(w != "letters" for w in after.split()) == 10
