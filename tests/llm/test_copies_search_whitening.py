"""Exact copies, ranked search and whitening against plain Python, on hard rows and in forced small steps."""

import hashlib
import io
import math
import random
import re
from collections import Counter, defaultdict
from contextlib import redirect_stdout

import numpy as np
import pytest
from pyspark.sql import functions as F

from penprint.llm import exact_dedup, queries, ranked_search, whitening


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def copies(rows):
    """{(id, text): [(keep_id, size, kept), ...]} of rows (id, text)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[squeezed(t)].append((i, t or ""))
    out = Counter()
    for same, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        for k, (i, t) in enumerate(members):
            out[i, len(t), members[0][0], len(members), k == 0, hashlib.sha256(same.encode()).hexdigest()] += 1
    return out


def found_copies(df):
    return Counter((r.doc_id, r.n_chars, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect())


@pytest.fixture(scope="module")
def spaced(spark, hard, hard_texts):
    """The hard rows, with copies that differ in white space or only after a long common beginning."""
    more = [(5000 + i, t.replace(" ", ("\t", "  ", "\r\n ")[i % 3]) if t else t) for i, t in enumerate(hard_texts)]
    stem = "w" * 200
    more += [(6000 + i, f"{stem} {i % 4} {'x' * 50}") for i in range(20)]
    return hard.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(6)


@pytest.mark.parametrize("most", [exact_dedup.BROADCAST_KEYS, 0])
def test_copies(spaced, most):
    want = copies([tuple(r) for r in spaced.collect()])
    assert found_copies(exact_dedup.find_copies(spaced, digests=True, broadcast_keys=most)) == want
    without = exact_dedup.find_copies(spaced, broadcast_keys=most)
    some = found_copies(without)
    assert Counter(k[:5] for k in some.elements()) == Counter(k[:5] for k in want.elements())
    assert all(k[5] is not None for k in some if k[3] > 1)


def test_whole_texts_are_read_for_surviving_groups_only(spark):
    rows = [(1, "alone"), (2, "other"), (3, "twin text"), (4, "twin  text"), (5, "abcdefgh"), (6, "w" * 80 + "a"), (7, "w" * 80 + "b")]
    got = {r.doc_id: r for r in exact_dedup.find_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in got.items() if r.digest is not None} == {3, 4, 6, 7}
    assert {i for i, r in got.items() if not r.kept} == {3}


@pytest.mark.parametrize("most", [exact_dedup.BROADCAST_KEYS, 0])
def test_one_of_each_group_stays(hard, most):
    left = exact_dedup.keep_one(hard, broadcast_keys=most)
    assert left.columns == hard.columns and left.dtypes == hard.dtypes
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    kept = Counter((i, n) for (i, n, _, _, stays, _), k in copies(rows).items() if stays for _ in range(k))
    assert Counter((r.doc_id, len(r.text or "")) for r in left.collect()) == kept


def test_copies_plan_moves_no_text_and_needs_no_python(hard):
    shown = io.StringIO()
    with redirect_stdout(shown):
        exact_dedup.find_copies(hard, digests=True).explain("formatted")
    assert "Python" not in shown.getvalue() and "Arrow" not in shown.getvalue()
    assert "text" not in shown.getvalue().lower().replace("context", "")  # texts were read before


def test_copies_of_nothing(empty):
    assert exact_dedup.find_copies(empty).count() == 0
    assert exact_dedup.keep_one(empty).count() == 0


def terms_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def ranking(docs, items, top=50):
    """Rows (item id, rank, doc id, score), each document scored against each item."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = Counter()
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 50 + 50 * sum(b.values()) * n_docs // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m))
                for t in set(terms_of(text)) if t in b
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out[item, rank, i, -score] += 1
    return out


@pytest.fixture(scope="module")
def asked(spark, hard_texts):
    texts = [hard_texts[8], hard_texts[50][:60], " ".join(t for t in hard_texts[9:14]), "Ünï an AN tion re", "", None, "no such words 0x", "one one two", "the"]
    rows = [(i, t, "s", 3) for i, t in enumerate(texts)] + [(3, "st ing er", "s", 3), (None, "the st", "s", 3)]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, score int")


@pytest.mark.parametrize("sizes", [{}, {"top": 3, "probe": 2, "block": 64}, {"top": 7, "slice_terms": 9, "probe": 1}])
def test_search(hard, asked, sizes):
    docs = hard.unionByName(hard.filter("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 100).withColumn("text", F.concat("text", F.lit(" the the an"))))
    got = ranked_search.search(docs.repartition(3), asked, **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = ranking([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in asked.collect()], sizes.get("top", 50))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_search_of_nothing(empty, hard, asked):
    assert ranked_search.search(empty, asked).count() == 0
    assert ranked_search.search(hard, asked.limit(0)).count() == 0


def test_long_texts_and_large_counts(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((3, 50, 400))))) for i in range(300)] + [(999, "w1 " * 200_000 + "w2")]
    items = [(k, " ".join(rng.sample(words, 90))) for k in range(6)]
    got = ranked_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), probe=3, block=64
    )
    assert Counter(tuple(r) for r in got.collect()) == ranking(docs, items)


def grid(vectors):
    good = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = Counter(len(v) for _, v in good)
    d = max(size, key=lambda k: (size[k], k)) if size else 0
    return [(i, tuple(math.floor(256 * c) for c in v)) for i, v in good if len(v) == d]


def check_whitening(spark, vectors, k=4, schema="vec_id long, embedding array<double>"):
    frame = spark.createDataFrame(vectors, schema).repartition(3)
    model = whitening.fit_whitening(frame, k)
    rows = whitening.whiten(frame, model).collect()
    kept = grid(vectors)
    fit = np.array(sorted({x for _, x in kept}), float)
    n, mean = len(fit), fit.mean(0)
    values = np.linalg.eigvalsh((fit - mean).T @ (fit - mean) / n)[::-1]
    want = min(k, int((values > 1e-12 * values[0]).sum()))
    assert model.n == n and len(model.components) == want
    np.testing.assert_allclose(model.variances, values[:want], rtol=1e-9)
    assert model.identity_error < 1e-8 and abs(model.total / values.sum() - 1) < 1e-12
    covariance = (fit - mean).T @ (fit - mean) / n
    for c, e in zip(model.components, model.variances):
        assert abs(np.linalg.norm(c) - 1) < 1e-12
        np.testing.assert_allclose(covariance @ c, e * c, atol=1e-9 * values[0])
    assert Counter((r.vec_id, r.component) for r in rows) == Counter((i, c + 1) for i, _ in kept for c in range(want))
    by = {(r.vec_id, r.component): r for r in rows}
    for i, x in kept:
        if sum(j == i for j, _ in kept) == 1:
            for c in range(want):
                assert abs(by[i, c + 1].whitened - (np.array(x) - mean) @ model.components[c] / math.sqrt(model.variances[c])) < 1e-8
                assert by[i, c + 1].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, fit.sum(0)))
    return model


def test_whitening(spark):
    rng = np.random.default_rng(5)
    v = (rng.standard_normal((400, 8)) * np.linspace(1, 0.1, 8)).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(1000 + i, v[0]) for i in range(200)]
    rows += [(2000, None), (2001, [None] * 8), (2002, [math.nan] * 8), (2003, [math.inf] * 8), (2004, [1.0] * 3), (2005, []), (None, v[3])]
    check_whitening(spark, rows)


def test_repeated_variances_are_all_found(spark):
    """Both signs of each axis: the same variance in every direction, which one starting vector can't tell apart."""
    axes = [[float(s * (k == j)) for j in range(7)] for k in range(7) for s in (1, -1)]
    check_whitening(spark, list(enumerate(axes)))
    lengths = [2.0, 2, 2, 1, 1, 1, 0.5]
    check_whitening(spark, list(enumerate([[lengths[j] * c for j, c in enumerate(a)] for a in axes])), k=5)


def test_few_directions(spark):
    check_whitening(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)])
    check_whitening(spark, [(i, [float(i)]) for i in range(4)])


def test_early_end_is_checked(spark):
    """Well apart variances end a run early; the result is that of the whole space."""
    rng = np.random.default_rng(6)
    v = rng.standard_normal((300, 40)) * (np.array([30, 30, 12, 5, *[0.05] * 36]))
    model = check_whitening(spark, list(enumerate(v.tolist())))
    assert model.steps < 40


def test_no_variance(spark):
    for rows in ([], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, None)], [(1, [])]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        model = whitening.fit_whitening(frame)
        assert whitening.whiten(frame, model).count() == 0


def test_great_entries(spark):
    rows = [(0, [1e300, 1.0]), (1, [0.0, 2.0]), (2, [-1e18, 3.0]), (3, [1e9, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, whitening.fit_whitening(frame)).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3} and all(r.deviation is None for r in got if r.vec_id == 0)


def test_equal_vectors_have_equal_numbers_in_any_block(spark):
    rng = np.random.default_rng(9)
    model_rows = spark.createDataFrame([(i, x) for i, x in enumerate(rng.standard_normal((200, 33)).tolist())], "vec_id long, embedding array<double>")
    model = whitening.fit_whitening(model_rows)
    one = model_rows.filter("vec_id = 7").select("embedding")
    seen = set()
    for size in (1, 2, 3, 7, 40):
        many = spark.range(size).select(F.col("id").alias("vec_id")).crossJoin(one).coalesce(1)
        seen |= {(r.component, r.whitened) for r in whitening.whiten(many, model).collect()}
    assert len(seen) == 4


def test_query_explains_each_component(spark):
    rows = queries.op11_lanczos_whitening(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    fit = np.array(sorted({x for _, x in grid([(r.vec_id, r.embedding) for r in table])}), float)
    values = np.linalg.eigvalsh(np.cov(fit.T, bias=True))[::-1]
    assert len(rows) == 4 * len(table)
    for r in rows:
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-10 and r.n == len(fit) and r.identity_error < 1e-9
