import re

from penprint.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)
    )


def test_counts_and_verdicts(spark, hard, hard_texts):
    texts = [t for t in hard_texts if len(t or "") < 5000] + ["a b c a b c a b c", "l\nl\nm | # &\n\nl", "p q r s " * 30]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in q.judge(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(texts[r.doc_id])
        assert r.kept == (not r.failed)
    assert q.judge(hard).count() == hard.count()


def test_filter_keeps_columns_and_copies(hard):
    kept = q.keep_good(hard)
    assert kept.columns == hard.columns
    assert kept.filter("text is null or trim(text) = ''").isEmpty()
    assert kept.filter("doc_id between 47 and 58").select("text").distinct().count() <= 1
    assert kept.filter("doc_id is null").count() == kept.filter("doc_id = 10").count()


def test_empty(empty):
    assert q.judge(empty).count() == 0 and q.keep_good(empty).count() == 0
