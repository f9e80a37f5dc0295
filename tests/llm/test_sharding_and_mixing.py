import re
from collections import defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from penprint.llm import histogram_sort as h
from penprint.llm import source_mixing as m


def test_shards_are_even_gapless_and_whole(spark, hard):
    placed = h.shard_documents(hard, n_shards=5)
    assert set(placed.columns) == {*hard.columns, "slot"}
    rows = placed.select("doc_id", "text", "shard", "slot").collect()
    assert len(rows) == hard.count()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    sizes = {k: sum(len((r.text or "").encode()) + 8 for r in v) for k, v in by_shard.items()}
    largest = max(len((r.text or "").encode()) + 8 for r in rows)
    for k, v in by_shard.items():
        assert sorted(r.slot for r in v) == list(range(len(v)))
        assert abs(sizes[k] - sum(sizes.values()) / 5) <= largest
    again = h.shard_documents(hard.repartition(3), n_shards=5).select("doc_id", "shard", "slot").distinct()
    assert again.exceptAll(placed.select("doc_id", "shard", "slot").distinct()).isEmpty()


def test_a_third_of_all_rows_is_spread(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, 'copy of one text', repeat('x', id % 50))").alias("text"))
    counts = h.shard_documents(docs, n_shards=6).groupBy("shard").agg(F.sum(h.text_bytes("text")).alias("b")).collect()
    assert max(r.b for r in counts) - min(r.b for r in counts) <= 2 * 58


def test_one_key_only(spark):
    docs = spark.createDataFrame([(1, "x")] * 9, "doc_id long, text string")
    rows = h.shard_documents(docs, n_shards=3).collect()
    assert sorted(r.slot for r in rows) == list(range(9)) and len({r.shard for r in rows}) == 1


def test_empty_tables(empty):
    assert h.shard_documents(empty).count() == 0
    assert m.mix_documents(empty).count() == 0
    assert m.plan_mix(empty)[0].count() == 0


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + ([None] if None in sizes else [])
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    target, free, left = {}, set(names), Fraction(sum(sizes.values()))
    while free:
        share = {n: left * weight[n] / sum(weight[x] for x in free) for n in free}
        over = [n for n in free if share[n] > 3 * sizes[n]]
        if not over:
            return target | share
        for n in over:
            target[n] = Fraction(3 * sizes[n])
            left -= target[n]
            free.remove(n)
    return target


def test_mix_meets_targets(spark, hard):
    per_doc, per_source, quotas = m.plan_mix(hard, n_shards=4)
    rows = per_doc.collect()
    assert len(rows) == hard.count()
    sizes = defaultdict(int)
    for r in hard.select("source", "text").collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = brute_targets(sizes)
    got = {r.source: r for r in per_source.collect()}
    for name, target in want.items():
        assert abs(got[name].target - float(target)) < 1e-6 * max(1, target)
    by_target = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by_target[round(r.target, 6), r.source_size] += r.taken
    for (target, _), taken in by_target.items():
        assert abs(taken - target) <= 2
    assert {r["sum(blocks)"] for r in quotas.groupBy("shard").sum("blocks").collect()} <= {sum(sizes.values()) // 4 + d for d in (0, 1)}
    assert quotas.filter("blocks < 0").isEmpty()


def test_sainte_lague_by_highest_quotients(spark):
    votes = [53_000, 24_000, 23_000, 900, 0]
    table = spark.createDataFrame([(i + 1, float(v), 10) for i, v in enumerate(votes)], "rank int, target double, house long")
    seats = {r["rank"]: r["sum(blocks)"] for r in m.block_quotas(table, 5).groupBy("rank").sum("blocks").collect()}
    want = [0] * 5
    for _ in range(10):
        i = max(range(5), key=lambda k: (votes[k] / (2 * want[k] + 1), -k))
        want[i] += 1
    assert [seats[i + 1] for i in range(5)] == want


def test_mixed_corpus_holds_the_taken_words(hard):
    plan = {(r.doc_id, r.digest): 0 for r in m.plan_mix(hard)[0].collect()}
    taken = defaultdict(int)
    for r in m.plan_mix(hard)[0].collect():
        taken[r.doc_id, r.digest] += r.taken
    mixed = m.mix_documents(hard)
    assert mixed.columns == hard.columns and mixed.dtypes == hard.dtypes
    words = defaultdict(int)
    for r in mixed.select("doc_id", "text").collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    by_id = defaultdict(int)
    for (doc_id, _), n in taken.items():
        by_id[doc_id] += n
    assert plan and words == {k: v for k, v in by_id.items() if v}
