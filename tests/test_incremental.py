"""Adding to an indexed corpus, replacing a corpus by what was made from it, and repeated log entries."""

import io
import random
import uuid
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from penprint.operators import merge
from penprint.operators.digest_index import DigestIndex
from penprint.sources import versions, writers


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)


def pairs(df):
    return sorted((r.text or "\x00", -1 if r.label is None else r.label) for r in df.collect())


@pytest.fixture
def index_of(spark, tmp_path):
    def make(df, buckets=8):
        return DigestIndex.create(df, f"digests_{uuid.uuid4().hex}", f"{tmp_path}/{uuid.uuid4().hex}", buckets)

    return make


def rows_of(rng, n, start):
    return [(start + i, rng.choice([None, "", "same", f"text {rng.randrange(60)}"]), rng.choice([0, 1, None])) for i in range(n)]


def test_batches_equal_a_full_dedupe(spark, index_of):
    rng = random.Random(1)
    base, one, two = (frame(spark, rows_of(rng, n, 1000 * k)) for k, n in enumerate((150, 90, 200)))
    index = index_of(base)
    first, second = index.add(one), index.add(two)
    got = merge.dedupe_text_label(base).unionByName(first).unionByName(second)
    assert pairs(got) == pairs(merge.dedupe_text_label(base.unionByName(one).unionByName(two)))
    assert index.add(one).where("text is not null").count() == 0 and index.add(two).where("text is not null").count() == 0
    assert index.table().count() == got.where("text is not null").count() == index.table().distinct().count()


def test_the_index_is_not_shuffled(spark, index_of):
    index = index_of(frame(spark, [(i, f"t{i}", 0) for i in range(500)]))
    index.add(frame(spark, [(i, f"t{i}", 0) for i in range(400, 700)]))
    digests = frame(spark, [(1, "t5", 0)]).selectExpr("md5(text) as digest")
    shown = io.StringIO()
    with redirect_stdout(shown):
        index.known(digests).explain("simple")
    plan = shown.getvalue().splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "Bucketed: true" in line)
    # From the join down to the index there is a sort at most.
    assert "SortMergeJoin" in shown.getvalue()
    above = [line for line in plan[:scan] if line.index(next(c for c in line if c.isalpha() or c == "*")) <= plan[scan].find("FileScan")]
    depth = plan[scan].find("FileScan")
    for line in reversed(above):
        at = min(i for i, c in enumerate(line) if c.isalpha() or c == "*")
        if at < depth:
            depth = at
            assert "Exchange" not in line
        if "SortMergeJoin" in line:
            break
    assert sum("Exchange hashpartitioning" in line for line in plan) >= 1  # the batch's digests move


def test_opened_again(spark, index_of):
    index = index_of(frame(spark, [(1, "a", 0), (2, "b", 1)]), buckets=4)
    again = DigestIndex.open(spark, f"again_{uuid.uuid4().hex}", index.path, 4)
    assert pairs(again.add(frame(spark, [(3, "a", 0), (4, "a", 1)]))) == [("a", 1)]


def test_replaced_in_place(spark, tmp_path):
    path = f"{tmp_path}/corpus"
    assert versions.write_version(frame(spark, [(1, "a", 0), (2, "a", 0), (3, "b", 1)]), path) == 1
    assert versions.replace_corpus(spark, path, merge.dedupe_text_label) == 2
    assert pairs(versions.read_current(spark, path)) == [("a", 0), ("b", 1)]
    more = frame(spark, [(9, "c", 1)])
    versions.replace_corpus(spark, path, lambda old: old.unionByName(more))
    assert pairs(versions.read_current(spark, path)) == [("a", 0), ("b", 1), ("c", 1)]
    versions.drop_versions(spark, path)
    assert [n for n, _ in versions.versions(spark, path)] == [3] and versions.read_current(spark, path).count() == 3


def test_an_interrupted_write_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/corpus"
    versions.write_version(frame(spark, [(1, "a", 0)]), path)
    with pytest.raises(ZeroDivisionError):
        versions.replace_corpus(spark, path, lambda old: 1 / 0)
    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            versions.replace_corpus(spark, path, lambda old: old.limit(0))
    assert pairs(versions.read_current(spark, path)) == [("a", 0)]
    with pytest.raises(Exception):
        broken = versions.read_current(spark, path).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
        versions.write_version(broken, path)
    assert pairs(versions.read_current(spark, path)) == [("a", 0)]


def test_only_one_of_two_writers_commits(spark, tmp_path):
    path = f"{tmp_path}/corpus"
    versions.write_version(frame(spark, [(1, "a", 0)]), path)

    def overtaken(old):
        versions.write_version(frame(spark, [(2, "b", 0)]), path)
        return old

    with pytest.raises(RuntimeError):
        versions.replace_corpus(spark, path, overtaken)
    assert pairs(versions.read_current(spark, path)) == [("b", 0)]
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, f"{tmp_path}/nothing")


def test_a_repeated_run_is_logged_once(spark, tmp_path):
    area = spark.createDataFrame([(0.75,)], "roc_auc double")
    for run, seed in (("007", 1), ("8", 2), ("007", 3)):
        writers.append_run_log(area, f"{tmp_path}/log", run, seed=seed)
    got = writers.read_run_log(spark, f"{tmp_path}/log")
    assert sorted((r.run_id, r.seed, r.roc_auc) for r in got.collect()) == [("007", 3, 0.75), ("8", 2, 0.75)]
