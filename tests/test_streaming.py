import pytest
from pyspark.sql import functions as F

from catalog import model_queries
from penprint.plans.score import PREDICTION, score_texts
from penprint.streaming import score as stream
from penprint.streaming import summary


def test_stream_equals_batch(spark, tmp_path, corpus):
    source = f"{tmp_path}/in"
    corpus.select("doc_id", "text").repartition(5).write.parquet(source)
    scored = stream.score_stream(stream.read_text_stream(spark, source, files_per_batch=2))
    query = stream.start_scoring(scored, f"{tmp_path}/out", f"{tmp_path}/state", once=True)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3  # several batches
    want = score_texts(corpus.select("doc_id", "text")).select("doc_id", *PREDICTION)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0

    # New files only: the state knows what was scored.
    corpus.limit(3).selectExpr("doc_id + 10000 as doc_id", "text").write.mode("append").parquet(source)
    stream.start_scoring(scored, f"{tmp_path}/out", f"{tmp_path}/state", once=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == want.count() + 3


def timed(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, minute long")
    return df.select("doc_id", "text", F.timestamp_seconds(F.col("minute") * 60).alias("at"))


def test_totals_of_the_stream_equal_the_batch(spark, tmp_path):
    rows = [(i, f"we said text number {i % 70}, however it is late." if i % 5 else f"my {i % 9} robust realm delve", i) for i in range(300)]
    source, out = f"{tmp_path}/in", f"{tmp_path}/totals"
    timed(spark, rows).repartition(6, "doc_id").write.parquet(source)
    read = spark.readStream.schema("doc_id long, text string, at timestamp").option("maxFilesPerTrigger", 1).parquet(source)

    def run():
        first = summary.distinct_texts(read, "at", "30 days")
        scored = score_texts(first)
        query = summary.start_totals(scored, "at", "1 hour", out, f"{tmp_path}/state", once=True)
        query.awaitTermination()
        return query

    assert len([p for p in run().recentProgress if p["numInputRows"]]) >= 4
    want = score_texts(spark.read.parquet(source).dropDuplicates(["text"]))
    total = want.agg(F.count("*"), F.count_if("is_ai"), F.avg("ai_probability")).first()
    got = summary.read_totals(spark, out)
    sums = got.agg(F.sum("n"), F.sum("n_ai"), F.sum(F.col("mean_ai") * F.col("n")) / F.sum("n")).first()
    assert tuple(sums)[:2] == tuple(total)[:2] and abs(sums[2] - total[2]) < 1e-9 and got.count() > 1

    # Started again from the checkpoint: nothing is repeated, and copies of earlier texts are still known.
    run()
    assert summary.read_totals(spark, out).agg(F.sum("n")).first()[0] == total[0]
    timed(spark, [(900, rows[1][1], 5), (901, "quite another text, you see", 5)]).coalesce(1).write.mode("append").parquet(source)
    run()
    assert summary.read_totals(spark, out).agg(F.sum("n")).first()[0] == total[0] + 1


def test_a_batch_that_is_run_again_counts_once(spark, tmp_path):
    scored = timed(spark, [(1, "a", 0), (2, "b", 70)]).selectExpr("*", "true as is_ai", "0.25D as ai_probability")
    writes = []
    scored.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(scored.schema).parquet(f"{tmp_path}/in")
    # The same rows under a fresh checkpoint take the same batch number, as a retried batch does.
    for attempt in range(2):
        summary.start_totals(stream, "at", "1 hour", f"{tmp_path}/out", f"{tmp_path}/state{attempt}", once=True).awaitTermination()
        writes.append(sorted((r.n, r.n_ai, r.mean_ai) for r in summary.read_totals(spark, f"{tmp_path}/out").collect()))
    assert writes[0] == writes[1] == [(1, 1, 0.25), (1, 1, 0.25)]


@pytest.mark.parametrize("parts", [1, 5])
def test_stream_queries_read_a_table_in_one_file_or_many(spark, tmp_path, corpus, parts):
    docs = corpus.select("doc_id", "text").coalesce(parts)
    if parts == 1:
        docs.write.parquet(f"{tmp_path}/written")
        next((tmp_path / "written").glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    else:
        docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = score_texts(docs).select("doc_id", *PREDICTION)
    got = model_queries._streamed(spark, str(tmp_path))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    distinct = score_texts(docs.dropDuplicates(["text"])).agg(F.count("*"), F.count_if("is_ai")).first()
    assert tuple(model_queries._stream_totals(spark, str(tmp_path)).first())[:2] == tuple(distinct)
