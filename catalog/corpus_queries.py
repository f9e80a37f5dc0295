"""Preparation, classes, sampling, merging, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import text_sql as ts
from catalog.entry import Entry
from penprint.functions import rules
from penprint.operators import classes, digest_index, merge, prepare, sampling
from penprint.plans import prepare as jobs
from penprint.session import scratch_path, stored
from penprint.sources import readers, tables, versions, writers


def _digest(df: DataFrame, *keep: str) -> DataFrame:
    """Texts as digest and length: exact to compare, short to carry."""
    return df.select(
        *keep, F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars")
    )


_TEXT = "md5(text) AS text_md5, length(text)::BIGINT AS chars"
_SEED = 42


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "corpus-csv")
    writers.write_corpus(tables.chat_corpus(spark, folder).select("text", "label"), path, "csv")
    return _digest(prepare.cast_trim(readers.read_labeled_csv(spark, path)), "label")


def _parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    writers.write_corpus(tables.doc_corpus(spark, folder), path)
    return _digest(readers.read_corpus(spark, path), "doc_id", "label")


def _text_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    tables.documents(spark, folder).select("text").write.text(path)
    lines = readers.read_text_lines(spark, path)
    return lines.groupBy(F.md5("text").alias("line_md5")).agg(F.count(F.lit(1)).alias("n"))


def _collections(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as JSON arrays of up to 1000 objects, one file each, and read back by folder."""
    path = scratch_path(spark, "collections")
    texts = tables.table(spark, folder, "documents")
    for name, chosen in (("human", F.col("lang") == "en"), ("ai", F.col("lang") != "en")):
        arrays = texts.where(chosen).groupBy(F.floor(F.col("doc_id") / 1000)).agg(
            F.to_json(F.collect_list(F.struct("doc_id", "text"))).alias("value")
        )
        arrays.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/{name}")
    read = readers.read_source_collections(spark, [f"{path}/human"], [f"{path}/ai"])
    return read.groupBy(F.md5("text").alias("text_md5"), "label").agg(F.count(F.lit(1)).alias("n"))


def _layout_a(spark: SparkSession, folder: str) -> DataFrame:
    """The documents in raw layout A."""
    return tables.doc_corpus(spark, folder).select(
        "doc_id", "text", F.col("label").cast("double").alias("generated")
    )


def _layout_b(spark: SparkSession, folder: str) -> DataFrame:
    return tables.chat_corpus(spark, folder).select(
        "doc_id", F.col("text").alias("Data"), F.col("label").alias("Label")
    )


def _merged(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents as the real corpus, all documents (as class 1) as the generated one."""
    generated = tables.table(spark, folder, "documents").select(
        "doc_id", "text", F.lit(1).alias("label"), F.col("source").alias("topic")
    )
    real = tables.doc_corpus(spark, folder).select("doc_id", "text", "label")
    return merge.merge_corpora(real, generated)


_MERGED = f"""
SELECT 0 AS source_rank, doc_id, {ts.strip('text')} AS text, label, NULL AS topic FROM ({ts.DOC})
UNION ALL
SELECT 1, doc_id, {ts.strip('text')}, 1, source FROM documents"""

_DEDUPED = f"""m AS ({_MERGED}),
d AS (SELECT *, row_number() OVER (PARTITION BY text, label ORDER BY source_rank, doc_id) AS rn FROM m)"""

_KEYED = f"""c AS (SELECT *, {ts.key(_SEED, 'doc_id')} AS k FROM ({ts.CHAT})),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY k) AS rn,
  count(*) OVER (PARTITION BY label) AS size, count(*) OVER () AS total FROM c),
least_class AS (SELECT min(n) AS smallest FROM (SELECT count(*) AS n FROM c GROUP BY label))"""

_SPLIT = f"""{_KEYED},
z AS (SELECT label, count(*) AS size FROM c GROUP BY label),
n AS (SELECT sum(size)::BIGINT AS total, (sum(size) - ceil(sum(size) * 0.2::DOUBLE))::BIGINT AS train FROM z),
f AS (SELECT label, size, train, size * train // total AS fl, (size * train) % total AS rest FROM z, n),
g AS (SELECT *, train - sum(fl) OVER () AS open_n,
  row_number() OVER (ORDER BY rest DESC, label) AS turn FROM f),
t AS (SELECT label, size - fl - CASE WHEN turn <= open_n THEN 1 ELSE 0 END AS test FROM g)"""


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Prepare, merge, deduplicate, balance and count: the whole preparation job, on all rows."""
    real = jobs.prepare_real(_layout_a(spark, folder), "a")
    merged = jobs.merge_large_into_real(real, jobs.prepare_real(_layout_b(spark, folder), "b"))
    keyed = merged.withColumn("key", F.concat_ws("/", "source_rank", "doc_id"))
    return classes.class_ratios(sampling.balance_to_minority(keyed, id_col="key"))


def _indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents added in two batches to a corpus that has an index of its digests."""
    real = _labelled(spark, folder).withColumn("source_rank", F.lit(0))
    every = prepare.cast_trim(tables.table(spark, folder, "documents").select("doc_id", "text", F.lit(1).alias("label")))
    every = every.withColumn("source_rank", F.lit(1))
    index = digest_index.DigestIndex.create(real, f"digests_{uuid.uuid4().hex}", scratch_path(spark, "digests"))
    added = index.add(every.where("doc_id % 2 = 0")).unionByName(index.add(every.where("doc_id % 2 = 1")))
    both = merge.dedupe_text_label(real).unionByName(added)
    return _digest(both.drop("doc_id"), "label")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return prepare.cast_trim(tables.doc_corpus(spark, folder).select("doc_id", "text", "label"))


def _replaced(spark: SparkSession, folder: str) -> DataFrame:
    """A corpus replaced by itself merged with the documents, read back from its newest version."""
    path = scratch_path(spark, "versions")
    versions.write_version(_labelled(spark, folder), path)
    more = tables.table(spark, folder, "documents").select("doc_id", "text", F.lit(1).alias("label"))
    versions.replace_corpus(spark, path, lambda old: merge.dedupe_text_label(merge.merge_corpora(old, more)))
    return _digest(versions.read_current(spark, path), "source_rank", "doc_id", "label")


def _columns_checked(spark: SparkSession, folder: str) -> DataFrame:
    """The tables that have the columns of a text corpus, with their rows; the others are refused by name."""
    out = None
    for name in ("documents", "labels", "pages", "conversations"):
        df = tables.table(spark, folder, name)
        try:
            ok = prepare.require_columns(df, "text").columns == df.columns
        except ValueError as error:
            ok = "text" not in str(error)
        row = df.agg(F.lit(name).alias("name"), F.lit(ok).alias("has_text"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


def _csv_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Keyless CSV folders with repeats inside and across, one file in another column order, and a third source."""
    path = scratch_path(spark, "csv-corpora")
    # Written once: three files are made of it.
    docs = stored(tables.doc_corpus(spark, folder).select("text", "label"), "labelled")
    chat = tables.chat_corpus(spark, folder)
    writers.write_corpus(docs.unionByName(docs), f"{path}/real", "csv")
    writers.write_corpus(chat.select("text", "label"), f"{path}/made", "csv")
    writers.write_corpus(docs.select("label", "text"), f"{path}/turned", "csv")
    third = tables.table(spark, folder, "documents").select("text", F.lit(1).alias("label"))
    writers.write_corpus(third, f"{path}/third", "csv")
    read = [
        readers.read_labeled_csv(spark, names, id_col="doc_id")
        for names in (f"{path}/real", [f"{path}/made", f"{path}/turned"], f"{path}/third")
    ]
    whole = scratch_path(spark, "merged")
    writers.write_corpus(merge.merge_corpora(*read), whole)
    merged = readers.read_corpus(spark, whole)
    kept = stored(merge.dedupe_text_label(merged), "kept")
    dropped = merge.dedupe_report(merged).select("dropped")
    split = sampling.stratified_split(kept.withColumn("key", F.concat_ws("/", "source_rank", "doc_id")), 0.2, _SEED, "key")
    sizes = split.agg(F.count_if("is_test").alias("n_test"))
    return _digest(split, "source_rank", "label").crossJoin(F.broadcast(dropped)).crossJoin(F.broadcast(sizes))


_CSV_MERGED = f"""
WITH m AS (
  SELECT 0 AS source_rank, {ts.strip('text')} AS text, label FROM ({ts.DOC})
  UNION ALL SELECT 0, {ts.strip('text')}, label FROM ({ts.DOC})
  UNION ALL SELECT 1, {ts.strip('text')}, label FROM ({ts.CHAT})
  UNION ALL SELECT 1, {ts.strip('text')}, label FROM ({ts.DOC})
  UNION ALL SELECT 2, {ts.strip('text')}, 1 FROM documents
), k AS (SELECT min(source_rank) AS source_rank, label, text FROM m GROUP BY label, text)
SELECT source_rank, label, {_TEXT}, (SELECT count(*) FROM m) - (SELECT count(*) FROM k) AS dropped,
  (SELECT ceil(count(*) * 0.2::DOUBLE) FROM k)::BIGINT AS n_test
FROM k"""


ENTRIES = [
    Entry("job_csv_merge_dedupe", _csv_merged, _CSV_MERGED),
    Entry(
        "src1_read_labeled_csv", _csv_round_trip,
        f"SELECT label, {_TEXT} FROM (SELECT {ts.strip('text')} AS text, label FROM ({ts.CHAT}))",
    ),
    Entry(
        "src2_read_source_collections", _collections,
        """SELECT md5(text) AS text_md5, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS label, count(*) AS n
        FROM documents GROUP BY ALL""",
    ),
    Entry(
        "src3_read_text_lines", _text_lines,
        f"""SELECT md5(line) AS line_md5, count(*) AS n FROM (
          SELECT {ts.strip('l')} AS line FROM (
            SELECT unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS l FROM documents))
        WHERE line <> '' GROUP BY ALL""",
    ),
    Entry(
        "snk1_write_corpus", _parquet_round_trip,
        f"SELECT doc_id, label, {_TEXT} FROM ({ts.DOC})",
    ),
    Entry(
        "prj1_unify_layout_a",
        lambda spark, d: _digest(prepare.unify_layout_a(_layout_a(spark, d), ["doc_id"]), "doc_id", "label"),
        f"""SELECT doc_id, label, {_TEXT}
        FROM (SELECT doc_id, label, {ts.strip('text')} AS text FROM ({ts.DOC})) WHERE length(text) > 30""",
    ),
    Entry(
        "prj2_unify_layout_b",
        lambda spark, d: _digest(prepare.unify_layout_b(_layout_b(spark, d), ["doc_id"]), "doc_id", "label"),
        f"""SELECT doc_id, label, {_TEXT}
        FROM (SELECT doc_id, label, {ts.strip('text')} AS text FROM ({ts.CHAT})) WHERE length(text) > 30""",
    ),
    Entry(
        "prj3_cast_trim",
        lambda spark, d: _digest(prepare.cast_trim(tables.doc_corpus(spark, d)), "doc_id", "label"),
        f"SELECT doc_id, label, {_TEXT} FROM (SELECT doc_id, label, {ts.strip('text')} AS text FROM ({ts.DOC}))",
    ),
    Entry(
        "prj4_tag_provenance",
        lambda spark, d: _digest(prepare.tag_provenance(tables.table(spark, d, "documents").select(
            "doc_id", "text", F.when(F.col("lang") != "en", F.col("source")).alias("source")), 1
        ), "doc_id", "source", "label", "category", "topic"),
        f"""SELECT doc_id, {_TEXT}, CASE WHEN lang <> 'en' THEN source ELSE 'synthetic_ai' END AS source,
        1 AS label, 'formal_explanation' AS category, 'unknown' AS topic FROM documents""",
    ),
    Entry(
        "prj5_preview",
        lambda spark, d: tables.documents(spark, d).select("doc_id", rules.preview(F.col("text")).alias("preview")),
        """SELECT doc_id, CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END
        AS preview FROM documents""",
    ),
    Entry(
        "flt1_drop_null",
        lambda spark, d: _digest(prepare.drop_null(
            tables.table(spark, d, "documents").join(tables.table(spark, d, "labels"), "doc_id", "left")
            .select("doc_id", "text", F.col("quality").alias("label")), "text", "label",
        ), "doc_id", "label"),
        f"""SELECT doc_id, quality AS label, {_TEXT} FROM documents LEFT JOIN labels USING (doc_id)
        WHERE text IS NOT NULL AND quality IS NOT NULL""",
    ),
    Entry(
        "flt2_min_chars",
        lambda spark, d: _digest(prepare.min_chars(tables.documents(spark, d)), "doc_id"),
        f"SELECT doc_id, {_TEXT} FROM documents WHERE length({ts.strip('text')}) > 30",
    ),
    Entry(
        "flt3_collapse_whitespace",
        lambda spark, d: _digest(prepare.clean_texts(tables.documents(spark, d)), "doc_id"),
        f"""SELECT doc_id, {_TEXT} FROM (SELECT doc_id, {ts.collapse('text')} AS text FROM documents)
        WHERE length(text) > 30""",
    ),
    Entry(
        "flt4_by_class",
        lambda spark, d: _digest(prepare.by_class(tables.doc_corpus(spark, d), 0), "doc_id", "label"),
        f"SELECT doc_id, label, {_TEXT} FROM ({ts.DOC}) WHERE label = 0",
    ),
    Entry(
        "flt4_stray_labels",
        lambda spark, d: classes.stray_labels(
            tables.table(spark, d, "documents").join(tables.table(spark, d, "labels"), "doc_id", "left")
            .select(F.col("quality").alias("label"))
        ),
        """SELECT count(*) FILTER (quality IS NULL OR quality NOT IN (0, 1)) AS stray, count(*) AS total
        FROM documents LEFT JOIN labels USING (doc_id)""",
    ),
    Entry(
        "flt5_normalize_length",
        lambda spark, d: _digest(prepare.normalize_length(tables.documents(spark, d)), "doc_id"),
        f"""SELECT doc_id, {_TEXT} FROM (
          SELECT doc_id, CASE WHEN len(ws) > 200 THEN array_to_string(ws[1:200], ' ') ELSE text END AS text
          FROM (SELECT doc_id, text, {ts.whitespace_words('text')} AS ws FROM documents) WHERE len(ws) >= 100)""",
    ),
    Entry(
        "flt6_scorable",
        lambda spark, d: _digest(prepare.scorable(tables.documents(spark, d)), "doc_id"),
        f"SELECT doc_id, {_TEXT} FROM documents WHERE length({ts.strip('text')}) >= 10",
    ),
    Entry(
        "agg1_class_counts",
        lambda spark, d: classes.class_counts(tables.chat_corpus(spark, d)),
        f"SELECT label, count(*) AS n FROM ({ts.CHAT}) GROUP BY label",
    ),
    Entry(
        "agg2_class_ratios",
        lambda spark, d: classes.class_ratios(tables.chat_corpus(spark, d)),
        f"""SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER ()::DOUBLE AS ratio
        FROM ({ts.CHAT}) GROUP BY label""",
    ),
    Entry(
        "agg3_class_sufficiency",
        lambda spark, d: classes.class_sufficiency(tables.doc_corpus(spark, d), 100),
        f"""SELECT k AS label, count(c.label) AS n, count(c.label) < 100 AS too_few
        FROM (VALUES (0), (1)) v(k) LEFT JOIN ({ts.DOC}) c ON c.label = k GROUP BY k""",
    ),
    Entry(
        "ord1_seeded_shuffle",
        lambda spark, d: _digest(sampling.seeded_shuffle(tables.chat_corpus(spark, d)), "doc_id", "shuffle_key"),
        f"SELECT doc_id, {ts.key(_SEED, 'doc_id')} AS shuffle_key, {_TEXT} FROM ({ts.CHAT})",
    ),
    Entry(
        "ord2_balanced_subsample",
        lambda spark, d: _digest(sampling.balanced_subsample(tables.chat_corpus(spark, d), 300), "doc_id", "label"),
        f"WITH {_KEYED} SELECT doc_id, label, {_TEXT} FROM r WHERE total <= 300 OR rn <= 150",
    ),
    Entry(
        "ord3_balance_to_minority",
        lambda spark, d: _digest(sampling.balance_to_minority(tables.chat_corpus(spark, d)), "doc_id", "label"),
        f"WITH {_KEYED} SELECT doc_id, label, {_TEXT} FROM r, least_class WHERE rn <= smallest",
    ),
    Entry(
        "ord4_stratified_split",
        lambda spark, d: _digest(sampling.stratified_split(tables.chat_corpus(spark, d)), "doc_id", "label", "is_test"),
        f"WITH {_SPLIT} SELECT doc_id, label, rn <= test AS is_test, {_TEXT} FROM r JOIN t USING (label)",
    ),
    Entry(
        "ord5_random_split",
        lambda spark, d: _digest(sampling.random_split(tables.documents(spark, d)), "doc_id", "is_holdout"),
        f"SELECT doc_id, {_TEXT}, substr({ts.key(_SEED, 'doc_id')}, 1, 4) < '3333' AS is_holdout FROM documents",
    ),
    Entry(
        "ord6_head_per_class",
        lambda spark, d: _digest(sampling.head_per_class(tables.chat_corpus(spark, d), 200), "doc_id", "label"),
        f"WITH {_KEYED} SELECT doc_id, label, {_TEXT} FROM r, least_class WHERE rn <= least(200, smallest)",
    ),
    Entry(
        "ord8_sample_row_per_class",
        lambda spark, d: _digest(sampling.sample_row_per_class(tables.doc_corpus(spark, d)), "doc_id", "label"),
        f"""SELECT doc_id, label, {_TEXT} FROM ({ts.DOC})
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) = 1""",
    ),
    Entry(
        "ord8_preview_per_class",
        lambda spark, d: jobs.preview_per_class(tables.doc_corpus(spark, d)),
        f"""SELECT label, doc_id, substr({ts.collapse('text')}, 1, 200) AS preview FROM ({ts.DOC})
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) = 1""",
    ),
    Entry(
        "ord9_kfold",
        lambda spark, d: _digest(sampling.kfold(tables.chat_corpus(spark, d)), "doc_id", "label", "fold"),
        f"WITH {_KEYED} SELECT doc_id, label, {_TEXT}, ((rn - 1) % 5)::INT AS fold FROM r",
    ),
    Entry(
        "win2_rank_in_class",
        lambda spark, d: _digest(sampling.rank_in_class(tables.chat_corpus(spark, d)), "doc_id", "label", "rank"),
        f"WITH {_KEYED} SELECT doc_id, label, {_TEXT}, rn AS rank FROM r",
    ),
    Entry(
        "set1_merge_corpora",
        lambda spark, d: _digest(_merged(spark, d), "source_rank", "doc_id", "label", "topic"),
        f"SELECT source_rank, doc_id, label, topic, {_TEXT} FROM ({_MERGED})",
    ),
    Entry(
        "set2_dedupe_text_label",
        lambda spark, d: _digest(merge.dedupe_text_label(_merged(spark, d)), "source_rank", "doc_id", "label"),
        f"WITH {_DEDUPED} SELECT source_rank, doc_id, label, {_TEXT} FROM d WHERE rn = 1",
    ),
    Entry(
        "set2_dedupe_report",
        lambda spark, d: merge.dedupe_report(_merged(spark, d)),
        f"""WITH {_DEDUPED} SELECT count(*) AS rows_before, count(*) FILTER (rn = 1) AS rows_after,
        count(*) FILTER (rn > 1) AS dropped FROM d""",
    ),
    Entry(
        "set2_merge_large_into_real",
        lambda spark, d: _digest(jobs.merge_large_into_real(
            tables.doc_corpus(spark, d).select("doc_id", "text", "label"),
            tables.table(spark, d, "documents").select("doc_id", "text", F.lit(1).alias("label")),
        ), "source_rank", "doc_id", "shuffle_key"),
        f"""WITH {_DEDUPED} SELECT source_rank, doc_id, {_TEXT}, {ts.key(_SEED, 'source_rank', 'doc_id')} AS shuffle_key
        FROM d WHERE rn = 1""",
    ),
    Entry(
        "set2_incremental_index", _indexed,
        f"""SELECT label, {_TEXT} FROM (SELECT {ts.strip('text')} AS text, label FROM ({ts.DOC})
          UNION SELECT {ts.strip('text')}, 1 FROM documents)""",
    ),
    Entry(
        "snk1_replace_in_place", _replaced,
        f"WITH {_DEDUPED} SELECT source_rank, doc_id, label, {_TEXT} FROM d WHERE rn = 1",
    ),
    Entry(
        "src4_require_columns", _columns_checked,
        """SELECT 'documents' AS name, true AS has_text, count(*) AS n FROM documents
        UNION ALL SELECT 'labels', false, count(*) FROM labels
        UNION ALL SELECT 'pages', false, count(*) FROM pages
        UNION ALL SELECT 'conversations', true, count(*) FROM conversations""",
    ),
    Entry(
        "set3_stack_classes",
        lambda spark, d: _digest(merge.stack_classes(
            tables.table(spark, d, "conversations").where("role = 'user'").select("conv_id", "turn", "text"),
            tables.table(spark, d, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text"),
        ), "conv_id", "turn", "label"),
        f"""SELECT conv_id, turn, 0 AS label, {_TEXT} FROM conversations WHERE role = 'user'
        UNION ALL SELECT conv_id, turn, 1, {_TEXT} FROM conversations WHERE role = 'assistant'""",
    ),
    Entry(
        "job_prepare_merge_balance", _prepared,
        f"""WITH u AS (SELECT * FROM (SELECT {ts.strip('text')} AS text, label FROM ({ts.DOC})) WHERE length(text) > 30
          UNION SELECT * FROM (SELECT {ts.strip('text')} AS text, label FROM ({ts.CHAT})) WHERE length(text) > 30),
        c AS (SELECT label, count(*) AS own FROM u GROUP BY label)
        SELECT label, (SELECT min(own) FROM c) AS n,
          (SELECT min(own) FROM c) / sum((SELECT min(own) FROM c)) OVER ()::DOUBLE AS ratio FROM c""",
    ),
]
