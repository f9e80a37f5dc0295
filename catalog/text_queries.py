"""Tokens, features, lexicons, rules and perturbations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import text_sql as ts
from catalog.entry import Entry
from penprint.functions import lexicons as lx
from penprint.functions import rules
from penprint.functions import tokens as tk
from penprint.functions.features import FEATURES, add_features
from penprint.operators import abbreviations, augment, evaluate, lexicon, long_texts
from penprint.operators.models import predict_or_heuristic
from penprint.plans import score
from penprint.session import stored
from penprint.sources import tables

# Words that do occur in the documents, so that every lexicon feature has something to count.
_SEEN = ("and", "is", "the", "was", "with")
_SEEN_OTHER = ("are", "that", "of", "on", "by")

_PHRASES = (
    "However, it wasn't tested, so you don't see what we're asked.",
    "Moreover, the robust results were reviewed; I'd say they'll do.",
    "Therefore it is used, and my notes are updated: that's all.",
)


def _rounded(df: DataFrame, *keep: str, names: Sequence[str] = FEATURES) -> DataFrame:
    return df.select(*keep, *[F.round(n, 6).alias(n) for n in names])


def _sql_rounded(*keep: str, names: Sequence[str] = FEATURES) -> str:
    return ", ".join([*keep, *[f"round({n}::DOUBLE, 6) AS {n}" for n in names]])


_SEEN_LISTS = {"ai_words": _SEEN, "transitions": _SEEN_OTHER, "pronouns": ("on", "in", "to")}


def _marked(df: DataFrame) -> DataFrame:
    """Documents with a phrase appended that uses every feature."""
    return augment.append_phrase(df, _PHRASES, 0.8, "features")


_MARKED = f"""SELECT doc_id, CASE WHEN {ts.uniform(42, 'features')} < 0.8
  THEN text || ' ' || ([{', '.join(ts.q(p) for p in _PHRASES)}])[
    floor({ts.uniform(42, 'features:which')} * {len(_PHRASES)})::INT + 1]
  ELSE text END AS text FROM documents"""

_COUNTS = ("n_tokens", "n_sentences")
_SQL_COUNTS = ("nw AS n_tokens", "ns AS n_sentences")


def _feature_query(corpus: Callable[[SparkSession, str], DataFrame], **options):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        features = add_features(corpus(spark, folder), keep_counts=True, **options)
        return _rounded(features, "doc_id", *[F.col(c).cast("bigint").alias(c) for c in _COUNTS])

    return run


def _feature_sql(source: str, **options) -> str:
    return (
        f"WITH {ts.features_cte(source, **options)} "
        f"SELECT {_sql_rounded('doc_id', *_SQL_COUNTS)} FROM feats"
    )


def _one(name: str, features: Sequence[str]) -> Entry:
    """Some of the features of the documents alone: the optimizer drops what the others need."""
    return Entry(
        name,
        lambda spark, d: _rounded(add_features(_marked(tables.documents(spark, d))), "doc_id", names=features),
        f"WITH {ts.features_cte(_MARKED)} SELECT {_sql_rounded('doc_id', names=features)} FROM feats",
    )


def _per_text(name: str, value: Callable[[Column], Column], sql: str) -> Entry:
    """A list per document as its size and digest."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        listed = _marked(tables.documents(spark, folder)).select("doc_id", value(F.col("text")).alias("l"))
        return listed.select(
            "doc_id", F.size("l").cast("bigint").alias("n"),
            F.md5(F.array_join("l", "|")).alias("joined_md5"),
        )

    return Entry(name, run, f"""SELECT doc_id, len(l)::BIGINT AS n,
      md5(coalesce(array_to_string(l, '|'), '')) AS joined_md5
      FROM (SELECT doc_id, {sql} AS l FROM (SELECT doc_id, lower(text) AS lt FROM ({_MARKED})))""")


def _strip_each(parts: str) -> str:
    return f"list_filter(list_transform({parts}, lambda p: {ts.strip('p')}), lambda p: p <> '')"


_SHORTENED = ("Dr. Abel met e.g. two friends of Acme Inc. in town.", "They left at 5 p.m. and called Mr. Lund.", "No. 7 was closed.")


def _abbreviated(spark: SparkSession, folder: str) -> DataFrame:
    """Abbreviations of the documents with phrases appended, a third of which hold some."""
    noted = augment.append_phrase(tables.documents(spark, folder), _SHORTENED, 0.5, "short")
    found = abbreviations.abbreviations(noted)
    return found.select("type", "n", "n_period", F.round("score", 4).alias("score"))


_ABBREVIATED = rf"""WITH d AS (SELECT CASE WHEN {ts.uniform(42, 'short')} < 0.5
  THEN text || ' ' || ([{', '.join(ts.q(p) for p in _SHORTENED)}])[floor({ts.uniform(42, 'short:which')} * {len(_SHORTENED)})::INT + 1]
  ELSE text END AS text FROM documents),
w AS (SELECT regexp_replace(unnest({ts.whitespace_words('lower(text)')}), '^["''(\[{{<]+', '') AS w FROM d),
b AS (SELECT regexp_replace(w, '["'')\]}}>,;:!?]+$', '') AS b FROM w),
t AS (SELECT CASE WHEN regexp_matches(b, '\p{{L}}') THEN regexp_replace(b, '\.+$', '') ELSE '' END AS type,
  regexp_matches(b, '[^.]\.$') AS period FROM b),
c AS (SELECT type, count(*) AS n, count(*) FILTER (period) AS n_period FROM t GROUP BY type),
z AS (SELECT *, sum(n_period) OVER () / sum(n) OVER ()::DOUBLE AS p, length(replace(type, '.', ''))::DOUBLE AS letters FROM c),
s AS (SELECT type, n, n_period, letters,
  -2 * ((n_period * ln(greatest(p, 1e-300)) + CASE WHEN n > n_period THEN (n - n_period) * ln(greatest(1 - p, 1e-300)) ELSE 0 END)
    - (n_period * ln(0.99::DOUBLE) + (n - n_period) * ln(1 - 0.99::DOUBLE)))
  * exp(-letters) * (length(type) - letters + 1) * pow(letters, -(n - n_period)::DOUBLE) AS score
  FROM z WHERE n_period > 0 AND type <> '')
SELECT type, n, n_period, round(score, 4) AS score FROM s WHERE score >= 0.3"""


def _sketched(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabularies of languages, united from stored sketches of (language, source), against exact counts."""
    docs = tables.table(spark, folder, "documents").select("lang", "source", "text")
    sketches = stored(lexicon.vocabulary_sketches(docs, "lang", "source"), "sketches")
    united = lexicon.united_vocabulary(sketches, "lang").withColumnRenamed("n_distinct", "_about")
    words = docs.select("lang", F.explode(tk.words(F.col("text"))).alias("token"))
    exact = words.distinct().groupBy("lang").agg(F.count("*").alias("n_distinct"))
    near = F.abs(F.col("_about") - F.col("n_distinct")) <= 0.03 * F.col("n_distinct")
    return united.join(exact, "lang").select("lang", "n_tokens", "n_distinct", near.alias("is_near"))


_SKETCHED = f"""WITH w AS (SELECT lang, unnest({ts.words('lt')}) AS token FROM (SELECT lang, lower(text) AS lt FROM documents))
SELECT lang, count(*) AS n_tokens, count(DISTINCT token) AS n_distinct, true AS is_near FROM w GROUP BY lang"""

_PROFILE = ("text_length", "word_count", *rules.PROFILE_RATIOS, "heuristic_score")
_SQL_FLAGS = """((ai_word_ratio > 0.01)::INT + (sentence_variation < 0.3)::INT
  + (unique_word_ratio < 0.5)::INT + (punctuation_density < 0.01)::INT) / 4.0::DOUBLE"""


def _scored_sql(source: str, carry: str = "doc_id, text") -> str:
    """CTEs ending in ``scored`` with the heuristic prediction."""
    return f"""{ts.features_cte(source, carry=carry)},
    h AS (SELECT *, {_SQL_FLAGS} AS heuristic_score FROM feats),
    scored AS (SELECT *, heuristic_score > 0.5 AS is_ai, 1 - heuristic_score AS human_probability,
      heuristic_score AS ai_probability, heuristic_score AS ai_score FROM h)"""


def _profiled(spark: SparkSession, folder: str) -> DataFrame:
    return rules.add_profile(_marked(tables.documents(spark, folder)))


_SQL_PROFILED = f"""WITH {_scored_sql(_MARKED)},
  profiled AS (SELECT *, length(text)::BIGINT AS text_length, len({ts.words('text')})::BIGINT AS word_count
  FROM scored)"""


def _lexicon_table(spark: SparkSession, folder: str) -> DataFrame:
    """Terms that Spark derives from the tables: the words of the benchmark items."""
    items = tables.table(spark, folder, "benchmark")
    return items.select(F.explode(tk.words(F.col("text"))).alias("term")).distinct()


_LEXICON_JOIN = f"""WITH b AS (SELECT DISTINCT unnest({ts.words('lt')}) AS term
    FROM (SELECT lower(text) AS lt FROM benchmark)),
  w AS (SELECT doc_id, {ts.words('lt')} AS w FROM (SELECT doc_id, lower(text) AS lt FROM documents)),
  e AS (SELECT doc_id, unnest(w) AS term FROM w)
  SELECT w.doc_id, any_value(len(w.w))::BIGINT AS n_tokens, count(b.term) AS hits
  FROM w LEFT JOIN e USING (doc_id) LEFT JOIN b ON e.term = b.term GROUP BY w.doc_id"""


def _calibrated(spark: SparkSession, folder: str) -> DataFrame:
    """Confidence grades on the share of distinct words as a stand-in probability."""
    ratio = lexicon.distinct_ratio(tables.documents(spark, folder))
    p = F.col("ratio")
    given = ratio.select(
        "doc_id", (p > 1 - p).alias("is_ai"), (1 - p).alias("human_probability"),
        p.alias("ai_probability"),
    )
    return _rounded(
        rules.add_calibrated_confidence(given), "doc_id", "is_ai", "uncertainty",
        names=("human_probability", "ai_probability", "decision_margin", "calibrated_confidence"),
    )


_RATIO = f"""SELECT doc_id, len(list_distinct(w)) / greatest(len(w), 1)::DOUBLE AS p, len(w)::BIGINT AS n_tokens,
  len(list_distinct(w))::BIGINT AS n_distinct
  FROM (SELECT doc_id, {ts.words('lt')} AS w FROM (SELECT doc_id, lower(text) AS lt FROM documents))"""


def _append_sql(items: Sequence[str], rate: float, step: str, before: str = " ", after: str = "") -> str:
    chosen = (
        f"([{', '.join(ts.q(i) for i in items)}])"
        f"[floor({ts.uniform(42, step + ':which')} * {len(items)})::INT + 1]"
    )
    return (
        f"CASE WHEN {ts.uniform(42, step)} < {rate} THEN text || {ts.q(before)} || {chosen}"
        f" || {ts.q(after)} ELSE text END"
    )


def _replace_sql(text: str) -> str:
    for old, new in augment.FORMAL_TERMS.items():
        text = f"replace({text}, {ts.q(old)}, {ts.q(new)})"
    return text


def _whole_word_sql(text: str) -> str:
    for old, new in augment.FORMAL_TERMS.items():
        text = f"regexp_replace({text}, '\\b{old}\\b', {ts.q(new)}, 'g')"
    return text


def _noted(df: DataFrame) -> DataFrame:
    return df.withColumn("text", F.concat("text", F.lit(" Use it, because we use good help.")))


_NOTED = "SELECT doc_id, text || ' Use it, because we use good help.' AS text FROM documents"


def _typo_sql() -> str:
    def fraction(start: int) -> str:
        return f"(('0x' || substr(g, {start}, 8))::BIGINT / 4294967296.0::DOUBLE)"

    at = f"(1 + floor({fraction(9)} * (length(p) - 2))::INT)"
    digest = "md5('42:typo:' || doc_id::VARCHAR || ':' || (i - 1)::VARCHAR || ':' || ws[i])"
    word = f"""CASE WHEN g <= lowest AND length(p) >= 5 AND regexp_full_match(p, '\\p{{L}}+')
      AND {fraction(17)} < 0.5
      THEN substr(p, 1, {at} + 1) || substr(p, {at} + 1) ELSE p END"""
    return f"""WITH s AS (SELECT doc_id, text, {ts.whitespace_words('text')} AS ws FROM documents),
    e AS (SELECT doc_id, i, ws[i] AS p, {digest} AS g, greatest(1, len(ws) // 15) AS places
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM s WHERE len(ws) >= 4)),
    n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS rn FROM e),
    l AS (SELECT doc_id, g AS lowest FROM n WHERE rn = places),
    j AS (SELECT doc_id, string_agg({word}, ' ' ORDER BY i) AS text FROM e JOIN l USING (doc_id) GROUP BY doc_id)
    SELECT s.doc_id, md5(coalesce(j.text, s.text)) AS text_md5,
      length(coalesce(j.text, s.text))::BIGINT AS chars FROM s LEFT JOIN j USING (doc_id)"""


def _text_digest(df: DataFrame) -> DataFrame:
    return df.select(
        "doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars")
    )


def _digest_sql(text: str, source: str = "documents") -> str:
    return f"""SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS chars
    FROM (SELECT doc_id, {text} AS text FROM {source})"""


def _class_means(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: features of both sides of a conversation, scored, as means per class."""
    scored = predict_or_heuristic(add_features(tables.chat_corpus(spark, folder)))
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_ai").alias("predicted_ai"),
        *[F.round(F.avg(f), 4).alias(f) for f in (*FEATURES, "ai_score")],
    )


ENTRIES = [
    Entry(
        "flagship_class_means", _class_means,
        f"""WITH {_scored_sql(ts.CHAT, 'doc_id, label')} SELECT label, count(*) AS n,
        count(*) FILTER (is_ai) AS predicted_ai,
        {', '.join(f'round(avg({f}), 4) AS {f}' for f in (*FEATURES, 'ai_score'))}
        FROM scored GROUP BY label""",
    ),
    _per_text("tok1_words", tk.words, ts.words("lt")),
    _per_text("tok2_sentences", tk.sentences, _strip_each(ts.sentences("lt"))),
    _per_text("tok3_clauses", tk.clauses, _strip_each("string_split_regex(lt, '[,;:]')")),
    Entry(
        "tok4_paragraphs",
        lambda spark, d: tables.paragraph_corpus(spark, d).select(
            "doc_id", F.explode(tk.paragraphs(F.col("text"))).alias("p")
        ).select("doc_id", F.md5("p").alias("p_md5"), F.size(tk.whitespace_words(F.col("p"))).cast("bigint").alias("n_words")),
        f"""SELECT doc_id, md5(p) AS p_md5, len({ts.whitespace_words('p')})::BIGINT AS n_words FROM (
          SELECT doc_id, unnest({_strip_each("string_split(lower(text), chr(10) || chr(10))")}) AS p
          FROM ({ts.PARAGRAPHS}))""",
    ),
    Entry(
        "tok5_comma_parts",
        lambda spark, d: tables.documents(spark, d).select(
            "doc_id", F.transform(tk.sentences(F.col("text")), lambda s: F.size(F.split(s, ","))).alias("l")
        ).select("doc_id", F.aggregate("l", F.lit(0), lambda a, x: a + x).cast("bigint").alias("parts"),
                 F.size("l").cast("bigint").alias("n_sentences")),
        f"""SELECT doc_id, coalesce(list_sum(list_transform(s, lambda x: len(string_split(x, ',')))), 0)::BIGINT
        AS parts, len(s)::BIGINT AS n_sentences FROM (
          SELECT doc_id, {ts.sentences('lt')} AS s FROM (SELECT doc_id, lower(text) AS lt FROM documents))""",
    ),
    Entry("fea_feature_table", _feature_query(tables.documents), _feature_sql(ts.DOCS)),
    Entry(
        "fea_long_texts",
        lambda spark, d: _rounded(long_texts.piece_features(long_texts.cut_texts(tables.documents(spark, d), 1000)), "doc_id"),
        f"WITH {ts.features_cte(ts.DOCS)} SELECT {_sql_rounded('doc_id')} FROM feats",
    ),
    Entry("tok2_abbreviations", _abbreviated, _ABBREVIATED),
    Entry("agg12_vocabulary_sketches", _sketched, _SKETCHED),
    Entry("fea_feature_table_chat", _feature_query(tables.chat_corpus), _feature_sql(ts.CHAT)),
    Entry(
        "fea_feature_table_marked",
        _feature_query(lambda spark, d: _marked(tables.documents(spark, d))), _feature_sql(_MARKED),
    ),
    Entry(
        "fea_feature_table_seen_words", _feature_query(tables.documents, **_SEEN_LISTS),
        _feature_sql(ts.DOCS, **_SEEN_LISTS),
    ),
    _one("fea0_unique_word_ratio", ["unique_word_ratio"]),
    _one("fea1_ai_word_ratio", ["ai_word_ratio"]),
    _one("fea2_sentence_variation", ["sentence_variation"]),
    _one("fea3_avg_word_length", ["avg_word_length"]),
    _one("fea4_punctuation_density", ["punctuation_density"]),
    _one("fea5_conjunction_ratio", ["conjunction_ratio"]),
    Entry(
        "fea6_paragraph_variation",
        lambda spark, d: _rounded(add_features(tables.paragraph_corpus(spark, d)), "doc_id", names=["paragraph_variation"]),
        f"WITH {ts.features_cte(ts.PARAGRAPHS)} SELECT {_sql_rounded('doc_id', names=['paragraph_variation'])} FROM feats",
    ),
    _one("fea7_readability", ["readability"]),
    _one("fea8_burstiness", ["burstiness"]),
    _one("fea9_transition_density", ["transition_density"]),
    _one("fea10_avg_clause_length", ["avg_clause_length"]),
    _one("fea11_lexical_diversity", ["lexical_diversity"]),
    _one("fea12_pronoun_ratio", ["pronoun_ratio"]),
    _one("fea13_contraction_ratio", ["contraction_ratio"]),
    _one("fea14_passive_ratio", ["passive_ratio"]),
    Entry(
        "jn1_lexicon_hits",
        lambda spark, d: lexicon.lexicon_hits(tables.documents(spark, d), _SEEN).select(
            "doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"), F.col("hits").cast("bigint").alias("hits")
        ),
        f"""SELECT doc_id, len(w)::BIGINT AS n_tokens, {ts.members(_SEEN)}::BIGINT AS hits FROM (
          SELECT doc_id, {ts.words('lt')} AS w FROM (SELECT doc_id, lower(text) AS lt FROM documents))""",
    ),
    Entry(
        "jn1_lexicon_join_broadcast",
        lambda spark, d: lexicon.lexicon_hits_join(tables.documents(spark, d), _lexicon_table(spark, d)),
        _LEXICON_JOIN,
    ),
    Entry(
        "jn1_lexicon_join_shuffled",
        lambda spark, d: lexicon.lexicon_hits_join(
            tables.documents(spark, d), _lexicon_table(spark, d), broadcast_terms=0
        ),
        _LEXICON_JOIN,
    ),
    Entry(
        "agg12_distinct_ratio",
        lambda spark, d: lexicon.distinct_ratio(tables.documents(spark, d)).select(
            "doc_id", F.col("n_distinct").cast("bigint").alias("n_distinct"),
            F.col("n_tokens").cast("bigint").alias("n_tokens"), F.round("ratio", 6).alias("ratio"),
        ),
        f"SELECT doc_id, n_distinct, n_tokens, round(p, 6) AS ratio FROM ({_RATIO})",
    ),
    Entry(
        "agg12_vocabulary",
        lambda spark, d: lexicon.vocabulary(tables.documents(spark, d)),
        f"""SELECT count(DISTINCT t) AS n_distinct, count(*) AS n_tokens FROM (
          SELECT unnest({ts.words('lt')}) AS t FROM (SELECT lower(text) AS lt FROM documents))""",
    ),
    Entry(
        "agg13_token_counts",
        lambda spark, d: lexicon.token_counts(tables.documents(spark, d)),
        f"""SELECT doc_id, token, count(*) AS n FROM (
          SELECT doc_id, unnest({ts.words('lt')}) AS token
          FROM (SELECT doc_id, lower(text) AS lt FROM documents)) GROUP BY ALL""",
    ),
    Entry(
        "win3_adjacent_pairs",
        lambda spark, d: lexicon.adjacent_pairs(_marked(tables.documents(spark, d))).select(
            "doc_id", F.col("pairs").cast("bigint").alias("pairs")
        ),
        f"""WITH e AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS i FROM (
            SELECT doc_id, {ts.words('lt')} AS w FROM (SELECT doc_id, lower(text) AS lt FROM ({_MARKED})))),
          p AS (SELECT doc_id, t, lead(t) OVER (PARTITION BY doc_id ORDER BY i) AS u FROM e)
          SELECT d.doc_id, count(p.t) AS pairs FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id
          AND t IN {ts.in_list(lx.BE_FORMS)} AND ends_with(u, 'ed') GROUP BY d.doc_id""",
    ),
    Entry(
        "scl1_text_profile",
        lambda spark, d: _rounded(
            _profiled(spark, d), "doc_id", F.col("text_length").cast("bigint").alias("text_length"),
            F.col("word_count").cast("bigint").alias("word_count"), names=_PROFILE[2:],
        ),
        f"{_SQL_PROFILED} SELECT {_sql_rounded('doc_id', 'text_length', 'word_count', names=_PROFILE[2:])} FROM profiled",
    ),
    Entry(
        "scl2_heuristic_score",
        lambda spark, d: add_features(_marked(tables.documents(spark, d))).select(
            "doc_id", rules.heuristic_score().alias("heuristic_score")
        ),
        f"WITH {_scored_sql(_MARKED)} SELECT doc_id, heuristic_score FROM scored",
    ),
    Entry(
        "scl3_heuristic_class",
        lambda spark, d: rules.add_heuristic_class(add_features(_marked(tables.documents(spark, d)))).select(
            "doc_id", "is_ai", "human_probability", "ai_probability", "ai_score"
        ),
        f"""WITH {_scored_sql(_MARKED)} SELECT doc_id, is_ai, human_probability, ai_probability, ai_score
        FROM scored""",
    ),
    Entry(
        "scl4_interpretation",
        lambda spark, d: add_features(_marked(tables.documents(spark, d))).select(
            "doc_id", F.array_join(rules.interpretation(), "; ").alias("messages")
        ),
        f"""WITH {_scored_sql(_MARKED)} SELECT doc_id, concat_ws('; ',
          CASE WHEN ai_word_ratio > 0.01 THEN 'High AI word usage detected' END,
          CASE WHEN sentence_variation < 0.3 THEN 'Low sentence length variation (common in AI text)' END,
          CASE WHEN unique_word_ratio < 0.5 THEN 'High word repetition detected' END) AS messages FROM scored""",
    ),
    Entry(
        "scl5_calibrated_confidence", _calibrated,
        f"""SELECT doc_id, p > 1 - p AS is_ai, round(1 - p, 6) AS human_probability, round(p, 6) AS ai_probability,
        round(abs(p - (1 - p)), 6) AS decision_margin,
        CASE WHEN abs(p - (1 - p)) < 0.2::DOUBLE THEN 'HIGH' WHEN abs(p - (1 - p)) < 0.4::DOUBLE THEN 'MEDIUM'
          ELSE 'LOW' END AS uncertainty,
        round(greatest(p, 1 - p) * CASE WHEN abs(p - (1 - p)) < 0.2::DOUBLE THEN 0.8::DOUBLE
          WHEN abs(p - (1 - p)) < 0.4::DOUBLE THEN 0.9::DOUBLE ELSE 1 END, 6) AS calibrated_confidence
        FROM ({_RATIO})""",
    ),
    Entry(
        "scl6_combined_analysis",
        lambda spark, d: score.combined_analysis(_marked(tables.documents(spark, d))).select(
            "doc_id", "prediction", "confidence", "ai_probability", "human_probability",
            F.col("detailed_analysis.word_count").cast("bigint").alias("word_count"),
            F.round("detailed_analysis.avg_word_length", 6).alias("avg_word_length"),
            F.col("detailed_analysis.heuristic_score").alias("heuristic_score"),
        ),
        f"""{_SQL_PROFILED} SELECT doc_id,
        CASE WHEN is_ai THEN 'AI-Generated' ELSE 'Human-Written' END AS prediction,
        greatest(human_probability, ai_probability) AS confidence, ai_probability, human_probability,
        word_count, round(avg_word_length, 6) AS avg_word_length, heuristic_score FROM profiled""",
    ),
    Entry(
        "prj6_decode_label",
        lambda spark, d: score.batch_predict(_marked(tables.documents(spark, d))),
        f"""WITH {_scored_sql(_MARKED)} SELECT doc_id,
        CASE WHEN length(text) > 50 THEN substr(text, 1, 50) || '...' ELSE text END AS text,
        CASE WHEN is_ai THEN 'AI' ELSE 'Human' END AS prediction, ai_probability
        FROM scored WHERE length({ts.strip('text')}) >= 1""",
    ),
    Entry(
        "agg9_batch_summary",
        lambda spark, d: evaluate.prediction_summary(
            score.score_texts(_marked(tables.documents(spark, d)), at_least=1)
        ),
        f"""WITH {_scored_sql(_MARKED)} SELECT count(*) AS total, count(*) FILTER (is_ai) AS predicted_ai,
        count(*) FILTER (NOT is_ai) AS predicted_human,
        count(*) FILTER (is_ai) / count(*)::DOUBLE AS ai_share,
        count(*) FILTER (NOT is_ai) / count(*)::DOUBLE AS human_share
        FROM scored WHERE length({ts.strip('text')}) >= 1""",
    ),
    Entry(
        "agg11_scoring_rate",
        lambda spark, d: score.scoring_rate(tables.documents(spark, d)).select(
            "rows", (F.col("ms_per_text") > 0).alias("measured")
        ),
        f"SELECT count(*) AS rows, true AS measured FROM documents WHERE length({ts.strip('text')}) >= 10",
    ),
    Entry(
        "mod6_predict_or_heuristic",
        lambda spark, d: score.score_texts(tables.chat_corpus(spark, d).select("doc_id", "text")).drop("text"),
        f"""WITH {_scored_sql(ts.CHAT)} SELECT doc_id, is_ai, human_probability, ai_probability, ai_score
        FROM scored WHERE length({ts.strip('text')}) >= 10""",
    ),
    Entry(
        "aug1_substitute_terms",
        lambda spark, d: _text_digest(augment.substitute_terms(_noted(tables.documents(spark, d)))),
        _digest_sql(_replace_sql("text"), f"({_NOTED})"),
    ),
    Entry(
        "aug1_substitute_whole_words",
        lambda spark, d: _text_digest(
            augment.substitute_terms(_noted(tables.documents(spark, d)), whole_word=True)
        ),
        _digest_sql(_whole_word_sql("text"), f"({_NOTED})"),
    ),
    Entry(
        "aug2_append_phrase",
        lambda spark, d: _text_digest(
            augment.append_transition(tables.documents(spark, d), "more work is needed.")
        ),
        _digest_sql(_append_sql(
            augment.TRANSITION_STARTS, augment.TRANSITION_RATE, "transition", after=" more work is needed."
        )),
    ),
    Entry(
        "aug2_append_keyword_and_doubt",
        lambda spark, d: _text_digest(augment.append_doubt(
            augment.append_keyword(tables.documents(spark, d), "Here a", "counts.")
        )),
        f"""SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS chars FROM (
          SELECT doc_id, {_append_sql((augment.DOUBT,), augment.DOUBT_RATE, 'doubt', before='')} AS text FROM (
          SELECT doc_id, {_append_sql(augment.KEYWORDS, augment.AI_KEYWORD_RATE, 'keyword', ' Here a ', ' counts.')}
          AS text FROM documents))""",
    ),
    Entry(
        "aug2_append_clause_and_closing",
        lambda spark, d: _text_digest(augment.append_closing(augment.append_clause(tables.documents(spark, d)))),
        f"""SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS chars FROM (
          SELECT doc_id, {_append_sql((augment.LIGHT_TOUCH,), augment.CLOSING_RATE, 'touch')} AS text FROM (
          SELECT doc_id, {_append_sql(augment.CLOSINGS, 1.0, 'closing')} AS text FROM (
          SELECT doc_id, {_append_sql(augment.CLAUSES, augment.CLAUSE_RATE, 'clause')} AS text FROM documents)))""",
    ),
    Entry(
        "aug3_append_noise",
        lambda spark, d: _text_digest(augment.append_noise(tables.documents(spark, d))),
        f"""SELECT doc_id, md5(text) AS text_md5, length(text)::BIGINT AS chars FROM (
          SELECT doc_id, {_append_sql(augment.ENDINGS, augment.ENDING_RATE, 'ending', before='')} AS text FROM (
          SELECT doc_id, {_append_sql(augment.EMOJIS, augment.EMOJI_RATE, 'emoji')} AS text FROM (
          SELECT doc_id, {_append_sql(augment.SLANG, augment.SLANG_RATE, 'slang')} AS text FROM documents)))""",
    ),
    Entry(
        "aug3_stretch_periods",
        lambda spark, d: _text_digest(augment.stretch_periods(tables.documents(spark, d))),
        _digest_sql(f"CASE WHEN {ts.uniform(42, 'dots')} < 0.2 THEN replace(text, '.', '...') ELSE text END"),
    ),
    Entry(
        "aug4_inject_typos",
        lambda spark, d: _text_digest(augment.inject_typos(tables.documents(spark, d))),
        _typo_sql(),
    ),
]
