"""Abbreviations and sentence starters of a corpus, found from its own counts.

A period after a word is either part of the word, as in "dr." or "e.g.", or a sentence's end. Words that hardly ever
stand without one are abbreviations: for every word type the likelihood of its counts with and without a period, if
periods followed it as they follow any word, is compared with that if it always had one (Kiss and Strunk, 2006). Long
words score less, inner periods more, and every occurrence without a period weighs against. A word that follows sentence
ends more often than chance allows is a starter (Dunning's log likelihood ratio): before it a sentence may also end
with an abbreviation.

Both are a few counts for each word type, combined on the map side; a word of any frequency costs a task one row. The
tables go to ``tokens.mark_sentences`` as lists of at most ``MOST`` words, highest scores first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import tokens as tk
from penprint.session import stored

ABBREVIATION_SCORE = 0.3
STARTER_SCORE = 30.0
#: Words of each list that are sent to the tasks.
MOST = 20_000
_ALWAYS = 0.99


@dataclass(frozen=True)
class SentenceModel:
    abbreviations: tuple[str, ...]
    starters: tuple[str, ...]


def _tokens(df: DataFrame, text: str) -> DataFrame:
    """``type, period, ends, following``: words in lower case without their punctuation; whether a single period follows
    directly, whether they may end a sentence, and the type of the next word of the text."""
    words = F.expr("transform(_words, w -> struct(regexp_replace(w, '^[\"\\'(\\\\[{<]+', '') as w))")
    listed = df.select(tk.whitespace_words(F.lower(F.col(text))).alias("_words")).select(words.alias("_words"))
    bare = "regexp_replace(x.w, '[\"\\')\\\\]}>,;:!?]+$', '')"
    parsed = listed.select(F.expr(f"""transform(_words, x -> named_struct(
        'type', regexp_replace({bare}, '\\\\.+$', ''),
        'period', {bare} rlike '[^.]\\\\.$',
        'ends', x.w rlike '[.!?][\"\\')\\\\]]*$'))""").alias("t"))
    last = "array(cast(null as struct<type: string, period: boolean, ends: boolean>))"
    following = F.expr(f"zip_with(t, slice(concat(slice(t, 2, size(t)), {last}), 1, size(t)), "
                       "(a, b) -> named_struct('type', a.type, 'period', a.period, 'ends', a.ends, 'following', b.type))")
    return parsed.select(F.explode(following).alias("x")).select("x.*")


def type_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``type, n, n_period`` of every word type with a letter, and of all others together under the empty type."""
    typed = F.when(F.col("type").rlike(r"\p{L}"), F.col("type")).otherwise("")
    return _tokens(df, text).groupBy(typed.alias("type")).agg(
        F.count("*").alias("n"), F.count_if("period").alias("n_period")
    )


def _ratio(hits: Column, of: Column, p: Column) -> Column:
    """Log likelihood of so many hits at probability ``p``; certain outcomes have none."""
    def term(n: Column, q: Column) -> Column:
        return F.when(n > 0, n * F.log(F.greatest(q, F.lit(1e-300)))).otherwise(0.0)

    return term(hits, p) + term(of - hits, 1 - p)


def abbreviations(df: DataFrame, text: str = "text", least: float = ABBREVIATION_SCORE) -> DataFrame:
    """``type, n, n_period, score`` of the abbreviations; types are written without their last period."""
    return _abbreviations(stored(type_counts(df, text), "types"), least)


def _abbreviations(counts: DataFrame, least: float) -> DataFrame:
    total = counts.agg(F.sum("n").alias("n"), F.sum("n_period").alias("p")).first()
    n, c = F.col("n").cast("double"), F.col("n_period").cast("double")
    p = F.lit((total["p"] or 0) / max(total["n"] or 0, 1))
    likelihood = -2 * (_ratio(c, n, p) - _ratio(c, n, F.lit(_ALWAYS)))
    letters = F.length(F.replace("type", F.lit("."), F.lit(""))).cast("double")
    periods = F.length("type") - letters + 1
    score = likelihood * F.exp(-letters) * periods * F.pow(letters, -(n - c))
    return counts.where("n_period > 0 and type <> ''").withColumn("score", score).where(F.col("score") >= least)


def sentence_starters(df: DataFrame, shortened: DataFrame, text: str = "text", least: float = STARTER_SCORE) -> DataFrame:
    """``type, n, n_after, score`` of words that begin sentences, given the abbreviations that don't end any."""
    return _starters(df, stored(type_counts(df, text), "types"), shortened, text, least)


def _starters(df: DataFrame, counts: DataFrame, shortened: DataFrame, text: str, least: float) -> DataFrame:
    ended = _tokens(df, text).where("ends and following is not null")
    pairs = ended.groupBy(F.when(F.col("period"), F.col("type")).alias("before"), "following").agg(F.count("*").alias("m"))
    breaks = pairs.join(shortened.select(F.col("type").alias("before")), "before", "left_anti")
    after = stored(breaks.groupBy(F.col("following").alias("type")).agg(F.sum("m").alias("n_after")), "after")
    n_breaks = float(after.agg(F.coalesce(F.sum("n_after"), F.lit(0))).first()[0])
    n_all = float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    n, m = F.col("n").cast("double"), F.col("n_after").cast("double")
    a, everything = F.lit(max(n_breaks, 1.0)), F.lit(max(n_all, 1.0))
    rest = F.greatest(everything - a, F.lit(1.0))
    score = -2 * (
        _ratio(m, a, n / everything) + _ratio(n - m, rest, n / everything) - _ratio(m, a, m / a) - _ratio(n - m, rest, (n - m) / rest)
    )
    typed = counts.where("type <> ''").join(after, "type").withColumn("score", score)
    return typed.where((F.col("score") >= least) & (m / a > n / everything)).select("type", "n", "n_after", "score")


def learn_sentences(
    df: DataFrame, text: str = "text", least: float = ABBREVIATION_SCORE, least_starter: float = STARTER_SCORE, most: int = MOST
) -> SentenceModel:
    """Both lists of a corpus, for the tokenizer."""
    counts = stored(type_counts(df, text), "types")
    shortened = stored(_abbreviations(counts, least), "abbreviations")
    starters = _starters(df, counts, shortened, text, least_starter)

    def listed(table: DataFrame) -> tuple[str, ...]:
        return tuple(sorted(r["type"] for r in table.orderBy(F.desc("score"), "type").limit(most).collect()))

    return SentenceModel(listed(shortened), listed(starters))
