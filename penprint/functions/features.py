"""The fifteen stylometric features, one double column each.

The columns are laid out in three projections so that the optimizer keeps every tokenizer pass once:
a column that several later columns read is not inlined. Only the per-sentence and per-paragraph
moments need array lambdas; they fold over sentences, not tokens, and capture nothing from outside.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import lexicons as lx
from penprint.functions import tokens as tk

FEATURES = (
    "unique_word_ratio",
    "ai_word_ratio",
    "sentence_variation",
    "avg_word_length",
    "punctuation_density",
    "conjunction_ratio",
    "paragraph_variation",
    "readability",
    "burstiness",
    "transition_density",
    "avg_clause_length",
    "lexical_diversity",
    "pronoun_ratio",
    "contraction_ratio",
    "passive_ratio",
)

# Caps and lengths that must equal the reference's.
PARAGRAPH_CAP = 10.0
CLAUSE_CAP = 20.0
LONG_WORD = 7

# Each hit runs on to the end of its token, so a token counts once.
_CONTRACTION = rf"'(?:(?<=n')t|re|ve|ll|d|m|s){tk.TOKEN}*+"

# Read on a line whose only blanks are spaces, with one at either end.
_ALPHA = r" ([a-z]++(?= )|\p{L}++(?= ))"


def moments(values: Column) -> Column:
    """Count, mean and summed squared deviation of an array of doubles, in one stable pass."""
    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(acc: Column, x: Column) -> Column:
        n = acc["n"] + 1.0
        delta = x - acc["mean"]
        mean = acc["mean"] + delta / n
        return F.struct(n.alias("n"), mean.alias("mean"), (acc["m2"] + delta * (x - mean)).alias("m2"))

    return F.aggregate(values, zero, step)


def population_std(m: Column) -> Column:
    return F.when(m["n"] > 0, F.sqrt(m["m2"] / F.greatest(m["n"], F.lit(1.0)))).otherwise(0.0)


def _variation(m: Column) -> Column:
    """Spread relative to the mean; zero for fewer than two values."""
    spread = population_std(m) / F.greatest(m["mean"], F.lit(1.0))
    return F.when(m["n"] > 1, spread).otherwise(0.0)


def members_of(hits: Column, terms: Sequence[str]) -> Column:
    return F.size(F.filter(hits, lambda t: t.isin(*terms)))


def tokenised(
    df: DataFrame, text: str, sentences_in_clauses: bool = True, abbreviations: Sequence[str] = (), starters: Sequence[str] = ()
) -> DataFrame:
    """Add the forms of a text that everything is counted on: ``_t_text`` in lower case, ``_t_spaced`` and ``_t_even``
    with marks between sentences, ``_t_clauses`` with marks between clauses, and ``_t_line`` without marks."""
    col = F.col
    lowered = df.withColumn("_t_text", F.lower(F.coalesce(col(text), F.lit(""))))
    marked = lowered.withColumn("_t_marked", tk.mark_sentences(col("_t_text"), abbreviations, starters))
    clause_source = col("_t_marked" if sentences_in_clauses else "_t_text")
    punctuated = marked.withColumns({
        "_t_word_part": tk.space_punctuation(col("_t_marked")),
        "_t_clause_part": tk.space_punctuation(tk.mark_clauses(clause_source)),
    })
    spaced = punctuated.withColumns({
        "_t_spaced": tk.space_clitics(col("_t_text"), col("_t_word_part")),
        "_t_clauses": tk.space_clitics(col("_t_text"), col("_t_clause_part")),
    })
    even = spaced.withColumn("_t_even", tk.even_blanks(col("_t_spaced"), marks=""))
    return even.withColumn("_t_line", F.concat(
        F.lit(" "), F.replace(col("_t_even"), F.lit(tk.SENTENCE), F.lit(" ")), F.lit(" ")
    ))


def alpha_words() -> Column:
    """The tokens of letters only."""
    return F.regexp_extract_all("_t_line", F.lit(_ALPHA), F.lit(1))


def contractions() -> Column:
    spaced = F.col("_t_spaced")
    return F.when(F.contains(spaced, F.lit("'")), F.regexp_count(spaced, F.lit(_CONTRACTION))).otherwise(0)


def commas(sentence: Column) -> Column:
    return F.length(sentence) - F.length(F.replace(sentence, F.lit(","), F.lit("")))


def formulas(part: Callable[[str], Column]) -> dict[str, Column]:
    """The fifteen features from a text's counts: ``n`` tokens (``distinct``, ``long``, in word lists), letters-only
    tokens and their characters, ``chars``, ``punctuation``, ``contractions``, ``passives``, sentences ``ns``, clauses,
    and the moments of sentences, of tokens by comma part, and of paragraphs."""
    n = F.greatest(part("n"), F.lit(1)).cast("double")
    unique = part("distinct") / n
    return {
        "unique_word_ratio": unique,
        "ai_word_ratio": part("ai") / n,
        "sentence_variation": _variation(part("sentence_m")),
        "avg_word_length": F.when(part("alpha_n") > 0, part("alpha_chars") / F.greatest(part("alpha_n"), F.lit(1))).otherwise(0.0),
        "punctuation_density": part("punctuation") / F.greatest(part("chars"), F.lit(1)),
        "conjunction_ratio": part("conjunctions") / n,
        "paragraph_variation": F.coalesce(F.least(population_std(part("paragraph_m")), F.lit(PARAGRAPH_CAP)), F.lit(0.0)),
        "readability": part("long") / n,
        "burstiness": _variation(part("burst_m")),
        "transition_density": part("transitions") / n,
        "avg_clause_length": F.when(
            part("clause_count") > 0,
            F.least(part("clause_tokens") / F.greatest(part("clause_count"), F.lit(1)), F.lit(CLAUSE_CAP)),
        ).otherwise(0.0),
        "lexical_diversity": unique,
        "pronoun_ratio": part("pronouns") / n,
        "contraction_ratio": part("contractions") / n,
        "passive_ratio": part("passives") / F.greatest(part("ns"), F.lit(1)),
    }


def add_features(
    df: DataFrame,
    text: str = "text",
    *,
    ai_words: Sequence[str] = lx.AI_WORDS,
    conjunctions: Sequence[str] = lx.CONJUNCTIONS,
    transitions: Sequence[str] = lx.TRANSITIONS,
    pronouns: Sequence[str] = lx.PRONOUNS,
    be_forms: Sequence[str] = lx.BE_FORMS,
    sentences_in_clauses: bool = True,
    abbreviations: Sequence[str] = (),
    starters: Sequence[str] = (),
    keep_counts: bool = False,
) -> DataFrame:
    """Add the fifteen features of ``text`` to every row. Narrow: no shuffle, no Python.

    ``abbreviations`` and ``starters`` as learned from a corpus (``operators.abbreviations``) tell where periods end
    no sentence. ``keep_counts`` also keeps ``n_tokens`` and ``n_sentences``.
    """
    counted = sorted({*ai_words, *conjunctions, *transitions, *pronouns})
    col = F.col
    lines = tokenised(df, text, sentences_in_clauses, abbreviations, starters)

    line = col("_t_line")
    measured = lines.withColumns({
        "_t_words": tk.split_even(line),
        "_t_alpha": alpha_words(),
        "_t_contractions": contractions(),
        "_t_passives": F.regexp_count(line, F.lit(tk.pair_pattern(be_forms, "ed"))),
        "_t_sentences": F.filter(
            F.transform(
                F.split(col("_t_even"), tk.SENTENCE),
                lambda s: F.struct(
                    F.size(tk.split_even(s)).cast("double").alias("tokens"),
                    (commas(s) + 1).cast("double").alias("comma_parts"),
                ),
            ),
            lambda s: s["tokens"] > 0,
        ),
        "_t_paragraph_words": F.when(
            F.contains(col("_t_text"), F.lit("\n\n")),
            F.filter(
                F.transform(
                    F.split(col("_t_text"), "\n\n"),
                    lambda p: F.size(tk.whitespace_words(p)).cast("double"),
                ),
                lambda n: n > 0,
            ),
        ),
        "_t_clause_tokens": tk.token_count(col("_t_clauses")),
        "_t_clause_count": tk.clause_count(col("_t_clauses")),
        "_t_chars": F.length(col("_t_text")),
        "_t_punctuation": F.regexp_count(col("_t_text"), F.lit(f"[{lx.PUNCTUATION}]")),
    })

    folded = measured.withColumns({
        "_t_n": F.size(col("_t_words")),
        "_t_distinct": F.size(F.array_distinct(col("_t_words"))),
        "_t_hits": F.filter(col("_t_words"), lambda t: t.isin(*counted)),
        "_t_long": F.size(F.filter(col("_t_words"), lambda t: F.length(t) >= LONG_WORD)),
        "_t_alpha_n": F.size(col("_t_alpha")),
        "_t_alpha_chars": F.length(F.array_join(col("_t_alpha"), "")),
        "_t_ns": F.size(col("_t_sentences")),
        "_t_sentence_m": moments(F.transform(col("_t_sentences"), lambda s: s["tokens"])),
        "_t_burst_m": moments(
            F.transform(col("_t_sentences"), lambda s: s["tokens"] / s["comma_parts"])
        ),
        "_t_paragraph_m": moments(col("_t_paragraph_words")),
    })

    members = {
        name: members_of(col("_t_hits"), terms)
        for name, terms in (("ai", ai_words), ("conjunctions", conjunctions), ("transitions", transitions), ("pronouns", pronouns))
    }
    out = formulas(lambda name: members[name] if name in members else col(f"_t_{name}"))
    counts = {"n_tokens": col("_t_n"), "n_sentences": col("_t_ns")} if keep_counts else {}
    return folded.select(
        *[F.col(c) for c in df.columns],
        *[c.alias(name) for name, c in counts.items()],
        *[c.cast("double").alias(name) for name, c in out.items()],
    )
