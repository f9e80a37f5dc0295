"""Perturbations of a corpus, to test how robust a detector is.

Every random choice is a hash of seed, step and row id, so a run can be repeated row by row. All
operators are narrow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.functions import tokens as tk
from penprint.functions.keys import pick, uniform

# --- Fixed values: terms and rates that must equal the reference's. ---

FORMAL_TERMS = {
    "use": "utilize",
    "make": "create",
    "help": "facilitate",
    "show": "demonstrate",
    "good": "effective",
    "bad": "ineffective",
}
# The longer generator has no entry for good and bad, and another word for make.
FORMAL_TERMS_SHORT = {
    "use": "utilize",
    "make": "fabricate",
    "help": "facilitate",
    "show": "demonstrate",
}
KEYWORDS = (
    "framework", "underlying", "in this context", "robust", "comprehensive", "significant",
    "insight", "perspective", "dimension", "dynamic",
)
TRANSITION_STARTS = ("Furthermore,", "Moreover,", "Consequently,", "Therefore,")
SLANG = ("lol", "tbh", "idk", "kinda", "sort of", "btw", "ngl", "omg", "haha", "lmao")
EMOJIS = ("😂", "😅", "🙂", "🙃", "🥲", "🤦‍♂️", "🤷‍♀️")
ENDINGS = ("...", "?!", "!!!")
CLAUSES = (
    "Honestly, it got stuck in my head the whole day.",
    "It sounds small but it really threw off my mood.",
    "I know it shouldn't bother me this much but it does.",
    "Maybe I'm overthinking it, but still.",
)
CLOSINGS = (
    "Overall, there is no single right answer, but paying attention to context usually helps.",
    "In practice, small consistent habits matter more than any one big decision.",
    "So the real challenge is balancing convenience, long-term impact and personal values.",
    "Ultimately, the best approach depends on individual goals and constraints.",
)
LIGHT_TOUCH = "In practice, it doesn't always work out as neatly as it sounds."
HUMAN_KEYWORD_WORDS = ("From my perspective the", "of the whole thing is how people adapt over time.")
AI_KEYWORD_WORDS = ("In this context, a simple", "can help people reason about trade-offs without getting lost in details.")
DOUBT = " I think."
SLANG_RATE, EMOJI_RATE, ENDING_RATE, DOTS_RATE, DOUBT_RATE = 0.5, 0.35, 0.4, 0.2, 0.3
CLAUSE_RATE, TRANSITION_RATE, CLOSING_RATE = 0.5, 0.5, 0.3
HUMAN_KEYWORD_RATE, AI_KEYWORD_RATE = 0.25, 0.6
TYPO_MIN_WORDS, TYPO_WORDS_PER_PLACE, TYPO_MIN_LENGTH, TYPO_RATE = 4, 15, 5, 0.5

# --- End of fixed values. ---


def substitute_terms(
    df: DataFrame, terms: Mapping[str, str] = FORMAL_TERMS, whole_word: bool = False
) -> DataFrame:
    """Replace terms one after the other, also inside words unless ``whole_word`` is set."""
    text = F.col("text")
    for old, new in terms.items():
        if whole_word:
            # Quoted, and bounded by what is no word character: terms may end in signs.
            quoted = "\\Q" + old.replace("\\E", "\\E\\\\E\\Q") + "\\E"
            literal = new.replace("\\", "\\\\").replace("$", "\\$")
            text = F.regexp_replace(text, rf"(?<!\w){quoted}(?!\w)", literal)
        else:
            text = F.replace(text, F.lit(old), F.lit(new))
    return df.withColumn("text", text)


def append_phrase(
    df: DataFrame,
    phrases: Sequence[str],
    rate: float,
    step: str,
    seed: int = 42,
    id_col: str = "doc_id",
    before: str = " ",
    after: str = "",
) -> DataFrame:
    """With probability ``rate`` append one of ``phrases``, between ``before`` and ``after``."""
    chosen = pick(list(phrases), uniform(seed, f"{step}:which", id_col))
    longer = F.concat(F.col("text"), F.lit(before), chosen, F.lit(after))
    hit = uniform(seed, step, id_col) < rate
    return df.withColumn("text", F.when(hit, longer).otherwise(F.col("text")))


def append_doubt(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    return append_phrase(df, (DOUBT,), DOUBT_RATE, "doubt", seed, id_col, before="")


def append_transition(
    df: DataFrame, clause: str, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """A transition word and the given clause."""
    return append_phrase(
        df, TRANSITION_STARTS, TRANSITION_RATE, "transition", seed, id_col, after=f" {clause}"
    )


def append_keyword(
    df: DataFrame, before: str, after: str, rate: float = AI_KEYWORD_RATE, seed: int = 42,
    id_col: str = "doc_id",
) -> DataFrame:
    """A keyword inside the given words."""
    return append_phrase(df, KEYWORDS, rate, "keyword", seed, id_col, f" {before} ", f" {after}")


def append_clause(df: DataFrame, clauses: Sequence[str] = CLAUSES, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """An emotional clause, for half of the texts."""
    return append_phrase(df, clauses, CLAUSE_RATE, "clause", seed, id_col)


def append_closing(df: DataFrame, closings: Sequence[str] = CLOSINGS, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """A closing sentence for every text, and a light informal touch after some."""
    closed = append_phrase(df, closings, 1.0, "closing", seed, id_col)
    return append_phrase(closed, (LIGHT_TOUCH,), CLOSING_RATE, "touch", seed, id_col)


def humanize(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """The steps for texts of class 0: a clause, now and then a keyword, noise, stretched periods and typos."""
    longer = append_keyword(append_clause(df, seed=seed, id_col=id_col), *HUMAN_KEYWORD_WORDS, HUMAN_KEYWORD_RATE, seed, id_col)
    return inject_typos(stretch_periods(append_noise(longer, seed, id_col), seed=seed, id_col=id_col), seed=seed, id_col=id_col)


def formalize(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """The steps for texts of class 1: formal terms, a closing, and often a keyword."""
    closed = append_closing(substitute_terms(df, FORMAL_TERMS_SHORT, whole_word=True), seed=seed, id_col=id_col)
    return append_keyword(closed, *AI_KEYWORD_WORDS, AI_KEYWORD_RATE, seed, id_col)


def append_noise(df: DataFrame, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """Slang, an emoji and repeated end punctuation, each at its own rate."""
    noisy = append_phrase(df, SLANG, SLANG_RATE, "slang", seed, id_col)
    noisy = append_phrase(noisy, EMOJIS, EMOJI_RATE, "emoji", seed, id_col)
    return append_phrase(noisy, ENDINGS, ENDING_RATE, "ending", seed, id_col, before="")


def stretch_periods(
    df: DataFrame, rate: float = DOTS_RATE, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """With probability ``rate`` turn every period into three."""
    hit = uniform(seed, "dots", id_col) < rate
    dotted = F.replace(F.col("text"), F.lit("."), F.lit("..."))
    return df.withColumn("text", F.when(hit, dotted).otherwise(F.col("text")))


def _let(value: Column, body) -> Column:
    """Bind a value once, so that a lambda inside ``body`` does not compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def inject_typos(
    df: DataFrame, rate: float = TYPO_RATE, seed: int = 42, id_col: str = "doc_id"
) -> DataFrame:
    """Double an inner letter of some words.

    One place in fifteen words (at least one) is drawn without repetition: the places with the lowest
    hash numbers, found by sorting one number per word inside the row. A drawn word changes at
    ``rate``, and only if it is all letters and longer than four. Texts under four words stay as they
    are; white space collapses in the others.
    """
    def number(step: str, word: Column, i: Column) -> Column:
        parts = F.concat_ws(
            ":", F.lit(str(seed)), F.lit(step), F.col(id_col).cast("string"), i.cast("string"), word
        )
        return F.md5(parts)

    def fraction(digest: Column, start: int) -> Column:
        return F.conv(F.substring(digest, start, 8), 16, 10).cast("double") / F.lit(float(16**8))

    def doubled(word: Column, digest: Column) -> Column:
        # Zero-based position 1 to length - 2.
        at = 1 + F.floor(fraction(digest, 9) * (F.length(word) - 2)).cast("int")
        return F.concat(
            word.substr(F.lit(1), at + 1),
            word.substr(at + 1, F.length(word) - at),
        )

    def changed(pair: Column, threshold: Column) -> Column:
        word, digest = pair["word"], pair["digest"]
        ok = (
            (digest <= threshold)
            & (F.length(word) >= TYPO_MIN_LENGTH)
            & word.rlike(r"^\p{L}+$")
            & (fraction(digest, 17) < rate)
        )
        return F.when(ok, doubled(word, digest)).otherwise(word)

    split = df.withColumn("_words", tk.whitespace_words(F.col("text")))
    numbered = split.withColumn("_pairs", F.transform(
        "_words", lambda w, i: F.struct(w.alias("word"), number("typo", w, i).alias("digest"))
    ))
    size = F.size("_words")
    places = F.greatest(F.lit(1), F.floor(size / TYPO_WORDS_PER_PLACE).cast("int"))
    lowest = F.get(F.array_sort(F.transform("_pairs", lambda p: p["digest"])), places - 1)
    rewritten = _let(lowest, lambda threshold: F.array_join(
        F.transform("_pairs", lambda p: changed(p, threshold)), " "
    ))
    return numbered.withColumn(
        "text", F.when(size >= TYPO_MIN_WORDS, rewritten).otherwise(F.col("text"))
    ).select(*df.columns)
