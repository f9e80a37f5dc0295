"""Quality rules: a table of thresholds compiled into one projection.

Every figure is a column expression over the whole text, so a corpus is judged in one narrow pass
without user functions or a shuffle. Texts are judged by themselves: copies get equal verdicts.

Null and empty texts have no words, so they fail the length rule and are not kept. A text of white space
only is treated the same. Extra columns, whatever their names, are never read and pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import SPACE_CLASS, let, literal, quoted, shifted, words

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages, a fixed list.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "it", "that", "for", "was", "on", "with", "as", "be", "by", "at",
    "der", "die", "das", "und", "ist", "in", "den", "von", "zu", "mit", "für", "auf", "ein", "eine", "des", "dem",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "en", "que", "pour", "dans", "sur", "au",
    "el", "los", "las", "del", "y", "es", "por", "con", "para", "una", "se", "su", "al", "lo", "como", "que",
)


@dataclass(frozen=True)
class Rule:
    """A text fails if ``metric`` leaves [low, high]."""

    name: str
    metric: str
    low: float = float("-inf")
    high: float = float("inf")


#: The production thresholds; metrics are the names in ``metrics()``.
RULES = (
    Rule("length", "n_words", low=50),
    Rule("repeated_windows", "repeat_ratio", high=0.5),
    Rule("word_length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbol_ratio", high=0.1),
    Rule("shouting", "bang_ratio", high=0.1),
    Rule("stop_words", "stop_ratio", low=0.03),
    Rule("lines", "dup_line_ratio", high=0.4),
)


def _repeat_words(array: str) -> str:
    """Words inside 3-word windows that occur twice or more.

    Windows are compared by a 64-bit hash. A text without a repeated window, which a set finds, is done;
    else windows are sorted by (hash, place), and the places next to an equal one are measured in order.
    """
    n = f"(size({array}) - 2)"
    pair = f"zip_with(_h, {shifted('_h', 1, 'size(_h) - 1')}, (a, b) -> xxhash64(a, b))"
    three = f"zip_with({shifted('_p', 0, n)}, {shifted('_h', 2, n)}, (a, b) -> xxhash64(a, b))"
    after = f"concat({shifted('_s', 1, 'size(_s) - 1')}, array(named_struct('h', cast(null as bigint), 'i', -1)))"
    before = f"concat(array(named_struct('h', cast(null as bigint), 'i', -1)), {shifted('_s', 0, 'size(_s) - 1')})"
    equal = f"zip_with({after}, {before}, (a, b) -> named_struct('x', a.h, 'y', b.h))"
    twice = (
        "sort_array(transform(filter(zip_with(_s, " + equal + ", (s, n) -> "
        "if(s.h <=> n.x or s.h <=> n.y, s.i, cast(null as int))), i -> i is not null), i -> i))"
    )
    follow = f"concat({shifted('_d', 1, 'size(_d) - 1')}, array(2147483647))"
    covered = f"aggregate(zip_with(_d, {follow}, (a, b) -> least(3, b - a)), 0L, (t, x) -> t + x)"
    in_order = "array_sort(transform(_t, (h, i) -> named_struct('h', h, 'i', i)))"
    found = let(in_order, "_s", let(twice, "_d", covered))
    counted = f"if(size(array_distinct(_t)) = size(_t), 0L, {found})"
    hashes = f"transform({array}, w -> xxhash64(w))"
    return f"if({n} < 2, 0L, {let(hashes, '_h', let(pair, '_p', let(three, '_t', counted)))})"


def base_metrics(text: str = "text") -> Column:
    """A struct of the counts of a text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop, n_bangs."""
    t = f"coalesce({quoted(text)}, '')"
    stops = ", ".join(literal(w) for w in dict.fromkeys(STOP_WORDS))
    lines = f"filter(split({t}, '\\n'), l -> l rlike {literal('[^' + SPACE_CLASS[1:])})"
    body = f"""named_struct(
        'n_words', cast(size(_w) as bigint),
        'word_chars', cast(char_length(array_join(_w, '')) as bigint),
        'n_symbols', cast(char_length(regexp_replace({t}, {literal('[^' + SYMBOLS + ']++')}, '')) as bigint),
        'n_dup_lines', {let(lines, "_l", "cast(size(_l) - size(array_distinct(_l)) as bigint)")},
        'n_repeat_words', {_repeat_words("_w")},
        'n_stop', cast(size(filter(_w, w -> lower(w) in ({stops}))) as bigint),
        'n_bangs', cast(char_length(regexp_replace({t}, '[^!]++', '')) as bigint),
        'n_lines', {let(lines, "_l", "cast(size(_l) as bigint)")})"""
    return F.expr(let(words(quoted(text)), "_w", body))


def _ratios(m: Column) -> dict[str, Column]:
    n = F.greatest(m["n_words"], F.lit(1)).cast("double")
    return {
        "n_words": m["n_words"].cast("double"),
        "repeat_ratio": m["n_repeat_words"] / n,
        "mean_word_chars": m["word_chars"] / n,
        "symbol_ratio": m["n_symbols"] / n,
        "bang_ratio": m["n_bangs"] / n,
        "stop_ratio": m["n_stop"] / n,
        "dup_line_ratio": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)).cast("double"),
    }


def failures(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a struct of ``base_metrics`` breaks, in table order."""
    ratios = _ratios(m)
    tests = [
        F.when(~ratios[r.metric].between(r.low, r.high), F.lit(r.name))
        for r in rules
    ]
    return F.array_compact(F.array(*tests))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, the counts, the rules it breaks and whether it is kept. Rows are neither merged nor lost."""
    figures = docs.select(F.col(quoted(id_col)).alias("doc_id"), base_metrics(text).alias("m"))
    verdict = figures.withColumn("failed", failures(F.col("m"), rules))
    return verdict.select(
        "doc_id",
        "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "m.n_stop",
        "failed",
        (F.size("failed") == 0).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The documents that break no rule, with the columns they came with."""
    # Bound as the one element of an array, the counts are computed once and not for each rule.
    return docs.filter(F.exists(F.array(base_metrics(text)), lambda m: F.size(failures(m, rules)) == 0))
