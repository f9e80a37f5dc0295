"""DuckDB SQL for the text rules, written step by step and apart from the Spark expressions.

Every sentence is tokenised on its own by a chain of plain replacements, without lookaround, so that
an agreement of both engines says something about either.
"""

from __future__ import annotations

from collections.abc import Sequence

from penprint.functions import lexicons as lx

CHAT = """SELECT conv_id * 1000000 + turn AS doc_id, text,
  CASE WHEN role = 'user' THEN 0 ELSE 1 END AS label
  FROM conversations WHERE role IN ('user', 'assistant')"""
DOC = """SELECT doc_id, text, lang, source, quality AS label
  FROM documents JOIN labels USING (doc_id)"""
DOCS = "SELECT doc_id, text FROM documents"
PARAGRAPHS = "SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents"

_WS = r"[ \t\n\r\f\x0B]"
_NOT_WS = r"[^ \t\n\r\f\x0B]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(source: str, pattern: str, replacement: str, everywhere: bool = True) -> str:
    flag = ", 'g'" if everywhere else ""
    return f"regexp_replace({source}, {q(pattern)}, {replacement}{flag})"


def in_list(terms: Sequence[str]) -> str:
    return "(" + ", ".join(q(t) for t in terms) + ")"


def sentences(text: str, var: str = "s") -> str:
    marked = sub(text, r"""([.!?]+["')\]]*)[ \t\n\r]+""", r"'\1' || chr(1)")
    return (
        f"list_filter(string_split({marked}, chr(1)),"
        f" lambda {var}: regexp_matches({var}, {q(_NOT_WS)}))"
    )


def tokens(sentence: str, var: str = "t") -> str:
    s = sub(sentence, r"""([^.])(\.)([\])}>"']*)""" + _WS + "*$", r"'\1 \2 \3 '", False)
    s = sub(s, r"""([;@#$%&?!*()\[\]{}<>"])""", r"' \1 '")
    s = sub(s, r"(\.{2,})", r"' \1 '")
    s = sub(s, r"([:,])([^0-9])", r"' \1 \2'")
    s = sub(s, r"([:,])$", r"' \1 '", False)
    s = f"(' ' || {s} || ' ')"
    s = sub(s, r"([^' ])('s|'m|'d|'S|'M|'D) ", r"'\1 \2 '")
    s = sub(s, r"([^' ])('ll|'re|'ve|n't|'LL|'RE|'VE|N'T) ", r"'\1 \2 '")
    return whitespace_words(s, var)


def whitespace_words(text: str, var: str = "t") -> str:
    return f"list_filter(string_split_regex({text}, {q(_WS + '+')}), lambda {var}: {var} <> '')"


def strip(text: str) -> str:
    return sub(sub(text, f"^{_WS}+", "''"), f"{_WS}+$", "''")


def collapse(text: str) -> str:
    return f"trim({sub(text, _WS + '+', chr(39) + ' ' + chr(39))})"


def words(text: str) -> str:
    """All word tokens of a text."""
    each = f"list_transform({sentences(text)}, lambda x: {tokens('x')})"
    return f"coalesce(flatten({each}), [])"


def paragraph_words(text: str) -> str:
    size = f"len({whitespace_words('p')})::DOUBLE"
    parts = f"list_transform(string_split({text}, chr(10) || chr(10)), lambda p: {size})"
    return f"list_filter({parts}, lambda n: n > 0)"


def members(terms: Sequence[str], tokens_column: str = "w") -> str:
    return f"coalesce(len(list_filter({tokens_column}, lambda t: t IN {in_list(terms)})), 0)"


def features_cte(
    source: str,
    ai_words: Sequence[str] = lx.AI_WORDS,
    conjunctions: Sequence[str] = lx.CONJUNCTIONS,
    transitions: Sequence[str] = lx.TRANSITIONS,
    pronouns: Sequence[str] = lx.PRONOUNS,
    carry: str = "doc_id, text",
) -> str:
    """CTEs ending in ``feats``: the carried columns, ``nw``, ``ns`` and the fifteen features."""
    clause_words = f"len({words('c')})"
    std = "coalesce(list_aggregate({0}, 'stddev_pop'), 0)"
    mean = "coalesce(list_aggregate({0}, 'avg'), 0)"
    passive = (
        "len(list_filter(list_zip(w[1:len(w) - 1], w[2:len(w)]),"
        f" lambda z: z[1] IN {in_list(lx.BE_FORMS)} AND ends_with(z[2], 'ed')))"
    )
    contraction = (
        "len(list_filter(w, lambda t: "
        + " OR ".join(f"contains(t, {q(c)})" for c in ("n't", "'re", "'ve", "'ll", "'d", "'m", "'s"))
        + "))"
    )
    return rf"""
src AS ({source}),
low AS (SELECT *, lower(coalesce(text, '')) AS lt FROM src),
sen AS (SELECT *, {sentences('lt')} AS s FROM low),
tok AS (SELECT *,
  list_transform(s, lambda x: {tokens('x')}) AS st,
  list_transform(list_filter(string_split_regex(lt, '[,;:]'),
    lambda c: regexp_matches(c, {q(_NOT_WS)})), lambda c: {clause_words}::DOUBLE) AS cl
  FROM sen),
arr AS (SELECT *, coalesce(flatten(st), []) AS w,
  list_transform(st, lambda x: len(x)::DOUBLE) AS sl,
  list_transform(list_zip(st, s),
    lambda z: len(z[1])::DOUBLE / greatest(len(string_split(z[2], ',')), 1)) AS bu,
  {paragraph_words('lt')} AS pw
  FROM tok),
num AS (SELECT *, len(w)::BIGINT AS nw, len(s)::BIGINT AS ns, greatest(len(w), 1)::DOUBLE AS d,
  list_filter(w, lambda t: regexp_full_match(t, '\p{{L}}+')) AS alpha FROM arr),
feats AS (SELECT {carry}, nw, ns,
  len(list_distinct(w)) / d AS unique_word_ratio,
  {members(ai_words)} / d AS ai_word_ratio,
  CASE WHEN ns > 1 THEN {std.format('sl')} / greatest({mean.format('sl')}, 1) ELSE 0 END
    AS sentence_variation,
  coalesce(list_aggregate(list_transform(alpha, lambda t: length(t)::DOUBLE), 'avg'), 0)
    AS avg_word_length,
  length(regexp_replace(lt, '[^.,;:!?]', '', 'g'))::DOUBLE / greatest(length(lt), 1)
    AS punctuation_density,
  {members(conjunctions)} / d AS conjunction_ratio,
  CASE WHEN contains(lt, chr(10) || chr(10)) THEN least({std.format('pw')}, 10) ELSE 0 END
    AS paragraph_variation,
  len(list_filter(w, lambda t: length(t) > 6)) / d AS readability,
  CASE WHEN ns > 1 THEN {std.format('bu')} / greatest({mean.format('bu')}, 1) ELSE 0 END
    AS burstiness,
  {members(transitions)} / d AS transition_density,
  least({mean.format('cl')}, 20) AS avg_clause_length,
  len(list_distinct(w)) / d AS lexical_diversity,
  {members(pronouns)} / d AS pronoun_ratio,
  {contraction} / d AS contraction_ratio,
  {passive} / greatest(ns, 1)::DOUBLE AS passive_ratio
  FROM num)"""


def key(seed: int, *ids: str) -> str:
    return f"md5('{seed}:' || " + " || ':' || ".join(f"{i}::VARCHAR" for i in ids) + ")"


def uniform(seed: int, step: str, id_col: str = "doc_id") -> str:
    digest = f"md5('{seed}:{step}:' || {id_col}::VARCHAR)"
    return f"(('0x' || substr({digest}, 1, 8))::BIGINT / 4294967296.0::DOUBLE)"
