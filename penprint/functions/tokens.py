"""Sentence, word and clause boundaries as whole-text regular expressions.

A text is never cut into an array to be tokenised piece by piece. Boundaries are written into the
string itself (``SENTENCE`` between sentences, ``CLAUSE`` between clauses, blanks around tokens), so
that a handful of linear, code-generated ``regexp_replace`` passes tokenise a text of any length and
counting tokens is again one linear pass. Possessive quantifiers keep the patterns free of
backtracking over long runs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTENCE = "\u0001"
CLAUSE = "\u0002"
MARKS = SENTENCE + CLAUSE

BLANK = r" \t\n\r\f\x0B"
TOKEN = f"[^{BLANK}{MARKS}]"

# Every pattern opens with one plain character class, which rejects most positions at once; what
# stands around the hit is checked after it, by lookbehind and lookahead.

# A run of stops with its closing quotes or brackets, then blanks. Only the head of a run is tried.
_SENTENCE_END = r"""([.!?](?<![.!?][.!?])[.!?]*+["')\]]*+)[ \t\n\r]++"""

_SYMBOL = r""";@#$%&?!*()\[\]{}<>\""""
_EDGE = f"(?:[{MARKS}]|\\z)"

# Group 1 gets blanks on both sides: a symbol, a run of dots, the last period of a sentence (perhaps
# before closing quotes or brackets), or a colon or comma not followed by a digit. Of two adjacent
# colons or commas the second (group 2) stays joined to what follows it.
_PUNCTUATION = (
    rf"([{_SYMBOL}.:,](?:"
    rf"(?<=[{_SYMBOL}])"
    rf"|(?<=\.)\.++"
    rf"""|(?<=[^.{MARKS}]\.)(?=[\])}}>"']*+[{BLANK}]*+{_EDGE})"""
    rf"|(?<=[:,])(?:(?=[:,])|(?![0-9]))"
    rf"))((?<=[:,])[:,])?+"
)

_CLITIC_EDGE = f"(?:[ {MARKS}]|\\z)"
_BEFORE = f"[^' {MARKS}]"
_LATER = f"(?=(?:'[sSmMdD])?+{_CLITIC_EDGE})"
# 's 'm 'd at a token's end, and 'll 're 've n't at a token's end or before one of the former.
_CLITIC = (
    rf"['nN](?:(?<={_BEFORE}')(?:[sSmMdD](?={_CLITIC_EDGE})|(?:ll|re|ve|LL|RE|VE){_LATER})"
    rf"|(?<={_BEFORE}n)'t{_LATER}|(?<={_BEFORE}N)'T{_LATER})"
)


# The word before a stretch's last period, and the word that the next stretch begins with.
_LAST_SHORT = rf"""(?:^|[{BLANK}])["'(\[{{<]*+([^{BLANK}]*?)\.["')\]]*+$"""
_FIRST_WORD = rf"""^["'(\[{{<]*+([^{BLANK}"')\]}}>,;:!?]*)"""


def mark_sentences(text: Column, abbreviations: Sequence[str] = (), starters: Sequence[str] = ()) -> Column:
    """Replace the blanks after a sentence's end by the sentence mark.

    A period after one of ``abbreviations`` (in lower case, without it) ends a sentence only before one of ``starters``.
    """
    marked = F.regexp_replace(text, _SENTENCE_END, f"$1{SENTENCE}")
    if not abbreviations:
        return marked
    parts = F.split(marked, SENTENCE)
    following = F.concat(F.slice(parts, F.lit(2), F.size(parts)), F.array(F.lit(None).cast("string")))

    def with_mark(part: Column, next_part: Column) -> Column:
        short = F.lower(F.regexp_extract(part, _LAST_SHORT, 1)).isin(*abbreviations)
        first = F.regexp_replace(F.lower(F.regexp_extract(next_part, _FIRST_WORD, 1)), r"\.+$", "")
        goes_on = short & ~first.isin(*starters) if starters else short
        return F.concat(part, F.when(next_part.isNull(), F.lit("")).when(goes_on, F.lit(" ")).otherwise(F.lit(SENTENCE)))

    return F.array_join(F.zip_with(parts, following, with_mark), "")


def mark_clauses(text: Column) -> Column:
    """Replace every comma, semicolon and colon by the clause mark."""
    # Three literal replacements on the bytes; ``translate`` looks each character up in a map of strings.
    for c in ",;:":
        text = F.replace(text, F.lit(c), F.lit(CLAUSE))
    return text


def space_punctuation(text: Column) -> Column:
    """Put blanks around the punctuation of every marked stretch of ``text``."""
    return F.regexp_replace(text, _PUNCTUATION, " $1 $2")


def space_clitics(text: Column, punctuated: Column) -> Column:
    """Put blanks around the clitics of a text whose punctuation is spaced already.

    ``text`` is any earlier form of it: one without an apostrophe has no clitics to look for.
    """
    spaced = F.regexp_replace(punctuated, _CLITIC, " $0 ")
    return F.when(F.contains(text, F.lit("'")), spaced).otherwise(punctuated)


def spaced_words(text: Column) -> Column:
    """Sentence marks and token blanks in one string: the form the features count on."""
    return space_clitics(text, space_punctuation(mark_sentences(text)))


def spaced_clauses(text: Column, sentences_in_clauses: bool = True) -> Column:
    """Clause marks and token blanks in one string.

    The word tokenizer looks for sentences in whatever it is given, so by default a clause that
    spans a full stop is tokenised as two sentences. ``False`` takes each clause as one piece.
    """
    pieces = mark_clauses(mark_sentences(text) if sentences_in_clauses else text)
    return space_clitics(text, space_punctuation(pieces))


def even_blanks(text: Column, marks: str = MARKS) -> Column:
    """One kind of blank: white space and the given marks become spaces.

    Literal replacement works on the bytes, and a split at a single space needs no pattern either.
    """
    for c in "\t\n\r\f\u000b" + marks:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def even_line(spaced: Column) -> Column:
    """A spaced string whose only blanks are spaces, with one at either end."""
    return F.concat(F.lit(" "), even_blanks(spaced), F.lit(" "))


def pair_pattern(first: Sequence[str], suffix: str) -> str:
    """On an even line: one of some tokens, followed by a token with a suffix."""
    # A token that begins with another character is turned away at once.
    begins = f"(?=[{''.join(sorted({re.escape(f[0]) for f in first}))}])" if all(first) else ""
    return rf" {begins}(?:{'|'.join(map(re.escape, first))})(?= ++[^ ]*?{re.escape(suffix)} )"


def split_even(even: Column) -> Column:
    """The tokens of a string whose only blanks are spaces."""
    return F.array_remove(F.split(even, " "), "")


def token_array(spaced: Column) -> Column:
    """The tokens of a spaced string, in text order."""
    return split_even(even_blanks(spaced))


def token_count(spaced: Column) -> Column:
    """The number of ``token_array``'s tokens, without evening the blanks or making the arrays."""
    return F.regexp_count(spaced, F.lit(f"{TOKEN}++"))


def clause_count(spaced: Column) -> Column:
    """Number of clauses with at least one token."""
    return F.regexp_count(spaced, F.lit(f"{TOKEN}[^{CLAUSE}]*+"))


def words(text: Column) -> Column:
    """Word tokens of the lower-cased text."""
    return token_array(spaced_words(F.lower(text)))


def sentences(text: Column, abbreviations: Sequence[str] = (), starters: Sequence[str] = ()) -> Column:
    """Sentences of the lower-cased text, blanks trimmed."""
    parts = F.split(mark_sentences(F.lower(text), abbreviations, starters), SENTENCE)
    trimmed = F.transform(parts, lambda s: strip(s))
    return F.filter(trimmed, lambda s: s != "")


def clauses(text: Column) -> Column:
    """Stretches of the lower-cased text between commas, semicolons and colons, blank ones left out."""
    parts = F.transform(F.split(F.lower(text), "[,;:]"), lambda s: strip(s))
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Stretches of the lower-cased text between empty lines, blank ones left out."""
    parts = F.transform(F.split(F.lower(text), "\n\n"), lambda s: strip(s))
    return F.filter(parts, lambda s: s != "")


def whitespace_words(text: Column) -> Column:
    """Words by white space alone."""
    return split_even(even_blanks(text, ""))


def strip(text: Column) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(text, F.lit(" \t\n\r\f\u000b"))


def collapse(text: Column) -> Column:
    """One blank for every run of white space, none at the ends."""
    return F.btrim(F.regexp_replace(text, f"[{BLANK}]++", " "))
