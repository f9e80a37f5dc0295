"""Plain Python counterparts of the text rules, step by step and one text at a time."""

import re
import statistics

from penprint.functions import lexicons as lx

BLANK = " \t\n\r\f\x0b"
_SPLIT = re.compile(f"[{BLANK}]+")


def blank_words(text):
    return [w for w in _SPLIT.split(text) if w]


def sentences(text):
    marked = re.sub(r"""([.!?]+["')\]]*)[ \t\n\r]+""", "\\1\x01", text)
    return [s for s in marked.split("\x01") if s.strip(BLANK)]


def sentence_tokens(s):
    s = re.sub(rf"""([^.])(\.)([\])}}>"']*)[{BLANK}]*\Z""", r"\1 \2 \3 ", s, count=1)
    s = re.sub(r"""([;@#$%&?!*()\[\]{}<>"])""", r" \1 ", s)
    s = re.sub(r"(\.{2,})", r" \1 ", s)
    s = re.sub(r"([:,])([^0-9])", r" \1 \2", s)
    s = re.sub(r"([:,])\Z", r" \1 ", s)
    s = f" {s} "
    s = re.sub(r"([^' ])('[sSmMdD]) ", r"\1 \2 ", s)
    s = re.sub(r"([^' ])('ll|'re|'ve|n't|'LL|'RE|'VE|N'T) ", r"\1 \2 ", s)
    return blank_words(s)


def words(text):
    return [t for s in sentences(text) for t in sentence_tokens(s)]


def _variation(values):
    return statistics.pstdev(values) / max(statistics.mean(values), 1) if len(values) > 1 else 0.0


def features(text, sentences_in_clauses=True):
    lt = text.lower()
    ss = sentences(lt)
    st = [sentence_tokens(s) for s in ss]
    w = [t for x in st for t in x]
    n = max(len(w), 1)
    alpha = [len(t) for t in w if t.isalpha()]
    tokenize = words if sentences_in_clauses else sentence_tokens
    clauses = [len(tokenize(c)) for c in re.split("[,;:]", lt) if c.strip(BLANK)]
    paragraphs = [len(blank_words(p)) for p in lt.split("\n\n")]
    paragraphs = [p for p in paragraphs if p]
    clitics = ("n't", "'re", "'ve", "'ll", "'d", "'m", "'s")
    pairs = sum(a in lx.BE_FORMS and b.endswith("ed") for a, b in zip(w, w[1:]))

    def share(terms):
        return sum(t in terms for t in w) / n

    return [
        len(set(w)) / n,
        share(lx.AI_WORDS),
        _variation([len(x) for x in st]),
        sum(alpha) / len(alpha) if alpha else 0.0,
        sum(c in ".,;:!?" for c in lt) / max(len(lt), 1),
        share(lx.CONJUNCTIONS),
        min(statistics.pstdev(paragraphs), 10) if "\n\n" in lt and paragraphs else 0.0,
        sum(len(t) > 6 for t in w) / n,
        _variation([len(x) / len(s.split(",")) for x, s in zip(st, ss)]),
        share(lx.TRANSITIONS),
        min(statistics.mean(clauses), 20) if clauses else 0.0,
        len(set(w)) / n,
        share(lx.PRONOUNS),
        sum(any(c in t for c in clitics) for t in w) / n,
        pairs / max(len(ss), 1),
    ]
