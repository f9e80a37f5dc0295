"""The features of texts that are too long for one task, from pieces of any cut.

A table of pieces (id, place, piece) is a text in pieces, cut wherever: inside words, marks or runs of blanks. Each
piece is divided at its first and last safe place, a single blank between two ASCII letters or digits, where no token,
sentence end, clitic or paragraph can be astride. What lies between is counted where it is, as any text is; only the
fragments at either end move, a few words each, and are joined to those of the neighbouring pieces. A piece without a
safe place is all fragment.

Each such segment gives counts that add up, moments (count, mean, squared deviation) of the sentences and paragraphs
that it holds whole, and the open sentence, clause and paragraph at either end. Running numbers of the boundaries before a
segment name the open ones; parts of one sentence meet by that name and are summed. All rows that are shuffled are
counts, distinct tokens, or fragments. The distinct tokens of a text of up to ``WHOLE`` characters meet as a whole, a row a segment,
which takes no table of all tokens of a task; those of longer texts meet token by token.

Ids must not be null or shared by two texts; pieces of a text are numbered in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.functions import lexicons as lx
from penprint.functions import tokens as tk
from penprint.functions.features import FEATURES, LONG_WORD, alpha_words, commas, contractions, formulas, members_of, moments, tokenised
from penprint.session import stored

_FIRST = r"(?s)^(.*?[A-Za-z0-9] )(?=[A-Za-z0-9])"
_LAST = r"(?s)^(.*[A-Za-z0-9] )(?=[A-Za-z0-9])"
WHOLE = 1 << 20
_ZERO = "named_struct('n', 0D, 'mean', 0D, 'm2', 0D)"


def cut_texts(df: DataFrame, size: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, place, piece``: every text in pieces of ``size`` characters; an empty text is one empty piece."""
    pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = df.select(id_col, F.posexplode_outer(pieces).alias("place", "piece"))
    return cut.select(id_col, F.coalesce("place", F.lit(0)).alias("place"), F.coalesce("piece", F.lit("")).alias("piece"))


def _segments(pieces: DataFrame, id_col: str) -> DataFrame:
    """``_id, _place, _side, _segment``: the same texts, cut at safe places only; ordered by place and side."""
    piece = F.coalesce(F.col("piece"), F.lit(""))
    cut = pieces.select(
        F.col(id_col).alias("_id"), F.col("place").cast("long").alias("_place"), piece.alias("_piece"),
        F.length(F.regexp_extract(piece, _FIRST, 1)).alias("_first"), F.length(F.regexp_extract(piece, _LAST, 1)).alias("_last"),
    )
    inside = cut.where("_last > _first").select(
        "_id", "_place", F.lit(1).alias("_side"), F.expr("substring(_piece, _first + 1, _last - _first)").alias("_segment")
    )
    # Side 0: what stands before a piece's own segment; 2: what stands after it, or a piece without a safe place.
    ends = cut.select(
        "_id", "_place", (F.col("_first") > 0).cast("long").alias("_cut"),
        F.expr("if(_first > 0, substring(_piece, 1, _first), _piece)").alias("_head"),
        F.expr("if(_first > 0, substring(_piece, _last + 1, length(_piece)), null)").alias("_tail"),
    )
    before = Window.partitionBy("_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = ends.withColumn("_group", F.coalesce(F.sum("_cut").over(before), F.lit(0)))
    fragments = numbered.select("_id", F.explode(F.expr("""
        if(_cut = 1,
           array(named_struct('g', _group, 'at', named_struct('place', _place, 'side', 0), 't', _head),
                 named_struct('g', _group + 1, 'at', named_struct('place', _place, 'side', 2), 't', _tail)),
           array(named_struct('g', _group, 'at', named_struct('place', _place, 'side', 2), 't', _head)))
    """)).alias("f"))
    joined = fragments.groupBy("_id", "f.g").agg(
        F.max("f.at").alias("at"), F.array_sort(F.collect_list(F.struct("f.at", "f.t"))).alias("parts")
    )
    bridges = joined.select(
        "_id", F.col("at.place").alias("_place"), F.col("at.side").alias("_side"), F.expr("array_join(transform(parts, p -> p.t), '')").alias("_segment")
    )
    return inside.unionByName(bridges)


def _closed(parts: str, value: str) -> Column:
    """Moments over the parts between the first and the last."""
    return moments(F.expr(f"transform(filter(slice({parts}, 2, greatest(size({parts}) - 2, 0)), p -> p.n > 0), p -> {value})"))


def _segment_counts(segments: DataFrame, lists: dict[str, Sequence[str]], be_forms: Sequence[str], sentences_in_clauses: bool) -> DataFrame:
    """One narrow row per segment: sums, moments of what is whole, and its open ends."""
    lines = tokenised(segments, "_segment", sentences_in_clauses)
    col = F.col
    size = lambda s: F.size(tk.split_even(s)).cast("double")
    measured = lines.withColumns({
        "_words": tk.split_even(col("_t_line")),
        "_alpha": alpha_words(),
        "_sentences": F.transform(F.split("_t_even", tk.SENTENCE), lambda s: F.struct(size(s).alias("n"), commas(s).cast("double").alias("c"))),
        "_clauses": F.transform(
            F.split("_t_clauses", tk.CLAUSE), lambda s: F.struct(size(tk.even_blanks(s)).alias("n"), F.lit(0.0).alias("c"))
        ),
        "_paragraphs": F.transform(
            F.split("_t_text", "\n\n"), lambda p: F.struct(F.size(tk.whitespace_words(p)).cast("double").alias("n"), F.lit(0.0).alias("c"))
        ),
    })
    # The few words of any list are found once, as the array is long.
    measured = measured.withColumn("_hits", F.filter("_words", lambda t: t.isin(*sorted({w for terms in lists.values() for w in terms}))))
    hits = {name: members_of(col("_hits"), terms) for name, terms in lists.items()}
    line = col("_t_line")
    sums = {
        "n": F.size("_words"),
        **hits,
        "long": F.size(F.filter("_words", lambda t: F.length(t) >= LONG_WORD)),
        "alpha_n": F.size("_alpha"),
        "alpha_chars": F.length(F.array_join("_alpha", "")),
        "contractions": contractions(),
        "passives": F.regexp_count(line, F.lit(tk.pair_pattern(be_forms, "ed"))),
        "clause_tokens": F.expr("aggregate(_clauses, 0D, (a, p) -> a + p.n)"),
        "chars": F.length("_t_text"),
        "punctuation": F.regexp_count("_t_text", F.lit(f"[{lx.PUNCTUATION}]")),
        "clause_count": F.expr("size(filter(slice(_clauses, 2, greatest(size(_clauses) - 2, 0)), p -> p.n > 0))"),
    }
    ends = [
        F.struct(F.size(c).alias("size"), F.element_at(c, 1).alias("first"), F.element_at(c, -1).alias("last")).alias(c)
        for c in ("_sentences", "_clauses", "_paragraphs")
    ]
    return measured.select(
        "_id", "_place", "_side", *[c.cast("double").alias(name) for name, c in sums.items()],
        _closed("_sentences", "p.n").alias("sentence_m"), _closed("_sentences", "p.n / (p.c + 1)").alias("burst_m"),
        _closed("_paragraphs", "p.n").alias("paragraph_m"), *ends,
        F.get("_words", F.lit(0)).alias("_first_word"), F.get("_words", F.size("_words") - 1).alias("_last_word"),
    )


def _open_parts(rows: DataFrame, id_col: str = "_id") -> DataFrame:
    """Every sentence, clause and paragraph that a segment's end cuts: ``_id, kind, n`` and ``c`` of the whole."""
    order = Window.partitionBy(id_col).orderBy("_place", "_side").rowsBetween(Window.unboundedPreceding, -1)
    kinds = ("_sentences", "_clauses", "_paragraphs")
    numbered = rows.select(id_col, *[
        F.struct(F.coalesce(F.sum(F.col(f"{k}.size") - 1).over(order), F.lit(0)).alias("before"), *[F.col(f"{k}.{x}") for x in ("size", "first", "last")]).alias(k)
        for k in kinds
    ])
    parts = F.concat(*[F.expr(f"""
        if({k}.size = 1, array(named_struct('kind', '{k}', 'unit', {k}.before, 'part', {k}.first)),
           array(named_struct('kind', '{k}', 'unit', {k}.before, 'part', {k}.first),
                 named_struct('kind', '{k}', 'unit', {k}.before + {k}.size - 1, 'part', {k}.last)))
    """) for k in kinds])
    return numbered.select(id_col, F.explode(parts).alias("p")).groupBy(id_col, "p.kind", "p.unit").agg(
        F.sum("p.part.n").alias("n"), F.sum("p.part.c").alias("c")
    ).where("n > 0")


def _pairs(rows: DataFrame, be_forms: Sequence[str]) -> DataFrame:
    """Per text, the pairs of a form of be and a participle of which one ends a segment and the other begins one."""
    words = rows.where("_first_word is not null")
    order = Window.partitionBy("_id").orderBy("_place", "_side")
    pair = F.lag("_last_word").over(order).isin(*be_forms) & F.endswith("_first_word", F.lit("ed"))
    return words.select("_id", pair.alias("pair")).where("pair").groupBy("_id").agg(F.count("*").cast("double").alias("passives"))


def _added(lists: str) -> Column:
    """One set of moments from many, in a fixed order."""
    return F.expr(f"""
        aggregate(array_sort({lists}), {_ZERO}, (a, b) -> named_struct(
            'n', a.n + b.n,
            'mean', a.mean + (b.mean - a.mean) * b.n / greatest(a.n + b.n, 1D),
            'm2', a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / greatest(a.n + b.n, 1D)))""")


def _distinct_words(segments: DataFrame, rows: DataFrame) -> DataFrame:
    """Per text, the number of distinct tokens."""
    # At most one id for each WHOLE characters of all texts.
    long = F.broadcast(rows.groupBy("_id").agg(F.sum("chars").alias("_chars")).where(F.col("_chars") > WHOLE).select("_id"))
    tokens = tk.split_even(F.col("_t_line"))
    own = tokenised(segments.join(long, "_id", "left_anti"), "_segment").select("_id", F.array_join(F.array_distinct(tokens), " ").alias("words"))
    joined = F.array_join(F.collect_list("words"), " ")
    whole = own.repartition("_id").groupBy("_id").agg(joined.alias("words")).select(
        "_id", F.size(F.array_distinct(tk.split_even(F.col("words")))).cast("double").alias("distinct")
    ).where("distinct > 0")
    words = tokenised(segments.join(long, "_id", "left_semi"), "_segment").select("_id", F.explode(tokens).alias("word"))
    return whole.unionByName(words.distinct().groupBy("_id").agg(F.count("*").cast("double").alias("distinct")))


def piece_features(
    pieces: DataFrame, id_col: str = "doc_id", *, ai_words: Sequence[str] = lx.AI_WORDS, conjunctions: Sequence[str] = lx.CONJUNCTIONS,
    transitions: Sequence[str] = lx.TRANSITIONS, pronouns: Sequence[str] = lx.PRONOUNS, be_forms: Sequence[str] = lx.BE_FORMS,
    sentences_in_clauses: bool = True,
) -> DataFrame:
    """``id_col`` and the fifteen features of every text, from its pieces."""
    lists = {"ai": ai_words, "conjunctions": conjunctions, "transitions": transitions, "pronouns": pronouns}
    segments = stored(_segments(pieces, id_col), "segments")
    rows = stored(_segment_counts(segments, lists, be_forms, sentences_in_clauses), "segment-counts")
    distinct = _distinct_words(segments, rows)

    one = lambda value: f"named_struct('n', 1D, 'mean', {value}, 'm2', 0D)"
    opened = _open_parts(rows).select(
        "_id", F.expr("if(kind = '_clauses', 1D, null)").alias("clause_count"),
        F.expr(f"if(kind = '_sentences', {one('n')}, null)").alias("sentence_m"),
        F.expr(f"if(kind = '_sentences', {one('n / (c + 1)')}, null)").alias("burst_m"),
        F.expr(f"if(kind = '_paragraphs', {one('n')}, null)").alias("paragraph_m"),
    )
    broken = F.col("_paragraphs.size") - 1
    counts = rows.drop("_place", "_side", "_sentences", "_clauses", "_first_word", "_last_word").withColumn("_breaks", broken).drop("_paragraphs")
    parts = counts
    for more in (opened, distinct, _pairs(rows, be_forms)):
        parts = parts.unionByName(more, allowMissingColumns=True)
    many = ("sentence_m", "burst_m", "paragraph_m")
    sums = [c for c in parts.columns if c not in ("_id", *many)]
    texts = parts.groupBy("_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in sums], *[F.collect_list(c).alias(c) for c in many]
    ).withColumns({c: _added(c) for c in many})
    # A text without an empty line has no paragraphs to compare.
    texts = texts.withColumns({"ns": F.col("sentence_m.n"), "paragraph_m": F.when(F.col("_breaks") > 0, F.col("paragraph_m"))})
    found = formulas(F.col)
    return texts.select(F.col("_id").alias(id_col), *[found[f].cast("double").alias(f) for f in FEATURES])
