"""Benchmark decontamination by winnowing, in SQL expressions only.

Both sides are lower-cased (A to Z) and cut into words. For every window of ``window`` words the least hash of its
``gram``-word grams is kept, once for a run of windows that share it; equal windows have equal least grams, so every
shared span of ``window`` words or more is found, whatever lies around it. Document fingerprints meet those of the
benchmark in a hash join; a hit is extended to the windows of its run, which are compared word for word, so hash
collisions never count. Items shorter than a window are one window of their own length and are compared with all
document windows of that length.

The benchmark's fingerprints are counted first: up to ``BROADCAST_ROWS`` of them (16 bytes each) are broadcast, more
are joined by a shuffle. Hits are (document, place) pairs, at most one for each word; documents are never paired with
each other, so common words and copies cost no more than their own length.

Defined results: null and empty texts have no words and no hits; an item without words has no window; repeated items
each count; rows equal in id and text get equal results; an empty benchmark hits nothing. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.llm.exprs import let, literal, quoted, shifted
from penprint.session import stored

WINDOW = 10
GRAM = 5
BROADCAST_ROWS = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: str) -> str:
    """The words of a text: maximal runs of digits, letters a to z and characters outside ASCII, A to Z lower-cased."""
    t = f"coalesce({text}, '')"
    # On ASCII text lower() changes A to Z only; elsewhere it would change other letters too.
    lowered = f"if(octet_length({t}) = char_length({t}), lower({t}), translate({t}, '{_UPPER}', '{_UPPER.lower()}'))"
    parts = f"split({lowered}, {literal(_BREAK)})"
    first, last = "if(_x[0] = '', 1, 0)", "if(size(_x) > 1 and element_at(_x, -1) = '', 1, 0)"
    return let(parts, "_x", f"slice(_x, 1 + {first}, size(_x) - {first} - {last})")


def _together(array: str, by: int, less: int, body: str) -> str:
    """Elements i and i + by of an array put together; the result is ``less`` elements shorter."""
    n = f"size({array}) - {less}"
    return f"zip_with({shifted(array, 0, n)}, {shifted(array, by, n)}, (a, b) -> {body})"


def gram_hashes(array: str, gram: int) -> str:
    """Hashes of all grams of an array of words, by doubling."""
    return let(f"transform({array}, w -> xxhash64(w))", "_h1", _grow("_h", gram, "xxhash64(a, b)"))


def _grow(stem: str, length: int, body: str) -> str:
    """Combine runs of ``length`` elements of ``stem``1: runs of 1, 2, 4, ... and the last two that cover it.

    Runs may overlap, as a hash of two overlapping runs stands for their union just as well, and so does the least.
    """
    size = 1
    nested: list[tuple[str, str]] = []
    while size < length:
        step = min(size, length - size)
        nested.append((f"{stem}{size + step}", _together(f"{stem}{size}", step, step, body)))
        size += step
    out = f"{stem}{length}"
    for name, value in reversed(nested):
        out = let(value, name, out)
    return out


def window_minima(array: str, window: int = WINDOW, gram: int = GRAM) -> str:
    """For every window of an array of words, the least hash of its grams; shorter arrays give none."""
    return let(gram_hashes(array, gram), "_g1", _grow("_g", window - gram + 1, "least(a, b)"))


def _fingerprints(array: str, window: int, gram: int) -> str:
    """``window_minima`` with null in place of a value that the window before has, but for one in each run length."""
    n = window - gram + 1
    before = "concat(array(cast(null as bigint)), slice(_m, 1, greatest(size(_m) - 1, 0)))"
    new = f"zip_with(_m, {before}, (a, b) -> if(a <=> b, cast(null as bigint), a))"
    kept = f"transform(_m, (a, i) -> if(i % {n} = 0, a, cast(null as bigint)))"
    marked = f"if(size(_m) = 0, array(), zip_with({new}, {kept}, (a, b) -> coalesce(a, b)))"
    return let(window_minima(array, window, gram), "_m", marked)


def benchmark_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, length, words): every window of every item; a short item is one window."""
    listed = items.select(
        F.col(quoted(id_col)).alias("item_id"), F.expr(item_words(quoted(text))).alias("w")
    ).filter("size(w) > 0")
    length = f"least(size(w), {window})"
    return listed.select(
        "item_id", "w", F.expr(length).alias("length"), F.explode(F.expr(f"sequence(0, size(w) - {length})")).alias("i")
    ).select("item_id", "length", F.expr("slice(w, i + 1, length)").alias("words")).distinct()


def _joined(left: DataFrame, right: DataFrame, on: str, n_right: int, how: str = "inner") -> DataFrame:
    """Broadcast a side that was counted and is small, else sort and merge."""
    return left.join(F.broadcast(right) if n_right <= BROADCAST_ROWS else right.hint("merge"), on, how)


def find_hits(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM,
    id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(rows, hits). Rows: doc_id, key (a digest of id and text) and n_words of every document. Hits: doc_id, key,
    item_id, start, length of every place where a window of an item occurs."""
    windows = stored(benchmark_windows(items, window, item_id, item_text), "benchmark-windows")
    prints = windows.filter(F.col("length") == window).select(
        F.expr(window_minima("words", window, gram) + "[0]").alias("print")
    ).distinct()
    prints = stored(prints.withColumn("known", F.lit(True)), "benchmark-prints")
    n_prints, n_windows = prints.count(), windows.count()

    cut = docs.select(
        F.col(quoted(id_col)).alias("doc_id"),
        F.xxhash64(F.col(quoted(id_col)), F.col(quoted(text))).alias("key"),
        F.expr(item_words(quoted(text))).alias("w"),
    )
    # The first element stands for the document itself, the others for its windows.
    marked = cut.select(
        "doc_id", "key", "w",
        F.expr(f"concat(array(cast(null as bigint)), {_fingerprints('w', window, gram)})").alias("prints"),
    )
    spread = marked.select("doc_id", "key", "w", F.posexplode("prints").alias("place", "print"))
    spread = spread.filter("place = 0 or print is not null")
    met = _joined(spread, prints, "print", n_prints, "left").filter("place = 0 or known")
    around = f"slice(w, place, {2 * window - gram})"
    found = stored(
        met.select(
            "doc_id", "key", "place",
            F.expr("if(place = 0, cast(size(w) as bigint), null)").alias("n_words"),
            F.expr(f"if(place = 0, null, {around})").alias("around"),
        ),
        "document-prints",
    )
    rows = found.filter("place = 0").select("doc_id", "key", "n_words")
    run = window - gram
    starts = found.filter("place > 0").select(
        "doc_id", "key", "place", "around", F.explode(F.expr(f"sequence(0, least({run}, size(around) - {window}))")).alias("i")
    ).select("doc_id", "key", F.expr("place - 1 + i").alias("start"), F.expr(f"slice(around, i + 1, {window})").alias("words"))
    hits = _joined(starts, windows.filter(F.col("length") == window), "words", n_windows)
    hits = hits.select("doc_id", "key", "item_id", "start", "length")
    lengths = [r["length"] for r in windows.filter(F.col("length") < window).select("length").distinct().collect()]
    for n in sorted(lengths):  # fewer than a window has words
        all_runs = f"if(size(w) < {n}, array(), transform(sequence(0, size(w) - {n}), i -> slice(w, i + 1, {n})))"
        short = cut.select("doc_id", "key", F.posexplode(F.expr(all_runs)).alias("start", "words"))
        short_hits = _joined(short, windows.filter(F.col("length") == n), "words", n_windows)
        hits = hits.unionByName(short_hits.select("doc_id", "key", "item_id", "start", "length"))
    return rows, hits


def _covered() -> Column:
    """Words covered by spans (start, end), of which each start has its longest only."""
    return F.expr(
        "aggregate(array_sort(spans), named_struct('n', 0L, 'upto', 0), (s, x) -> named_struct("
        "'n', s.n + greatest(0, x.upto - greatest(x.start, s.upto)), 'upto', greatest(s.upto, x.upto)), s -> s.n)"
    )


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, key, n_words, n_hit (words inside an item's window), items (ids, as sorted strings)."""
    rows, hits = find_hits(docs, items, **options)
    hits = stored(hits, "benchmark-hits")
    spans = hits.groupBy("doc_id", "key", "start").agg(F.max("length").alias("length"))
    words = spans.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("upto"))).alias("spans")
    ).select("doc_id", "key", _covered().alias("n_hit"))
    found = hits.select("doc_id", "key", F.col("item_id").cast("string").alias("item")).distinct()
    found = found.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    both = words.alias("h").join(found.alias("f"), F.expr("h.doc_id <=> f.doc_id and h.key = f.key"))
    both = both.select("h.doc_id", "h.key", "n_hit", "items")
    joined = rows.alias("r").join(both.alias("b"), F.expr("r.doc_id <=> b.doc_id and r.key = b.key"), "left")
    return joined.select(
        "r.doc_id", "r.key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents in which no item's window occurs, with the columns they came with."""
    _, hits = find_hits(docs, items, id_col=id_col, text=text, **options)
    hit = stored(hits.select(F.col("doc_id").alias("_hit_id"), F.col("key").alias("_hit_key")).distinct(), "contaminated")
    same = F.col(quoted(id_col)).eqNullSafe(F.col("_hit_id")) & (F.xxhash64(F.col(quoted(id_col)), F.col(quoted(text))) == F.col("_hit_key"))
    return docs.join(hit, same, "left_anti")
