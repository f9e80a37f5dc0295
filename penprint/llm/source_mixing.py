"""Mixing sources to target weights: Sainte-Laguë quotas of equal-token blocks, then seeded block selection.

A source's words form one line, its documents in a seeded order, cut into blocks of equal length. Blocks are shared
out to sources by highest quotients target / (2 seats + 1), first for one shard, then for the next; as the method is
house-monotone, the quotas of shard k are the seats that come with its share of the blocks. A source with quota q
and n blocks gives each block q // n times, and q % n blocks, an arc of the line from a seeded start, once more.
Documents lie in seeded order, so an arc is a random choice of documents, and all but those at its ends are whole.

Per-source figures stay tables; window steps over them see one row for each source. Places on the line are prefix
sums over ranges of the order key, so a source with a third of all rows is summed by many tasks.

Defined results: null is a source of its own, ordered last; null and empty texts have size 0 and are never taken;
documents with one id and text are adjacent; an empty table gives an empty result. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from penprint.llm.exprs import quoted, words
from penprint.session import stored

#: A source gives each of its words at most so often.
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
_KEY_BITS = 60


def _key(seed: int, *columns: Column) -> Column:
    parts = [F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("\x00")) for c in columns]]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source of (source, size): its size, weight and target words.

    Targets share all words by weight; what is above ``most`` times a source's size is shared again among the
    others. That ends where target = min(cap, level x weight), and the level follows from sources in order of
    cap / weight: with all before a source at their caps, the first whose cap reaches its share sets it.
    """
    table = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank - 1) % len(weights) + 1)
    ranked = table.select("source", "source_size", rank.alias("rank"), weight.alias("weight"))
    cap = F.col("source_size") * most
    line = Window.orderBy(cap / F.col("weight"), "rank")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    after = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = ranked.select(
        "*",
        ((F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
         / F.sum("weight").over(after)).alias("own_level"),
    )
    reached = F.when(F.col("own_level") * F.col("weight") <= cap, F.struct(cap / F.col("weight"), "rank", "own_level"))
    level = F.min(reached).over(everything)["own_level"]
    return levels.withColumn("level", level).select(
        "source", "source_size", "rank", "weight",
        F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"),
    )


def block_quotas(targets: DataFrame, n_shards: int) -> DataFrame:
    """Per shard and source (rank), of (rank, target, house): the whole blocks that Sainte-Laguë gives it, summing to the shard's share.

    For the blocks of the first k shards, rounding target / divisor with the mean divisor gives seats near the
    right sum; the few missing go to the highest next quotients, the few too many are taken from the lowest.
    """
    total = F.sum("target").over(Window.partitionBy())
    totals = targets.select("rank", "target", "house", total.alias("total"))
    shards = totals.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_shards))).alias("k"))
    houses = shards.withColumn("house", F.floor(F.col("house") * F.col("k") / n_shards).cast("bigint"))
    quota = F.when(F.col("total") > 0, F.col("target") * F.col("house") / F.col("total")).otherwise(0.0)
    by_k = Window.partitionBy("k")
    base = houses.withColumn("quota", quota).withColumn("seats", F.floor(F.col("quota") + 0.5).cast("bigint"))
    base = base.withColumn("missing", F.col("house") - F.sum("seats").over(by_k))
    base = base.withColumn("sources", F.count("*").over(by_k))
    share = F.when(F.col("total") > 0, F.col("target") / F.col("total")).otherwise(0.0)
    reach = F.ceil((F.abs("missing") + F.col("sources")) * share).cast("bigint") + 1
    steps = base.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), reach)).alias("step"))
    up = F.col("target") / (2 * (F.col("seats") + F.col("step")) - 1)
    down = F.when(F.col("seats") >= F.col("step"), F.col("target") / (2 * (F.col("seats") - F.col("step")) + 1))
    steps = steps.withColumn("up", F.when(F.col("target") > 0, up)).withColumn("down", down)
    nth_up = F.row_number().over(by_k.orderBy(F.col("up").desc_nulls_last(), "rank"))
    nth_down = F.row_number().over(by_k.orderBy(F.col("down").asc_nulls_last(), F.col("rank").desc()))
    moved = (
        F.when((nth_up <= F.col("missing")) & F.col("up").isNotNull(), 1)
        .when((nth_down <= -F.col("missing")) & F.col("down").isNotNull(), -1).otherwise(0)
    )
    seats = (
        steps.withColumn("moved", moved).groupBy("k", "rank", "seats").agg(F.sum("moved").alias("moved"))
        .select("k", "rank", (F.col("seats") + F.col("moved")).alias("upto"))
    )
    earlier = F.lag("upto", 1, 0).over(Window.partitionBy("rank").orderBy("k"))
    return seats.select((F.col("k") - 1).alias("shard"), "rank", (F.col("upto") - earlier).alias("blocks"))


def plan_mix(
    docs: DataFrame, seed: int = 0, n_shards: int = 24, n_blocks: int = 1 << 20, rows_per_task: int = 50_000,
    id_col: str = "doc_id", text: str = "text", source: str = "source",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the mix takes: (per document, per source, quotas per shard and source).

    Per document: doc_id, digest of its text, size, source_size, target, taken, and the arc of its words that is
    taken once more than ``passes``: from word ``cut_a`` on ``len_a`` words, and ``len_b`` words from its start.
    """
    sizes = stored(
        docs.select(
            F.col(quoted(id_col)).alias("doc_id"),
            F.md5(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("digest"),
            F.col(quoted(source)).cast("string").alias("source"),
            F.expr(f"cast(size({words(quoted(text))}) as bigint)").alias("size"),
        ).withColumn("key", _key(seed, F.col("doc_id"), F.col("digest"))),
        "mix-sizes",
    )
    everything = Window.partitionBy()
    targets = source_targets(sizes).withColumn("words", F.sum("source_size").over(everything))
    targets = targets.withColumn("block", F.greatest(F.lit(1), F.floor(F.col("words") / n_blocks)).cast("bigint"))
    targets = stored(targets, "mix-targets")
    house = F.floor(F.col("words") / F.col("block")).cast("bigint")
    quotas = stored(block_quotas(targets.withColumn("house", house), n_shards), "mix-quotas")

    blocks = F.ceil(F.col("source_size") / F.col("block")).cast("bigint")
    per_source = (
        targets.join(quotas.groupBy("rank").agg(F.sum("blocks").alias("given")), "rank")
        .withColumn("n", F.greatest(blocks, F.lit(1)))
        .withColumn("quota", F.least("given", F.col("n") * MOST_REPEATS))
        .select(
            "source", "source_size", "target", "block", "n", "quota",
            F.floor(F.col("quota") / F.col("n")).cast("bigint").alias("passes"),
            (F.col("quota") % F.col("n")).alias("more"),
            F.pmod(_key(seed, F.lit("arc"), F.col("source")), F.col("n")).alias("start"),
        )
    )
    total = sizes.count()
    bits = max(0, (max(total, 1) // rows_per_task).bit_length())
    binned = sizes.withColumn("part", F.shiftright("key", _KEY_BITS - bits))
    # Null sources group together; a flag beside an empty name keeps joins plain equalities.
    named = [F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("unnamed")]
    binned = binned.select("doc_id", "digest", "size", "key", "part", *named)
    along = Window.partitionBy("name", "unnamed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        binned.groupBy("name", "unnamed", "part").agg(F.sum("size").alias("words"))
        .select("name", "unnamed", "part", F.coalesce(F.sum("words").over(along), F.lit(0)).alias("before"))
    )
    facts = starts.join(per_source.select(*named, *[c for c in per_source.columns if c != "source"]), ["name", "unnamed"])
    inside = (
        Window.partitionBy("name", "unnamed", "part").orderBy("key", "doc_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        binned.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(facts, ["name", "unnamed", "part"])
        .withColumn("at", F.col("before") + F.col("ahead"))
    )
    # The arc covers words [from, to) of the line and, where it runs over its end, [0, wrap).
    end = (F.col("start") + F.col("more")) * F.col("block")
    line_end = F.col("n") * F.col("block")
    overlap = lambda a, b: F.greatest(F.lit(0), F.least(F.col("at") + F.col("size"), b) - F.greatest("at", a))
    first = F.col("start") * F.col("block")
    per_doc = placed.select(
        "doc_id", "digest", "size", "source_size", "target", "passes",
        F.greatest(F.lit(0), F.least(F.col("size"), first - F.col("at"))).alias("cut_a"),
        overlap(first, F.least(end, line_end)).alias("len_a"),
        overlap(F.lit(0), F.greatest(F.lit(0), end - line_end)).alias("len_b"),
    ).withColumn("taken", F.col("size") * F.col("passes") + F.col("len_a") + F.col("len_b"))
    return per_doc, per_source, quotas


def mix_documents(docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus in the columns of ``docs``: a row for each pass over a document.

    A document at an end of the arc gives the taken words only, joined by single spaces, in its last pass; an
    ``n_chars`` column then follows the text.
    """
    plan, _, _ = plan_mix(docs, seed, id_col=id_col, text=text, source=source)
    # Rows with one id and one text are the same document twice: a running number pairs each with its own share.
    again = Window.partitionBy("doc_id", "digest").orderBy("cut_a", "len_a", "len_b")
    plan = stored(plan.withColumn("nth", F.row_number().over(again)), "mix-plan")
    repeated = not plan.filter("nth > 1").isEmpty()  # if not, documents need no number of their own
    plan = plan.filter("taken > 0")
    plan = plan.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")).alias("_mix_id"), F.col("digest").alias("_mix_digest"),
        F.col("nth").alias("_mix_nth"), "size", "passes", "cut_a", "len_a", "len_b",
    ).select("_mix_id", "_mix_digest", "_mix_nth", F.struct("size", "passes", "cut_a", "len_a", "len_b").alias("_mix"))
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_mix_row"),
        F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("\x00")).alias("_mix_id"),
        F.md5(F.coalesce(F.col(quoted(text)), F.lit(""))).alias("_mix_digest"),
    )
    number = F.row_number().over(Window.partitionBy("_mix_id", "_mix_digest").orderBy("_mix_digest"))
    numbered = keyed.withColumn("_mix_nth", number if repeated else F.lit(1))
    m = F.col("_mix")
    more = m["len_a"] + m["len_b"]
    copies = m["passes"] + F.when(more > 0, 1).otherwise(0)
    joined = numbered.join(plan, ["_mix_id", "_mix_digest", "_mix_nth"]).withColumn(
        "_mix_pass", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))
    )
    cut = (F.col("_mix_pass") > m["passes"]) & (more < m["size"])
    row_text = F.col(f"_mix_row.{quoted(text)}")
    parts = F.expr(
        f"""array_join(concat(slice(w, 1, cast(_mix.len_b as int)), slice(w, cast(_mix.cut_a + 1 as int), cast(_mix.len_a as int))), ' ')"""
        .replace("w,", f"{words('_mix_row.' + quoted(text))},")
    )
    new_text = F.when(cut, parts).otherwise(row_text)
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(new_text.alias(c))
        elif c == "n_chars":
            columns.append(F.when(cut, F.char_length(parts)).otherwise(F.col("_mix_row.n_chars")).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"_mix_row.{quoted(c)}").alias(c))
    return joined.select(*columns)
