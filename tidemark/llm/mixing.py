"""Mixing sources to target weights by Pareto order sampling.

Every source gets a share of all words in proportion to its weight, at most ``MAX_COPIES`` times its own
size; what is over goes to the others by weight. Within a source, documents expect copies in proportion to
their own weight, again ``MAX_COPIES`` at most. The whole part of that number is certain. For the rest, documents are
ranked by the odds of a random number divided by the odds of inclusion (Pareto order sampling), and taken
in that order until the next one would exceed the source's words: a sample of fixed size with unequal
probabilities. Where a long document stops it, ``FILLS`` more rounds go on in the same order, each among the documents
that are no longer than what is missing. The last place goes to the document whose size comes nearest to what is
still missing then.

All of it is DataFrame expressions. Documents are summed by (source, weight class) and by bins of the rank
before anything is ordered, so that only the documents of the one bin in which a source's cut of a round falls meet
in a task, besides the sources' and the bins' sums, one row each.

Defined results: null texts and texts without a word have size 0 and are never taken; a null source is a
source of its own, the last; a null, zero or negative document weight counts as 1; repeated rows are
documents of their own, but are taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import stored

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
RANK_BINS = 65_536
FILLS = 3  # rounds after the first
SEED = "mix"
LEAST = 1e-9  # smaller remainders of a number of copies count as none


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def filled(groups: DataFrame, within: list[str], weight: Column, room: Column, total: Column) -> Column:
    """What each group gets of a total shared by weight, where no group gets more than its room.

    Groups are listed by the level (amount per weight) at which they are full. The level that holds is the
    largest one reached by sharing what the groups before it leave, among the groups not yet full at it.
    """
    listed = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    by_level = listed.orderBy(room / weight, weight, room)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    taken = F.coalesce(F.sum(room).over(before), F.lit(0.0))
    level = (total - taken) / F.sum(weight).over(onward)
    leveled = groups.withColumn("_level", F.when(level <= room / weight, level))
    leveled = leveled.withColumn("_holds", F.max("_level").over(listed))
    return leveled.withColumn(
        "_filled", F.least(room, F.coalesce(F.col("_holds") * weight, room))
    ).drop("_level", "_holds")


def random_number(doc_id: Column, seed: str = SEED) -> Column:
    """A number inside (0, 1) from the hash of the seed and the id."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(2**52))


def rank(doc_id: Column, chance: Column, seed: str = SEED) -> Column:
    """The Pareto rank: odds of the random number over odds of inclusion."""
    u = random_number(doc_id, seed)
    return (u / (1 - u)) * ((1 - chance) / chance)


def weight_class(weight: Column | None) -> Column:
    """Document weights rounded to eighths of a power of two, as a whole number; at most 161 classes."""
    if weight is None:
        return F.lit(0)
    sane = F.when(weight > 0, weight).otherwise(1.0).cast("double")
    return F.least(F.greatest(F.round(F.log2(sane) * 8), F.lit(-80)), F.lit(80)).cast("int")


def sized(documents: DataFrame, size: Column, weight: Column | None) -> DataFrame:
    """doc_id, source, size and weight class, stored so that the texts are read once."""
    return stored(
        documents.select("doc_id", "source", size.alias("size")).withColumn(
            "class", weight_class(weight)
        )
    )


def allot(
    sizes: DataFrame,
    source_weights: tuple[int, ...] = SOURCE_WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """A row for each source and weight class: source_size, target, whole copies, chance of one more.

    ``round_0``, ``round_1``... tell which documents are taken once more in a round: those of up to ``limit`` words, to the
    last one ``cut`` in ``cut_bin`` (all where that is null); ``gap`` what is missing after them, ``closing`` the
    document that fills it. ``sizes`` has doc_id, source, size and class.
    """
    classes = sizes.groupBy("source", "class").agg(
        F.sum("size").alias("words"), F.count("*").alias("documents")
    )
    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    listed = Window.partitionBy(F.lit(0))
    place = F.row_number().over(listed.orderBy(F.col("source").asc_nulls_last()))
    sources = sources.withColumn(
        "weight",
        F.element_at(F.array(*map(F.lit, source_weights)), ((place - 1) % len(source_weights) + 1)),
    ).withColumn("everything", F.sum("source_size").over(listed).cast("double"))
    sources = filled(
        sources, [], F.col("weight").cast("double"), max_copies * F.col("source_size").cast("double"),
        F.col("everything"),
    ).withColumnRenamed("_filled", "target")
    sources = sources.select(F.col("source").alias("_s"), "source_size", "target")
    classes = classes.join(sources, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    words = F.col("words").cast("double")
    importance = F.pow(F.lit(2.0), F.col("class") / 8) * words
    classes = classes.withColumn("_weight", F.when(words > 0, importance).otherwise(1.0))
    classes = filled(classes, ["source"], F.col("_weight"), max_copies * words, F.col("target"))
    expected = F.when(words > 0, F.col("_filled") / words).otherwise(0.0)
    classes = classes.withColumn("whole", F.floor(expected + LEAST))
    classes = classes.withColumn("chance", expected - F.col("whole"))
    classes = classes.withColumn("chance", F.when(F.col("chance") > LEAST, F.col("chance")))
    certain = F.sum(F.col("whole") * F.col("words")).over(Window.partitionBy("source"))
    plan = stored(
        classes.withColumn("gap", F.col("target") - certain).select(
            "source", "class", "source_size", "target", "whole", "chance", "gap"
        )
    )
    drawn = with_plan(sizes, plan, seed).where(F.col("chance").isNotNull() & (F.col("size") > 0))
    ranked = stored(drawn.select("source", "doc_id", "size", "rank"))
    state = plan.groupBy("source").agg(F.max("gap").alias("gap"))
    for k in range(1 + FILLS):
        steps = _round(_open(ranked, state, k).where(F.col("size") <= F.col("gap")), k)
        state = state.join(steps, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        state = stored(state.withColumn("gap", F.col("gap") - F.coalesce("used", F.lit(0))).drop("used"))
    left = _open(ranked, state, 1 + FILLS)
    off = F.abs(F.col("gap") - F.col("size"))
    closing = F.min(F.struct(off, "rank", "doc_id", "size")).alias("closing")
    nearest = left.where(off < F.col("gap")).groupBy(F.col("source").alias("_s")).agg(closing)
    state = state.join(nearest, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "gap")
    state = state.withColumnRenamed("source", "_s")
    return stored(plan.join(state, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "gap"))


def _open(ranked: DataFrame, state: DataFrame, rounds: int) -> DataFrame:
    """The documents that may be taken once more, and are not after so many rounds."""
    keyed = state.withColumnRenamed("source", "_s")
    held = ranked.join(keyed, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return held.where(~inside(F.col("size"), rounds))


def _round(open_: DataFrame, k: int) -> DataFrame:
    """The cut of each source that has open documents: ``_s``, the round, and the words ``used`` by it."""
    ranked = open_.select("source", "doc_id", "size", "gap", "rank", bin_of(F.col("rank")).alias("bin"))
    bins = ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.max("gap").alias("gap"))
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    totals = bins.groupBy("source").agg(F.sum("words").alias("words"), F.max("gap").alias("limit"))
    last = bins.where((F.col("before") <= F.col("gap")) & (F.col("gap") < F.col("before") + F.col("words")))
    last = last.select(F.col("source").alias("_s"), F.col("bin").alias("_b"), "before")
    near = ranked.join(
        last, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bin") == F.col("_b"))
    ).drop("_s", "_b")
    order = Window.partitionBy("source").orderBy("rank", F.col("doc_id").asc_nulls_first(), "size")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn(
        "start", F.col("before") + F.coalesce(F.sum("size").over(earlier), F.lit(0))
    ).withColumn("place", F.row_number().over(order))
    near = near.withColumn("fits", F.col("start") + F.col("size") <= F.col("gap"))
    spot = F.struct("rank", "doc_id", "size")
    cuts = near.groupBy(F.col("source").alias("_c"), F.col("bin").alias("cut_bin")).agg(
        F.max_by(spot, F.when(F.col("fits"), F.col("place"))).alias("cut"),
        F.coalesce(F.max(F.when(F.col("fits"), F.col("start") + F.col("size"))), F.max("before")).alias("used"),
    )
    return totals.join(cuts, F.col("source").eqNullSafe(F.col("_c")), "left").select(
        F.col("source").alias("_s"),
        F.struct("limit", "cut_bin", "cut").alias(f"round_{k}"),
        F.coalesce("used", "words").alias("used"),
    )


def with_plan(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Each row with what its source and class are allotted, and its rank."""
    keyed = plan.withColumnRenamed("source", "_s").withColumnRenamed("class", "_c")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("class") == F.col("_c"))
    joined = rows.join(keyed, same, "left").drop("_s", "_c")
    return joined.withColumn("rank", rank(F.col("doc_id"), F.col("chance"), seed))


def bin_of(rank_: Column) -> Column:
    return F.floor(rank_ / (1 + rank_) * RANK_BINS)


def inside(size: Column, rounds: int = 1 + FILLS) -> Column:
    """Whether a row with its rank and rounds is taken in one of the first rounds."""
    spot = F.struct("rank", "doc_id", size.alias("size"))
    found = F.lit(False)
    for k in range(rounds):
        limit, cut_bin, cut = (F.col(f"round_{k}.{c}") for c in ("limit", "cut_bin", "cut"))
        own = bin_of(F.col("rank"))
        before = cut_bin.isNull() | (own < cut_bin) | ((own == cut_bin) & (spot <= cut))
        found = found | F.coalesce((size <= limit) & before, F.lit(False))
    return found


def copies(size: Column) -> Column:
    """How often a row joined to its plan is taken."""
    closes = F.col("closing.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("closing.size") == size)
    extra = F.coalesce(closes, F.lit(False)) | inside(size)
    once_more = F.when(F.col("chance").isNotNull() & extra, 1).otherwise(0)
    return F.when(size > 0, F.col("whole") + once_more).otherwise(0).cast("bigint")


def mixed(
    sizes: DataFrame,
    source_weights: tuple[int, ...] = SOURCE_WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of each row of ``sized``."""
    plan = allot(sizes, source_weights, max_copies, seed)
    return with_plan(sizes, plan, seed).select(
        "doc_id", "source", "size", "source_size", "target",
        copies(F.col("size")).alias("copies"),
        (copies(F.col("size")) * F.col("size")).alias("taken"),
    )


def mix(
    documents: DataFrame,
    size: Column | None = None,
    weight: Column | None = None,
    source_weights: tuple[int, ...] = SOURCE_WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """The mix itself: every document as often as it is taken, with all its columns.

    Columns of ``documents`` may have any names; those that the work needs are held in a struct apart.
    """
    size = word_count(F.col("text")) if size is None else size
    held = documents.select(
        F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("_row"),
        F.col("doc_id"),
        F.col("source"),
        size.alias("size"),
    ).withColumn("class", weight_class(weight))
    plan = allot(sized(documents, size, weight), source_weights, max_copies, seed)
    counted = with_plan(held, plan, seed).select("_row", copies(F.col("size")).alias("_copies"))
    repeated = counted.where("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))
    )
    return repeated.select("_row.*")
