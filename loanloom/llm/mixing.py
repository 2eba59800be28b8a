"""Mixing sources to target weights by weighted fair queueing.

Every shuffled document gets a virtual time, its source's words up to it divided
by the source's target; the mix takes documents in the order of that time until
the budget is spent. Only DataFrame functions are used. Running sums are taken
in two steps (within buckets of hashed documents, and over the buckets' sums),
so that a source with a third of all rows, or one range of virtual time, never
meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.shared import stored

#: Weights in the order of the sources, repeating.
WEIGHTS = (5, 2, 1)
#: The budget as a share of all words, and how often a document may be taken.
SHARE = (3, 2)
COPIES = 2
#: Rows that one bucket of a source is meant to hold.
BUCKET_ROWS = 4096


def size_of(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: ``source, rows, source_size, target``.

    Weights go round in code-point order, null last. The level ``l`` at which
    the sum of min(l * weight, copies * size) meets the budget gives the targets;
    reshaping the excess again and again ends there. It is found by running
    sums over the sources in the order in which they fill up.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.row_number().over(in_order) - 1) % len(weights) + 1)
    ranked = totals.withColumn("weight", weight)
    fill = [F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.encode("source", "utf-8")]
    filling = Window.orderBy(*fill).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # With the sources before this one full, the level that spends the rest of the budget.
    full = F.coalesce(F.sum("source_size").over(filling), F.lit(0)) * COPIES
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    budget = F.sum("source_size").over(everything) * SHARE[0]
    level = (budget - full * SHARE[1]) / (open_weight * SHARE[1])
    bound = F.col("source_size") * COPIES
    leveled = ranked.withColumn("own_level", level).withColumn("open", F.col("own_level") * F.col("weight") <= bound)
    # The first source (in filling order) that its level does not fill sets the level.
    set_by = F.min(F.when(F.col("open"), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(fill)], F.col("own_level")))).over(everything)
    final = F.least(set_by["own_level"] * F.col("weight"), bound.cast("double"))
    return leveled.select("source", "rows", "source_size", F.coalesce(final, bound.cast("double")).alias("target"))


def virtual_times(docs: DataFrame, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """Every document's place in its source's queue, and the targets.

    ``docs`` has ``doc_id, source, size`` and may have more, under any names but
    those that begin with ``__mix_``. Added are ``source_size``, ``target`` and
    ``queued`` (in place of columns so called): the words of the source before the
    document, in the order of a hash. The hash is of the id; rows without one are
    told apart by their place in the input, so that they spread over the buckets
    like others and reruns over the same files agree. Documents with equal ids and
    sizes are interchangeable.
    """
    kept = docs.drop("source_size", "target", "queued")
    known = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(seed))
    placed = F.concat_ws(":", known, F.monotonically_increasing_id().cast("string"))
    draw = F.md5(F.when(F.col("doc_id").isNull(), placed).otherwise(known).cast("binary"))
    # Written once: the texts behind the sizes are counted in one pass, and a place is drawn once.
    drawn = stored(kept.withColumn("__mix_draw", draw), "mix-sizes")
    targets = stored(source_targets(drawn), "mix-targets")
    side = targets.select(F.col("source").alias("__mix_source"), F.col("rows").alias("__mix_rows"), "source_size", "target")
    part = F.conv(F.substring("__mix_draw", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("__mix_rows") / F.lit(BUCKET_ROWS))
    joined = drawn.join(
        F.broadcast(side) if targets.count() <= 50_000 else side, F.col("source").eqNullSafe(F.col("__mix_source"))
    ).withColumn("__mix_bucket", F.floor(part * buckets / F.lit(float(1 << 32))))
    sums = joined.groupBy("source", "__mix_bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("__mix_s"),
        F.col("__mix_bucket").alias("__mix_b"),
        F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("__mix_offset"),
    )
    within = Window.partitionBy("source", "__mix_bucket").orderBy("__mix_draw", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = joined.withColumn("__mix_inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    queued = inner.join(
        offsets, F.col("source").eqNullSafe(F.col("__mix_s")) & (F.col("__mix_bucket") == F.col("__mix_b"))
    ).withColumn("queued", F.col("__mix_inner") + F.col("__mix_offset"))
    return queued.select(*[F.col(f"`{c}`") for c in kept.columns], "source_size", "target", "queued"), targets


def time_of(copy: int) -> Column:
    """Virtual time of a document's ``copy``: when half of it has passed, as a share of the target."""
    words = F.col("queued") + F.lit(copy) * F.col("source_size") + F.col("size") / F.lit(2.0)
    return F.when(F.col("target") > 0, words / F.col("target"))


def cut_time(queued: DataFrame, bins: int) -> float:
    """The virtual time at which the words taken so far meet the budget.

    Bins of virtual time are summed first; rows are sorted only within the bin
    in which the budget runs out. With about as many bins as rows in a bin, both
    steps stay near the square root of the input.
    """
    copies = queued.filter("size > 0").select("size", F.explode(F.array(*[time_of(k) for k in range(COPIES)])).alias("time"))
    copies = copies.withColumn("bin", F.floor(F.least(F.col("time"), F.lit(4.0)) * bins))
    order = Window.orderBy("bin")
    budget = queued.select(F.sum("size")).first()[0] or 0
    sums = copies.groupBy("bin").agg(F.sum("size").alias("words"))
    reached = sums.select("bin", "words", F.sum("words").over(order).alias("total"))
    last = reached.filter(F.col("total") * SHARE[1] >= F.lit(budget * SHARE[0])).orderBy("bin").first()
    if last is None:
        return float("inf")
    spent = last.total - last.words
    inside = Window.orderBy("time", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = copies.filter(F.col("bin") == last.bin).withColumn("total", F.sum("size").over(inside) + F.lit(spent))
    taken = run.filter((F.col("total") * 2 - F.col("size")) * SHARE[1] <= F.lit(2 * budget * SHARE[0]))
    found = taken.agg(F.max("time")).first()[0]
    return found if found is not None else last.bin / bins


def mix(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``copies`` and ``taken``.

    ``docs`` has ``doc_id, source, size`` (see `size_of`). Sources share 150 % of
    all words by weight, at most twice their own; ``copies`` (0 to 2) is how often
    the mix takes the document, ``taken`` the words of it. A document is taken
    whole or not at all, so a source meets its target within half a document at
    the cut. Empty documents are taken 0 times. A null source is a source; rows
    without an id count like others. An empty table gives an empty mix.
    """
    queued, _ = virtual_times(docs.drop("copies", "taken"), seed)
    queued = stored(queued, "mix-queue")
    bins = max(64, math.isqrt(COPIES * queued.count()))
    cut = cut_time(queued, bins)
    count = sum((F.coalesce(time_of(k) <= F.lit(cut), F.lit(False)).cast("long") for k in range(COPIES)), F.lit(0))
    counted = queued.withColumn("copies", F.when(F.col("size") > 0, count).otherwise(F.lit(0)).cast("long"))
    return counted.withColumn("taken", F.col("copies") * F.col("size"))


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of every document."""
    return docs.select("doc_id", "source", size_of(F.col("text")).alias("size"))
