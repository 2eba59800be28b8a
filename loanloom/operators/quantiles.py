"""Exact order statistics of value counts, without a task that sees all values."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.session import scratch_path

_PART = "__part"


def by_ranges(frequencies: DataFrame, value: str) -> DataFrame:
    """The table dealt into ranges of ``value``, with the range's number, in the shared folder.

    Ranges follow one another in the order of the values, so the rank of a value is its
    rank within its range and the sizes of the ranges before.
    """
    path = scratch_path(frequencies.sparkSession, "ranges")
    dealt = frequencies.repartitionByRange(value).withColumn(_PART, F.spark_partition_id())
    dealt.write.parquet(path)
    return frequencies.sparkSession.read.schema(dealt.schema).parquet(path)


def exact_quantiles(ranged: DataFrame, value: str, weight: str, probabilities: Sequence[float]) -> list[float] | None:
    """Interpolated quantiles of values that count ``weight`` times each; None without any.

    ``ranged`` comes from `by_ranges` and has each value once. One pass adds the weights up
    per range; then only the ranges in which a wanted rank lies are summed up value by value,
    a range to a task.
    """
    held = ranged.filter(F.col(weight) > 0)
    sizes = sorted(tuple(r) for r in held.groupBy(_PART).agg(F.sum(weight)).collect())  # as many rows as ranges
    total = sum(n for _, n in sizes)
    if not total:
        return None
    before = dict(zip([part for part, _ in sizes], accumulate([0, *[n for _, n in sizes]]), strict=False))
    places = [p * (total - 1) for p in probabilities]
    ranks = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})
    part_of = {r: max((part for part, _ in sizes if before[part] <= r)) for r in ranks}
    order = Window.partitionBy(_PART).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = held.filter(F.col(_PART).isin(sorted(set(part_of.values())))).withColumn("__upto", F.sum(weight).over(order))
    found = summed.agg(
        *[
            F.min(F.when((F.col(_PART) == part_of[r]) & (F.col("__upto") > r - before[part_of[r]]), F.col(value))).alias(str(r))
            for r in ranks
        ]
    ).first()
    at = dict(zip(ranks, found, strict=True))
    quantiles = []
    for x in places:
        lo, hi = math.floor(x), math.ceil(x)
        quantiles.append(float(at[lo]) if lo == hi or at[lo] == at[hi] else (hi - x) * at[lo] + (x - lo) * at[hi])
    return quantiles
