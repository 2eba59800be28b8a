"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.shared import stored


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: every node but the smallest of its component, and that smallest node.

    ``edges`` has two long columns; direction, repetition and loops do not
    matter. Large-star and small-star rounds (each a minimum per node and a
    join) shorten all paths until only stars are left, which is so once no node
    with a smaller neighbour has a second one; the number of rounds grows with the
    logarithm of the longest path. The minima are written before they are joined,
    so that a hub's edges can be split over tasks.
    """
    a, b = edges.columns
    now = stored(
        edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        around = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        around = stored(around, "star")
        if around.filter("m < u AND n > 1").isEmpty():
            return now
        least = around.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")


def joined_by(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` after further ``links``: only their roots are connected anew."""
    a, b = links.columns
    first = found.select(F.col("u").alias(a), F.col("v").alias("ra"))
    second = found.select(F.col("u").alias(b), F.col("v").alias("rb"))
    lifted = links.join(first, a, "left").join(second, b, "left").select(F.coalesce("ra", a).alias("a"), F.coalesce("rb", b).alias("b"))
    more = components(lifted)
    moved = found.join(more.select(F.col("u").alias("v"), F.col("v").alias("w")), "v", "left")
    return stored(moved.select("u", F.coalesce("w", "v").alias("v")).unionByName(more), "roots")


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows is connected with, for edges within one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new
