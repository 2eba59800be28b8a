"""Near-duplicate embeddings by a forest of random-projection trees.

Trees are fitted per label on a bounded sample: every inner node splits at the
median of a random projection, and what lies near the threshold goes to both
sides. All vectors are sent down all trees. Leaves are compared exactly, large
ones in pairs of blocks, so that no task holds a whole leaf. A pair is counted in
the first leaf that both vectors share; what leaves a leaf is linear in its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.components import components, local_roots
from loanloom.llm.shared import stored

COSINE = 0.98
TREES = 6
#: Half the width of the zone that goes to both sides. Vectors of cosine 0.98 are 0.2
#: apart, which a random direction in 64 dimensions shortens to 0.025 on average.
SPILL = 0.02
LEAF = 256
#: Bound of the sample that trees are fitted on, over all labels.
SAMPLE = 100_000
#: Rows of a block of a leaf; a comparison holds two.
BLOCK = 1024


@dataclass
class Tree:
    """Inner nodes as arrays; a child below 0 is leaf ``-child - 1``."""

    direction: np.ndarray
    threshold: np.ndarray
    children: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, share: float, rng: np.random.Generator, leaf: int = LEAF, spill: float = SPILL) -> Tree:
        """``share`` is the part of all vectors that the sample holds."""
        directions, thresholds, children = [], [], []
        leaves = 0

        def grow(rows: np.ndarray) -> int:
            nonlocal leaves
            if rows.size / share > leaf and rows.size >= 16:
                tried = rng.normal(size=(4, sample.shape[1]))
                tried /= np.linalg.norm(tried, axis=1, keepdims=True)
                at = sample[rows] @ tried.T
                best = int(at.std(axis=0).argmax())
                at, cut = at[:, best], float(np.median(at[:, best]))
                sides = rows[at <= cut + spill], rows[at >= cut - spill]
                if max(s.size for s in sides) <= 0.9 * rows.size:
                    node = len(thresholds)
                    directions.append(tried[best])
                    thresholds.append(cut)
                    children.append([0, 0])
                    children[node] = [grow(sides[0]), grow(sides[1])]
                    return node
            leaves += 1
            return -leaves

        grow(np.arange(sample.shape[0]))
        shape = (len(thresholds), sample.shape[1])
        return cls(np.array(directions).reshape(shape), np.array(thresholds), np.array(children, dtype=np.int64).reshape(-1, 2))

    def leaves(self, vectors: np.ndarray, spill: float = SPILL) -> tuple[np.ndarray, np.ndarray]:
        """Rows and leaves; a row is in several leaves if it lies near a threshold."""
        rows = np.arange(vectors.shape[0])
        if not self.threshold.size:
            return rows, np.zeros(rows.size, dtype=np.int64)
        node = np.zeros(rows.size, dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while rows.size:
            at = np.einsum("ij,ij->i", vectors[rows], self.direction[node]) - self.threshold[node]
            left, right = at <= spill, at >= -spill
            below = np.concatenate([self.children[node[left], 0], self.children[node[right], 1]])
            rows = np.concatenate([rows[left], rows[right]])
            done.append((rows[below < 0], -below[below < 0] - 1))
            rows, node = rows[below >= 0], below[below >= 0]
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of the usable rows, and their vectors in double precision with length 1."""
    rows, found = [], []
    for i, x in enumerate(column):
        if not x.is_valid or x.values.null_count or not len(x.values):
            continue
        v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(v).max()
        if np.isfinite(top) and top > 0:
            v = v / top
            rows.append(i)
            found.append(v / np.sqrt(v @ v))
    return np.array(rows, dtype=np.int64), found


Key = tuple[object, int]


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, vectors = unit_vectors(batch.column("embedding"))
        kept = batch.take(pa.array(rows)).drop_columns(["embedding"])
        unit = pa.array([v for v in vectors], pa.list_(pa.float64()))
        size = pa.array([v.size for v in vectors], pa.int64())
        yield pa.RecordBatch.from_arrays([*kept.columns, unit, size], names=[*kept.schema.names, "unit", "dims"])


def _descend(batches: Iterator[pa.RecordBatch], forest: dict[Key, list[Tree]]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for a in range(0, whole.num_rows, 2000):
            batch = whole.slice(a, 2000)
            keys = list(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist(), strict=True))
            member: list[list[int]] = [[] for _ in keys]
            by_key: dict[Key, list[int]] = {}
            for i, key in enumerate(keys):
                by_key.setdefault(key, []).append(i)
            units = batch.column("unit")
            for key, own in by_key.items():
                trees = forest.get(key)
                if trees is None:  # a label of one leaf
                    for i in own:
                        member[i].append(0)
                    continue
                vectors = np.stack([units[i].values.to_numpy() for i in own])
                for t, tree in enumerate(trees):
                    for r, leaf in zip(*(x.tolist() for x in tree.leaves(vectors)), strict=True):
                        member[own[r]].append(t << 40 | leaf)
            lists = pa.array([sorted(m) for m in member], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "member"])


def _compare(table: pa.Table, cosine: float) -> pa.Table:
    """Weighted links of each vector that are counted here, and a smaller vector it is connected with."""
    table = table.combine_chunks()
    node, weight = table["node"].to_numpy(), table["weight"].to_numpy()
    block = table["block"].to_numpy()
    key = int(table["leaf"][0].as_py())
    units = table["unit"].combine_chunks()
    vectors = units.values.to_numpy()[units.offsets[0].as_py() :].reshape(len(node), -1)
    lists = table["member"].to_pylist()
    width = max(map(len, lists))
    member = np.full((len(lists), width), -1, dtype=np.int64)
    for i, m in enumerate(lists):
        member[i, : len(m)] = m
    low, high = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    same = block.min() == block.max()
    links = np.zeros(len(node), dtype=np.int64)
    firsts, seconds = [], []
    for a in range(0, low.size, 256):
        rows = low[a : a + 256]
        i, j = np.nonzero(vectors[rows] @ vectors[high].T >= cosine)
        i, j = rows[i], high[j]
        if same:
            i, j = i[i < j], j[i < j]
        firsts.append(i)
        seconds.append(j)
        for s in range(0, i.size, 20_000):
            x, y = i[s : s + 20_000], j[s : s + 20_000]
            mx, my = member[x], member[y]
            common = (mx[:, :, None] == my[:, None, :]).any(axis=2) & (mx >= 0)
            first = np.where(common, mx, np.iinfo(np.int64).max).min(axis=1) == key
            np.add.at(links, x[first], weight[y[first]])
            np.add.at(links, y[first], weight[x[first]])
    i, j = np.concatenate(firsts), np.concatenate(seconds)
    root = local_roots(len(node), i, j)
    linked = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
    return pa.table({"node": node[linked], "links": links[linked], "other": node[root[linked]]})


def link(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, sample: int = SAMPLE, leaf: int = LEAF) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding, label``.

    Vectors are linked if their labels are equal and not null, they have as many
    components, and their cosine (double precision) is at least ``cosine``. A null
    vector, one of zeros, or one with a null or non-finite component links with
    nothing. Rows that repeat a vector with its label are linked with each other.
    Null ids come after all others in ``component_id``.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", "label", "embedding")
    equal = rows.filter("label IS NOT NULL AND embedding IS NOT NULL").groupBy("label", "embedding")
    nodes = equal.agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    kind = dict(nodes.dtypes)["label"]
    units = nodes.select("node", "label", "weight", "embedding").mapInArrow(
        _normal, f"node long, label {kind}, weight long, unit array<double>, dims long"
    )
    units = stored(units, "unit-vectors")

    sizes = units.groupBy("label", "dims").count().filter(F.col("count") > leaf)
    total = units.count()
    share = min(1.0, sample / max(total, 1))
    draw = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    large = stored(sizes.select("label", "dims"), "large-labels")
    drawn = units.filter(draw).join(large, ["label", "dims"], "left_semi").select("label", "dims", "unit")
    by_key: dict[Key, list] = {}
    for r in drawn.limit(2 * sample).orderBy(F.xxhash64("unit"), "unit").toLocalIterator():
        by_key.setdefault((r.label, r.dims), []).append(r.unit)
    rng = np.random.default_rng(5)
    forest = {
        k: [Tree.fit(np.array(v), share, rng, leaf) for _ in range(trees)] for k, v in sorted(by_key.items(), key=lambda x: repr(x[0]))
    }
    known = spark.sparkContext.broadcast(forest)
    placed = stored(
        units.mapInArrow(
            lambda b: _descend(b, known.value),
            f"node long, label {kind}, weight long, unit array<double>, dims long, member array<long>",
        ),
        "placed-vectors",
    )
    spread = placed.select("*", F.explode("member").alias("leaf"))
    counts = spread.groupBy("label", "dims", "leaf").count()
    wide = stored(counts.filter(F.col("count") > BLOCK).withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")), "wide-leaves")
    key = ["label", "dims", "leaf"]
    side = wide.select(*key, "blocks")
    spread = spread.join(F.broadcast(side) if side.count() <= 100_000 else side, key, "left")
    blocks = F.coalesce("blocks", F.lit(1))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    pairs = spread.withColumns({"lo": F.least("block", "with"), "hi": F.greatest("block", "with")})
    pairs = pairs.select("node", "weight", "unit", "member", "block", *key, "lo", "hi")
    found = pairs.groupBy(*key, "lo", "hi").applyInArrow(lambda t: _compare(t, cosine), "node long, links long, other long")
    found = stored(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select("node", "other")).withColumnRenamed("u", "node")
    rooted = nodes.select("node", "weight", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("v", "node"))
    rooted = stored(rooted, "vector-roots")
    smallest = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "vector-components")
    usable = placed.select("node").withColumn("usable", F.lit(True))
    result = rooted.join(smallest, "root").join(links, "node", "left").join(usable, "node", "left")
    own = F.when(F.col("usable"), F.coalesce("links", F.lit(0)) + F.col("weight") - 1)
    per_node = stored(result.select("node", own.alias("n"), "component_id"), "vector-results")
    keyed = nodes.select("label", "embedding", "node").join(per_node, "node").drop("node")
    keyed = stored(keyed.filter("n IS NOT NULL"), "vector-keys")
    joined = rows.join(keyed, ["label", "embedding"], "left")
    component = F.when(F.col("n").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
