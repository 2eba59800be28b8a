"""Near-duplicate documents by ProbMinHash signatures, banding and verification.

Signatures come from a Poisson process per shingle: its arrivals fall on random
components until none can be earlier than what the document already has. Equal
bands make candidates; a bucket is checked against its most central member
first, and only buckets that this leaves in different components are compared
further, in pairs of blocks within tasks, so buckets of close copies cost as many
comparisons as they have members, and what is written stays linear. Every link is verified on the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.components import components, joined_by, local_roots
from loanloom.llm.shared import stored
from loanloom.llm.text import WORD_BYTES, Words, hashed_windows, mix, released, steps

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares none of 25 bands of 5 with probability 5e-5.
BANDS = 25
ROWS = 5
#: Nodes whose keys are broadcast at most (24 bytes each); beyond it the join shuffles.
BROADCAST_NODES = 500_000
#: Members of a bucket that one block holds, and shingles compared at once.
BLOCK = 256
COLUMNS = 4096


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def prob_min_hash(elements: np.ndarray, bounds: np.ndarray, size: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The signature of each document: an element for each of ``size`` components.

    ``elements[bounds[i]:bounds[i + 1]]`` are document i's. Two documents agree
    in a component with their probability Jaccard similarity; with equal weights
    (None) this is the Jaccard similarity of the sets, and repeated elements count
    once. A document without elements has zeros.
    """
    n = bounds.size - 1
    best = np.full(n * size, np.inf)
    chosen = np.zeros(n * size, dtype=np.uint64)
    doc = np.repeat(np.arange(n), np.diff(bounds))
    element = elements
    rate = np.ones(element.size) if weights is None else weights.astype(np.float64)
    arrival = np.zeros(element.size)
    turn = 0
    while element.size:
        turn += 1
        bits = mix(element + np.uint64((turn * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        arrival = arrival - np.log(_uniform(bits)) / rate
        at = doc * size + (mix(bits) % np.uint64(size)).astype(np.int64)
        earlier = np.flatnonzero(arrival < best[at])
        order = earlier[np.argsort(-arrival[earlier], kind="stable")]
        best[at[order]] = arrival[order]  # of several on one component the earliest is written last
        chosen[at[order]] = element[order]
        open_docs = np.unique(doc)
        latest = np.zeros(n)
        latest[open_docs] = best.reshape(n, size)[open_docs].max(axis=1)
        keep = arrival < latest[doc]
        doc, element, rate, arrival = doc[keep], element[keep], rate[keep], arrival[keep]
    return chosen.reshape(n, size)


def counted(elements: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each document's distinct elements, sorted, with their counts, and new bounds."""
    doc = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
    order = np.lexsort((elements, doc))
    e, d = elements[order], doc[order]
    new = np.ones(e.size, dtype=bool)
    new[1:] = (e[1:] != e[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return e[at], np.diff(np.append(at, e.size)), np.searchsorted(d[at], np.arange(bounds.size))


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(signatures.shape[0], bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], weighted: bool, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text"):
        words = Words(batch.column("__text"), WORD_BYTES)
        shingles, bounds = hashed_windows(words.hashes(), words.bounds, SHINGLE)
        weights = None
        if weighted:
            shingles, weights, bounds = counted(shingles, bounds)
        keys = band_keys(prob_min_hash(shingles, bounds, bands * rows, weights), bands, rows)
        some = np.diff(bounds) > 0
        edges = np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)
        rest = [c for c in batch.schema.names if c != "__text"]
        lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(keys[some].reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [lists], names=[*rest, "__bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text"):
        words = Words(batch.column("__text"), WORD_BYTES)
        found, _, bounds = counted(*hashed_windows(words.hashes(), words.bounds, SHINGLE))
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("node"), lists], names=["node", "shingles"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets have at least this Jaccard similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= similarity * (F.size("sa") + F.size("sb") - shared)).select("a", "b")


def _compare(table: pa.Table, similarity: float) -> pa.Table:
    """Links between members of different components within some members of a bucket, as stars."""
    table = table.combine_chunks()
    node, root = table["node"].to_numpy(), table["root"].to_numpy()
    lists = table["shingles"].combine_chunks()
    offsets = lists.offsets.to_numpy()
    size = np.diff(offsets)
    n = node.size
    values, column, counts = np.unique(lists.values.to_numpy()[offsets[0] : offsets[-1]], return_inverse=True, return_counts=True)
    shared = counts > 1  # the others are in no intersection
    number = np.cumsum(shared) - 1
    keep = shared[column]
    column, row = number[column[keep]], np.repeat(np.arange(n), size)[keep]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((n, n), dtype=np.float32)
    for a in range(0, int(shared.sum()), COLUMNS):
        at = slice(*np.searchsorted(column, [a, a + COLUMNS]))
        part = np.zeros((n, COLUMNS), dtype=np.float32)
        part[row[at], column[at] - a] = 1
        both += part @ part.T
    linked = both >= similarity * (size[:, None] + size[None, :] - both.astype(np.float64))
    i, j = np.nonzero(np.triu(linked & (root[:, None] != root[None, :]), 1))
    head = local_roots(n, i, j)
    found = np.flatnonzero(head != np.arange(n))
    return pa.table({"a": node[found], "b": node[head[found]]})


def _signed(docs: DataFrame, keep: list[str], weighted: bool) -> DataFrame:
    """``keep``, ``__class`` (a digest of the text) and ``__bands`` of every document."""
    slim = docs.select(*keep, F.unhex(F.md5("text")).alias("__class"), F.col("text").alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    signed = slim.mapInArrow(lambda b: released(_sign(b, weighted, BANDS, ROWS)), f"{kept}, __class binary, __bands array<long>")
    return stored(signed, "signatures")


def _links(docs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """``u, v`` as of `components`, over classes of equal texts."""
    exploded = classes.select("node", F.explode("bands").alias("bucket"))
    wide = exploded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(exploded.join(stored(wide, "buckets"), "bucket"), "members")
    # The head of a bucket is its member that meets most others in all its buckets: what copies were made from.
    met = stored(members.groupBy("node").agg(F.sum("n").alias("met")), "met")
    heads = members.join(met, "node").groupBy("bucket").agg(F.max_by("node", "met").alias("head"))
    starred = members.join(stored(heads, "heads"), "bucket").filter("node <> head")
    tried = starred.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
    tried = stored(tried, "pairs")

    nodes = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    wanted = stored(classes.select("node", "class", "first_id").join(nodes, "node", "left_semi"), "wanted")
    count = wanted.count()
    texts = docs.select(F.col("doc_id").alias("__id"), F.unhex(F.md5("text")).alias("__class"), F.col("text").alias("__text"))
    chosen = F.broadcast(wanted) if count <= BROADCAST_NODES else wanted
    texts = texts.join(chosen, (F.col("__class") == F.col("class")) & F.col("__id").eqNullSafe(F.col("first_id")))
    sets = stored(texts.select("node", "__text").mapInArrow(lambda b: released(_sets(b)), "node long, shingles array<long>"), "shingle-sets")
    if sets.count() != count:  # rows that repeat with their id
        sets = stored(sets.dropDuplicates(["node"]), "shingle-sets")

    found = components(verified(tried, sets, similarity))
    # Buckets that still hold several components: all their members are compared, block by block.
    rooted = members.filter("n > 2").join(found.withColumnRenamed("u", "node"), "node", "left")
    rooted = rooted.select("bucket", "node", "n", F.coalesce("v", "node").alias("root"))
    mixed = rooted.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    open_ = stored(rooted.join(stored(mixed.select("bucket"), "mixed"), "bucket"), "open")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    spread = open_.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    spread = spread.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1))).filter("n <= %d OR block <> with" % BLOCK)
    pairs = spread.select("bucket", "node", "root", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"))
    pairs = pairs.join(sets, "node").groupBy("bucket", "lo", "hi")
    more = stored(pairs.applyInArrow(lambda t: _compare(t, similarity), "a long, b long"), "links")
    if not more.isEmpty():
        found = joined_by(found, more)
    return found


def near_duplicates(docs: DataFrame, keep: list[str], similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """The columns ``keep`` (with ``doc_id``) of every document, ``__group`` and ``component_id``.

    Documents are linked if the sets of their five-word shingles (words of
    lower-cased letters, digits and non-ASCII characters; a shorter text is one
    shingle) have a Jaccard similarity of at least ``similarity``. ``component_id`` is
    the smallest id reachable by links, ``__group`` a number of the component. Equal
    texts always share it. Texts that are null or without words are alone: their
    group is null and their component their own id. Null ids come after all
    others. With ``weighted`` shingle counts weigh in the candidate search (their
    probability Jaccard similarity), still verified on the sets.
    """
    rows = _signed(docs, keep, weighted)
    grouped = rows.filter(F.size("__bands") > 0).groupBy("__class")
    classes = grouped.agg(F.min("doc_id").alias("first_id"), F.first("__bands").alias("bands"))
    classes = classes.withColumnRenamed("__class", "class").withColumn("node", F.monotonically_increasing_id())
    classes = stored(classes, "classes")
    found = _links(docs, classes, similarity)
    rooted = classes.select("class", "node", "first_id").join(found.withColumnRenamed("u", "node"), "node", "left")
    rooted = stored(rooted.select("class", "first_id", F.coalesce("v", "node").alias("__group")), "rooted")
    smallest = stored(rooted.groupBy("__group").agg(F.min("first_id").alias("component_id")), "smallest")
    groups = stored(rooted.select("class", "__group").join(smallest, "__group"), "groups")
    some, none = F.size("__bands") > 0, F.coalesce(F.size("__bands"), F.lit(0)) <= 0
    linked = rows.filter(some).join(groups, F.col("__class") == F.col("class"))
    alone = rows.filter(none).withColumns({"__group": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    columns = [*keep, "__group", "component_id"]
    return linked.select(*columns).unionByName(alone.select(*columns))
