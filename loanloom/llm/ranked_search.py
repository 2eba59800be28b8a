"""Ranked lexical search by hashed max-sketches.

The index holds a row per document: its distinct terms with their occurrences,
and a sketch of `COORDINATES` bytes for each of `HASHES` hash functions. A term
folds its occurrences into its coordinate of each part, and the greatest stays.
A document's impact of a term grows with the occurrences, so the impact of the
folded maximum is the maximum of the folded impacts, and the least of a term's
coordinates bounds its impact from above before the corpus statistics are known.

A search takes the queries in blocks. A task looks a block's terms up in the
sketches of a batch of documents, adds the weighted bounds up for each query by a
matrix product, and scores documents exactly from their terms, the highest bounds
first, until no bound is left above the last of the best so far. Ties, texts and
statistics are exact, all numbers are integers. Tasks give their own best
rows, from which a window takes those of each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.shared import opened, stored
from loanloom.llm.text import WORD_BYTES, Words, mix, steps
from loanloom.session import scratch_path

TOP = 50
COORDINATES = 1024
HASHES = 2
#: A coordinate of this value stands for any number of occurrences from it up.
FULL = 255
#: Pairs of a query and one of its terms in one block of queries.
BLOCK_PAIRS = 20_000
#: Bounds of pairs of a document and a term that are held at once (about 30 bytes each).
BATCH_CELLS = 4_000_000
#: Documents of one query that are scored between two looks at the threshold.
ROUND = 256

# --- the index --------------------------------------------------------------

INDEX = "n long, terms array<binary>, occurrences array<int>, sketch binary"


def coordinates(hashes: np.ndarray) -> list[np.ndarray]:
    """The coordinate of each term hash in each part of the sketch."""
    return [
        ((mix(hashes + np.uint64(k)) >> np.uint64(20)) % np.uint64(COORDINATES)).astype(np.int64) + k * COORDINATES
        for k in range(HASHES)
    ]


def _counted(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Document, occurrences, hash and text of each document's distinct terms; the documents' bounds in them."""
    n = words.counts.size
    array = words.array()
    coded = array.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(1, len(coded.dictionary))
    key, occurrences = np.unique(np.repeat(np.arange(n), words.counts) * size + code, return_counts=True)
    doc, code = key // size, key % size
    hashes = np.zeros(size, dtype=np.uint64)
    hashes[coded.indices.to_numpy(zero_copy_only=False)] = words.hashes()
    return doc, occurrences, hashes[code], coded.dictionary.take(pa.array(code)), np.searchsorted(doc, np.arange(n + 1))


def _index_rows(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text"):
        words = Words(batch.column("__text"), WORD_BYTES)
        doc, occurrences, hashes, terms, bounds = _counted(words)
        sketch = np.zeros((batch.num_rows, HASHES * COORDINATES), dtype=np.uint8)
        folded = np.minimum(occurrences, FULL).astype(np.uint8)
        for at in coordinates(hashes):
            np.maximum.at(sketch, (doc, at), folded)
        edges = pa.array(bounds, pa.int32())
        values = [
            pa.array(words.counts.astype(np.int64)),
            pa.ListArray.from_arrays(edges, terms.cast(pa.binary())),
            pa.ListArray.from_arrays(edges, pa.array(occurrences.astype(np.int32))),
            pa.array([row.tobytes() for row in sketch], pa.binary()),
        ]
        names = [*batch.schema.names[:keep], "n", "terms", "occurrences", "sketch"]
        yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(keep)] + values, names=names)


def build_index(docs: DataFrame) -> DataFrame:
    """The index of all documents as a table in the shared folder: ``doc_id`` and the columns of `INDEX`.

    Null and empty texts, and texts without terms, have a row without terms. Repeated
    documents and ids have a row each. Other columns than ``doc_id`` and ``text`` play no part.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text"))
    return stored(slim.mapInArrow(lambda b: _index_rows(b, 1), f"doc_id long, {INDEX}"), "search-index")


# --- the queries ------------------------------------------------------------


def _query_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text"):
        words = Words(batch.column("__text"), WORD_BYTES)
        query, _, hashes, terms, _ = _counted(words)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(query)), terms.cast(pa.binary()), pa.array(hashes.view(np.int64))],
            names=["query", "term", "hash"],
        )


def query_terms(queries: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The queries, numbered, and their distinct terms (``query``, ``term``, ``hash``), both stored."""
    numbered = stored(
        queries.select(F.monotonically_increasing_id().alias("query"), column, F.col("text").alias("__text")), "search-queries"
    )
    terms = numbered.select("query", "__text").mapInArrow(_query_rows, "query long, term binary, hash long")
    return numbered.select("query", column), stored(terms, "search-terms")


def _files(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def _read(path: str, columns: list[str]) -> pa.Table:
    system, where = opened(path)
    return pq.read_table(where, columns=columns, filesystem=system, partitioning=None)


def _found(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """How many documents of the task hold each of the block's terms."""
    terms = pc.unique(_read(path, ["term"])["term"].combine_chunks())
    total = np.zeros(len(terms), dtype=np.int64)
    for batch in batches:
        at = pc.drop_null(pc.index_in(batch.column("terms").flatten(), value_set=terms)).to_numpy()
        total += np.bincount(at, minlength=total.size)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([terms.take(pa.array(seen)), pa.array(total[seen])], names=["term", "df"])


# --- scores -----------------------------------------------------------------


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """100 - 50 + (50 * n * documents) div terms, without overflow at any size."""
    if not terms:
        return np.full(n.size, 50, dtype=np.int64)
    if 50 * int(n.max(initial=0)) * documents < 1 << 62:
        return 50 + 50 * n * documents // terms
    return np.array([50 + 50 * int(x) * documents // terms for x in n], dtype=np.int64)


def impact(occurrences: np.ndarray, factor: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * occurrences // (1000 * occurrences + 20 * factor)


class Block:
    """A block of queries: their terms, weights and places in the sketch."""

    def __init__(self, path: str, documents: int):
        table = _read(path, ["query", "term", "hash", "df"])
        terms = table["term"].combine_chunks().dictionary_encode()
        self.terms = terms.dictionary
        at = terms.indices.to_numpy(zero_copy_only=False)
        self.queries, query = np.unique(table["query"].to_numpy(), return_inverse=True)
        hashes = np.zeros(len(self.terms), dtype=np.uint64)
        hashes[at] = table["hash"].to_numpy().view(np.uint64)
        df = np.zeros(len(self.terms), dtype=np.int64)
        df[at] = table["df"].to_numpy()
        self.weight = np.array([term_weight(documents, int(d)) for d in df], dtype=np.int64)
        self.places = coordinates(hashes)
        sort = np.lexsort((at, query))
        self.term_of = at[sort]
        self.bounds = np.searchsorted(query[sort], np.arange(self.queries.size + 1))
        self.matrix = np.zeros((len(self.terms), self.queries.size))
        self.matrix[at, query] = self.weight[at]
        # Doubles add integers below 2^53 exactly; sums that may lie above are rounded up.
        self.slack = 1 + 1e-9 if 1_000_000 * int(self.matrix.sum(axis=0).max(initial=0)) >= 1 << 53 else 1

    def weights_of(self, number: int) -> np.ndarray:
        """The weight of each of the block's terms in one query."""
        out = np.zeros(len(self.terms), dtype=np.int64)
        own = self.term_of[self.bounds[number] : self.bounds[number + 1]]
        out[own] = self.weight[own]
        return out

    def bounds_of(self, sketch: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, documents by queries."""
        folded = sketch[:, self.places[0]]
        for place in self.places[1:]:
            folded = np.minimum(folded, sketch[:, place])
        # One impact for each number of occurrences and document, then a look-up.
        steps_ = impact(np.arange(FULL + 1)[None, :], factor[:, None])
        steps_[:, FULL] = 1_000_000
        return np.take_along_axis(steps_, folded.astype(np.int64), axis=1).astype(np.float64) @ self.matrix * self.slack


class Best:
    """The best rows of one query so far, by falling score and rising id (null ids last)."""

    def __init__(self, top: int):
        self.top = top
        self.score = np.zeros(0, dtype=np.int64)
        self.doc = np.zeros(0, dtype=np.int64)
        self.none = np.zeros(0, dtype=bool)

    @property
    def threshold(self) -> int:
        """A row below this score has no place."""
        return int(self.score[-1]) if self.score.size == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        keep = score >= self.threshold
        if not keep.any():
            return
        score = np.concatenate([self.score, score[keep]])
        doc = np.concatenate([self.doc, doc[keep]])
        none = np.concatenate([self.none, none[keep]])
        order = np.lexsort((doc, none, -score))[: self.top]
        self.score, self.doc, self.none = score[order], doc[order], none[order]


def _exact(wanted: np.ndarray, rows: np.ndarray, known: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact scores of one query, given by its terms' weights, for some documents of a batch."""
    starts, terms, impacts = known
    sizes = starts[rows + 1] - starts[rows]
    ends = np.cumsum(sizes)
    at = np.arange(sizes.sum()) - np.repeat(ends - sizes - starts[rows], sizes)
    total = np.concatenate([[0], np.cumsum(wanted[terms[at]] * impacts[at])])
    return total[ends] - total[ends - sizes]


def _known_terms(batch: pa.RecordBatch, block: Block, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents' bounds in their terms that the block knows, those terms, and their impacts."""
    lists = batch.column("terms")
    edges = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    at = pc.fill_null(pc.index_in(lists.flatten(), value_set=block.terms), -1).to_numpy()
    known = np.flatnonzero(at >= 0)
    occurrences = batch.column("occurrences").flatten().to_numpy().astype(np.int64)
    starts = np.searchsorted(known, edges)
    return starts, at[known], impact(occurrences[known], np.repeat(factor, np.diff(starts)))


def _search(batches: Iterator[pa.RecordBatch], path: str, documents: int, terms: int, top: int) -> Iterator[pa.RecordBatch]:
    block = Block(path, documents)
    best = [Best(top) for _ in range(block.queries.size)]
    size = max(16, BATCH_CELLS // max(1, len(block.terms)))
    for whole in batches:
        for a in range(0, whole.num_rows, size):
            batch = whole.slice(a, size)
            n = batch.column("n").to_numpy()
            factor = length_factor(n, documents, terms)
            sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(n.size, -1)
            bounds = block.bounds_of(sketch, factor)
            none = pc.is_null(batch.column("doc_id")).to_numpy(zero_copy_only=False)
            doc = pc.fill_null(batch.column("doc_id"), 0).to_numpy()
            known = _known_terms(batch, block, factor)
            for q, own in enumerate(best):
                rows = np.flatnonzero(bounds[:, q] >= own.threshold)
                rows = rows[np.argsort(-bounds[rows, q], kind="stable")]
                wanted = block.weights_of(q)
                for b in range(0, rows.size, ROUND):
                    part = rows[b : b + ROUND]
                    if bounds[part[0], q] < own.threshold:
                        break
                    own.add(_exact(wanted, part, known), doc[part], none[part])
    for q, own in enumerate(best):
        if own.score.size:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(own.score.size, block.queries[q])),
                    pa.array(own.doc, mask=own.none),
                    pa.array(own.score),
                ],
                names=["query", "doc_id", "score"],
            )


def search(index: DataFrame, queries: DataFrame, column: str, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for each query.

    ``queries`` has the id ``column`` and ``text``; the result that column, ``rank``
    from 1, ``doc_id`` and ``score``. Every row of ``queries`` is a query of its
    own, also if its id is null or repeated; one without terms, or whose terms no document holds,
    gives no rows. Equal scores rank by ascending ``doc_id``, null ids last. Every
    document row counts, repeated ones too. An empty index or query table gives an empty result.
    """
    spark = index.sparkSession
    documents, total = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    numbered, terms = query_terms(queries, column)
    kind = numbered.schema[column].dataType.simpleString()
    blocks = max(1, -(-terms.count() // block_pairs))
    by_block = scratch_path(spark, "search-blocks")
    # All terms of a query lie in one block.
    placed = terms.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    placed.repartition(blocks, "block").write.partitionBy("block").parquet(by_block)
    found = spark.createDataFrame([], f"`{column}` {kind}, rank int, doc_id long, score long")
    present = sorted(r.block for r in spark.read.parquet(by_block).select("block").distinct().collect()) if terms.count() else []
    parts = []
    for number in present:
        own = _files(f"{by_block}/block={number}")
        held = spark.read.schema(terms.schema).parquet(f"{by_block}/block={number}")
        counted = index.select("terms").mapInArrow(lambda b, p=own: _found(b, p), "term binary, df long")
        df = counted.groupBy("term").agg(F.sum("df").alias("df"))
        weighed = scratch_path(spark, "search-weights")
        # A term that no document holds adds nothing to any score.
        held.join(df, "term").write.parquet(weighed)
        path = _files(weighed)
        if spark.read.schema("query long").parquet(weighed).isEmpty():
            continue
        rows = index.mapInArrow(lambda b, p=path: _search(b, p, documents, total, top), "query long, doc_id long, score long")
        parts.append(stored(rows, "search-rows"))
    if not parts:
        return found
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(numbered, "query").select(column, "rank", "doc_id", "score")
