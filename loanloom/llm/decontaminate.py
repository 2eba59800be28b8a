"""Benchmark decontamination with an FM-index per training shard.

Every task cuts its documents into shards of a few megabytes, indexes each shard
once (suffix array, Burrows-Wheeler transform, wavelet matrix, sampled suffix
positions) and searches all benchmark windows backwards in it. The windows lie
in the shared folder in blocks of bounded size; a task holds one block and one
shard at a time, so neither a large benchmark nor a large corpus gathers
anywhere. Symbols are the shard's own words: those that no block holds are one
symbol, and windows with a word that the shard lacks are not searched. Documents
are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.shared import opened, stored
from loanloom.llm.text import WORD_BYTES, Words, released, steps
from loanloom.session import scratch_path

WINDOW = 10
#: Window-item pairs in one block of the benchmark.
BLOCK_PAIRS = 200_000
#: One suffix position in so many is stored.
SAMPLE_EVERY = 8


def suffix_array(s: np.ndarray, alphabet: int) -> np.ndarray:
    """Positions of all suffixes of ``s`` (0 <= s < alphabet) in sorted order.

    Prefix doubling that sorts again only the suffixes still tied.
    """
    n = s.size
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(alphabet).bit_length())
    depth = max(1, min(4, 62 // bits))
    padded = np.zeros(n + depth, dtype=np.int64)
    padded[:n] = s + 1
    key = np.zeros(n, dtype=np.int64)
    for k in range(depth):
        key = (key << bits) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1

    def regroup(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks of sorted rows by their keys; the rows that are still tied."""
        new = np.ones(rows.size, dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1] + 1)
        first = rows[np.flatnonzero(new)]
        rank[order[rows]] = np.repeat(first, np.diff(np.append(np.flatnonzero(new), rows.size)))
        alone = new & np.append(new[1:], True)
        return rows[~alone]

    rows = regroup(np.arange(n), key[order])
    while rows.size:
        at = order[rows]
        key = rank[at] * (n + 2) + rank[np.minimum(at + depth, n)] + 1
        sort = np.argsort(key, kind="stable")
        order[rows] = at[sort]
        rows = regroup(rows, key[sort])
        depth *= 2
    return order


class WaveletMatrix:
    """Rank and access over a sequence, one bit vector per bit of its symbols."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.size = symbols.size
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for shift in range(self.bits - 1, -1, -1):
            bit = (symbols >> shift) & 1 == 1
            words = np.zeros(self.size // 64 + 1, dtype=np.uint64)
            packed = np.packbits(bit, bitorder="little")
            words.view(np.uint8)[: packed.size] = packed
            before = np.zeros(words.size, dtype=np.int64)
            np.cumsum(np.bitwise_count(words)[:-1], out=before[1:])
            zeros = self.size - int(bit.sum())
            self.levels.append((words, before, zeros))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``at``."""
        start, end = np.zeros_like(at), at
        for level, (words, before, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            s, e = self._ones(words, before, start), self._ones(words, before, end)
            start = np.where(one, zeros + s, start - s)
            end = np.where(one, zeros + e, end - e)
        return end - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions ``at``, and how often each stood before."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for words, before, zeros in self.levels:
            one = (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones, s = self._ones(words, before, at), self._ones(words, before, start)
            at = np.where(one, zeros + ones, at - ones)
            start = np.where(one, zeros + s, start - s)
            symbol = (symbol << 1) | one
        return symbol, at - start


class FMIndex:
    """Backward search and location of patterns in one sequence of symbols.

    Symbol 0 marks what no pattern holds; the sequence must end with one.
    """

    def __init__(self, s: np.ndarray, alphabet: int, every: int = SAMPLE_EVERY):
        order = suffix_array(s, alphabet)
        bwt = s[order - 1]
        self.size = s.size
        self.tree = WaveletMatrix(bwt, alphabet)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=alphabet))])
        # Sampled rows: regular positions, and those right after a 0, where no walk may go on.
        keep = (order % every == 0) | (bwt == 0)
        self.sampled = keep
        self.sample_rank = np.cumsum(keep) - 1
        self.samples = order[keep]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last row of each pattern (left-aligned rows of symbols)."""
        lo = np.zeros(lengths.size, dtype=np.int64)
        hi = np.full(lengths.size, self.size, dtype=np.int64)
        alive = np.arange(lengths.size)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            alive = alive[(lengths[alive] >= back) & (hi[alive] > lo[alive])]
            symbol = patterns[alive, lengths[alive] - back]
            lo[alive] = self.smaller[symbol] + self.tree.rank(symbol, lo[alive])
            hi[alive] = self.smaller[symbol] + self.tree.rank(symbol, hi[alive])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at ``rows``, by walking back to a sample."""
        out = np.empty(rows.size, dtype=np.int64)
        at, open_, walked = rows.copy(), np.arange(rows.size), 0
        while open_.size:
            found = self.sampled[at]
            out[open_[found]] = self.samples[self.sample_rank[at[found]]] + walked
            at, open_ = at[~found], open_[~found]
            symbol, before = self.tree.access(at)
            at = self.smaller[symbol] + before
            walked += 1
        return out


# --- the benchmark ----------------------------------------------------------


def _window_rows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "item_text"):
        words = Words(batch.column("item_text"), WORD_BYTES)
        tokens = words.array().to_pylist()
        found = []
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            own = tokens[words.bounds[i] : words.bounds[i + 1]]
            for k in range(max(1, len(own) - window + 1) if own else 0):
                found.append((item, own[k : k + window]))
        for a in range(0, len(found), 5000):
            part = found[a : a + 5000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in part], pa.string()), pa.array([p[1] for p in part], pa.list_(pa.binary()))],
                names=["item_id", "words"],
            )


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, block_pairs: int = BLOCK_PAIRS) -> tuple[str, int]:
    """The distinct (window, item) pairs as a table in blocks; its path and their number.

    Texts that are null or without words have no window. Repeated items count once;
    items without an id count as one, whose windows have a null owner.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("item_text"))
    pairs = stored(
        items.filter("item_text IS NOT NULL")
        .mapInArrow(lambda b: _window_rows(b, window), "item_id string, words array<binary>")
        .distinct(),
        "benchmark-windows",
    )
    blocks = max(1, -(-pairs.count() // block_pairs))
    path = scratch_path(spark, "benchmark-blocks")
    block = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)).cast("int")
    pairs.withColumn("block", block).repartition(blocks, "block").write.partitionBy("block").parquet(path)
    return path if "://" in path or path.startswith("file:") else f"file://{path}", blocks


@dataclass
class Block:
    """One block of windows, as numbers of the words in its own vocabulary."""

    vocabulary: pa.Array
    patterns: np.ndarray
    lengths: np.ndarray
    items: list[list[str | None]]

    @classmethod
    def read(cls, path: str, number: int, window: int) -> Block | None:
        system, where = opened(f"{path}/block={number}")
        if system.get_file_info(where).type.name == "NotFound":
            return None
        table = pq.read_table(where, columns=["item_id", "words"], filesystem=system)
        owners: dict[tuple[bytes, ...], list[str | None]] = {}
        for item, words in zip(table["item_id"].to_pylist(), table["words"].to_pylist(), strict=True):
            owners.setdefault(tuple(words), []).append(item)
        vocabulary = {w: k for k, w in enumerate(sorted({w for words in owners for w in words}))}
        patterns = np.zeros((len(owners), window), dtype=np.int64)
        for i, words in enumerate(owners):
            patterns[i, : len(words)] = [vocabulary[w] for w in words]
        lengths = np.array([len(words) for words in owners], dtype=np.int64)
        return cls(pa.array(list(vocabulary), pa.large_binary()), patterns, lengths, list(owners.values()))


# --- the documents ----------------------------------------------------------


class Shard:
    """Some texts as one sequence of symbols, indexed once for all blocks."""

    def __init__(self, column: pa.Array, vocabularies: Iterator[pa.Array]):
        self.words = Words(column, WORD_BYTES)
        coded = self.words.array().dictionary_encode()
        known = np.zeros(len(coded.dictionary), dtype=bool)
        for vocabulary in vocabularies:
            known |= pc.is_in(coded.dictionary, value_set=vocabulary).to_numpy(zero_copy_only=False)
        number = np.where(known, np.cumsum(known), 0)
        # The symbol of each of these words is its place among them, from 1.
        self.dictionary = coded.dictionary.filter(pa.array(known))
        symbol = number[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, dtype=np.int64)
        # A 0 closes every text, and runs of words that no window holds shrink to one 0.
        ends = self.words.bounds[1:]
        joined = np.insert(symbol, ends, 0)
        origin = np.insert(np.arange(symbol.size), ends, -1)
        keep = np.ones(joined.size, dtype=bool)
        keep[1:] = (joined[1:] != 0) | (joined[:-1] != 0)
        self.origin = origin[keep]
        self.index = FMIndex(joined[keep], len(self.dictionary) + 1) if len(self.dictionary) else None

    def hits(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, past-the-last word and pattern number of every occurrence of the block's windows."""
        if self.index is None:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        symbol = pc.fill_null(pc.index_in(block.vocabulary, value_set=self.dictionary), -1).to_numpy().astype(np.int64) + 1
        patterns = symbol[block.patterns]
        inside = np.arange(patterns.shape[1])[None, :] < block.lengths[:, None]
        tried = np.flatnonzero(((patterns > 0) | ~inside).all(axis=1))
        lo, hi = self.index.search(patterns[tried], block.lengths[tried])
        counts = hi - lo
        pattern = np.repeat(tried, counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(lo, counts)
        first = self.origin[self.index.locate(rows)]
        return first, first + block.lengths[pattern], pattern


def merged(first: np.ndarray, last: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of the same document as one."""
    if first.size == 0:
        return first, last, doc
    sort = np.lexsort((last, first))
    first, last, doc = first[sort], last[sort], doc[sort]
    reach = np.maximum.accumulate(last)
    new = np.ones(first.size, dtype=bool)
    new[1:] = (first[1:] > reach[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return first[at], np.maximum.reduceat(last, at), doc[at]


RESULT = {
    "n_words": "long",
    "n_hit": "long",
    "n_items": "long",
    "items": "array<string>",
    "spans": "array<struct<start: long, end: long>>",
}


def _search(
    batches: Iterator[pa.RecordBatch], path: str, blocks: int, window: int, names: list[str]
) -> Iterator[pa.RecordBatch]:
    kept = Block.read(path, 0, window) if blocks == 1 else None

    def read() -> Iterator[Block]:
        """All blocks in turn; a single one is kept."""
        for number in range(blocks):
            block = kept if blocks == 1 else Block.read(path, number, window)
            if block is not None:
                yield block

    for batch in steps(batches, "__text"):
        shard = Shard(batch.column("__text"), (block.vocabulary for block in read()))
        words = shard.words
        n = batch.num_rows
        owner = np.repeat(np.arange(n), words.counts)
        firsts, lasts = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        items: dict[int, set[str | None]] = {}
        for block in read():
            first, last, pattern = shard.hits(block)
            firsts.append(first)
            lasts.append(last)
            for d, p in np.unique(np.stack([owner[first], pattern], axis=1), axis=0).tolist():
                items.setdefault(d, set()).update(block.items[p])
        first, last = np.concatenate(firsts), np.concatenate(lasts)
        first, last, doc = merged(first, last, owner[first])
        hit = np.bincount(doc, weights=last - first, minlength=n).astype(np.int64)
        base = words.bounds[doc]
        edges = np.zeros(n + 1, dtype=np.int32)
        np.cumsum(np.bincount(doc, minlength=n), out=edges[1:])
        spans = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], names=["start", "end"])
        own = [
            pa.array(words.counts.astype(np.int64)),
            pa.array(hit),
            pa.array([len(items.get(d, ())) for d in range(n)], pa.int64()),
            pa.array([sorted(items.get(d, set()) - {None}) for d in range(n)], pa.list_(pa.string())),
            pa.ListArray.from_arrays(pa.array(edges), spans),
        ]
        rest = [c for c in batch.schema.names if c != "__text"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in rest] + own, names=[*rest, *names]
        )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, prefix: str = ""
) -> DataFrame:
    """The columns ``keep`` of every document, with what the benchmark hits in it.

    ``n_words``; ``n_hit``, the words inside any occurrence of a window;
    ``n_items``, the number of items with occurring windows; ``items``, their ids,
    sorted; ``spans``, the merged runs of hit words, counted from 0, end exclusive.
    Benchmark rows without an id hit like others: together they are one item,
    which is counted and has no place among the ids. A null or empty text has
    no words and no hits; an empty benchmark hits nothing; repeated documents
    give a row each. Extra columns play no part, whatever their names; where
    kept ones are called like the results, ``prefix`` sets the results apart.
    """
    path, blocks = benchmark_blocks(benchmark, window)
    slim = docs.select(*keep, F.col("text").alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    names = [prefix + name for name in RESULT]
    added = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, RESULT.values(), strict=True))
    return slim.mapInArrow(lambda b: released(_search(b, path, blocks, window, names)), f"{kept}, {added}")


def digest(found: DataFrame) -> DataFrame:
    """The result as one plain row per document."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
