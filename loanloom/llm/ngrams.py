"""A Katz backoff bigram model of all training texts, and texts scored by it.

Counts up to `CUTOFF` get smoothed Good-Turing discounts, backoff weights are normalised
exactly. The work goes over chunks of a few megabytes of text: a chunk asks the
partitions of the unigram table, then those of the bigram table, about its
distinct words and word pairs, and gets the totals over all chunks back. What is
shuffled is counted before, so a frequent word costs one entry a chunk; the pairs
of a frequent history are spread over all partitions. Every table lies in the
shared folder, and no table is gathered in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm.shared import opened, small_batches, stored
from loanloom.llm.text import TOKEN_BYTES, Words, mix, released, span_hashes, steps
from loanloom.session import scratch_path

#: Counts up to this one are discounted by Good-Turing estimates.
CUTOFF = 5
#: Taken off greater counts, and off all where there are no estimates.
FLAT = 0.5
CHUNK_BYTES = 4 << 20
#: Ids that are no words: the end of a text, and the history of its first word.
END, START = 0, 1
FIRST_WORD = 2


# --- arrays in binary columns -----------------------------------------------


def pack(x: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type, compressed."""
    top = int(x.max(initial=0))
    kind = "u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4" if top < 1 << 32 else "u8"
    raw = x.astype(f"<{kind}").view(np.uint8).reshape(-1, int(kind[1])).T.tobytes() if x.size else b""  # byte planes
    return kind.encode() + x.size.to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(data: bytes) -> np.ndarray:
    width, size = int(data[1:2]), int.from_bytes(data[2:10], "little")
    if not size:
        return np.zeros(0, dtype=np.int64)
    raw = np.frombuffer(pa.decompress(data[10:], size * width, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(width, size).T).view(f"<u{width}").reshape(-1).astype(np.int64)


# --- the model's numbers ----------------------------------------------------


def discounts(numbers: list[int], cutoff: int = CUTOFF) -> np.ndarray:
    """What is taken off a count c, at index min(c, cutoff + 1); index 0 is not used.

    ``numbers[r - 1]`` is how many things were counted r times, for r up to
    ``cutoff + 1``. They are smoothed as in Simple Good-Turing: a line through
    their logarithms over log r, empty classes averaged in. On the line n(r) =
    a * r^b a count r keeps (1 + 1/r)^(b + 1) of itself, and Katz's share of
    that lies between 0 and 1 for every b. Only if less than two classes hold
    anything there is no line, and `FLAT` is taken off every count. It is taken
    off counts above ``cutoff`` in any case: a history that is followed by such
    counts only would else leave nothing for other words.
    """
    n = {r: k for r, k in enumerate(numbers[: cutoff + 1], 1) if k}
    if len(n) > 1:
        places = list(n)
        before = [0, *places[:-1]]
        after = [*places[1:], 2 * places[-1] - places[-2]]
        x = np.log(places)
        y = np.log([2 * n[r] / (b - a) for r, a, b in zip(places, before, after, strict=True)])
        power = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()) + 1

        def rise(base: float) -> float:
            return math.expm1(power * math.log(base)) / power if power else math.log(base)

        kept = [1 - rise(1 + 1 / r) / rise(cutoff + 1) for r in range(1, cutoff + 1)]
        if all(0 < k < 1 for k in kept):
            return np.array([0.0, *[r * (1 - k) for r, k in enumerate(kept, 1)], FLAT])
    return np.array([0.0, *[FLAT] * (cutoff + 1)])


def off(discount: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return discount[np.minimum(counts, discount.size - 1)]


@dataclass
class Unigrams:
    """Totals over the training texts, ends included, and the lowest order's probabilities."""

    tokens: int
    types: int
    texts: int
    discount: np.ndarray
    unknown: float

    @classmethod
    def of(cls, tokens: int, types: int, texts: int, numbers: list[int]) -> Unigrams:
        discount = discounts(numbers)
        small = sum(n * d for n, d in zip(numbers[:CUTOFF], discount[1:], strict=False))
        lost = small + (types - sum(numbers[:CUTOFF])) * discount[-1]
        return cls(tokens, types, texts, discount, lost / tokens if tokens else 1.0)

    def chance(self, counts: np.ndarray) -> np.ndarray:
        """Of words by their counts; all unknown words are one."""
        known = (counts - off(self.discount, counts)) / max(self.tokens, 1)
        return np.where(counts > 0, known, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of add-one smoothed probabilities."""
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


# --- chunks -----------------------------------------------------------------

_DOC = "array<struct<doc_id: long, held_out: boolean, n: long>>"
CHUNKS = f"kind string, task int, chunk long, part int, docs {_DOC}, a binary, b binary, c binary"


def _rows(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


_CHUNK_SCHEMA = pa.schema(
    [
        ("kind", pa.string()),
        ("task", pa.int32()),
        ("chunk", pa.int64()),
        ("part", pa.int32()),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n", pa.int64())]))),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("c", pa.binary()),
    ]
)


def _split(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of each partition's entries, in order."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(edges)).tolist():
        yield p, order[edges[p] : edges[p + 1]]


def _read_texts(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Chunks: a row ``t`` with the tokens as numbers of distinct words, and rows ``w`` with those words."""
    task, step = TaskContext.get().partitionId(), 0
    for batch in steps(batches, "__text", CHUNK_BYTES):
        chunk, step = task << 32 | step, step + 1
        words = Words(batch.column("__text"), TOKEN_BYTES)
        coded = words.array().dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        _, offsets, data = coded.dictionary.buffers()
        n = len(coded.dictionary)
        edges = np.frombuffer(offsets, dtype=np.int64)[: n + 1] if n else np.zeros(1, dtype=np.int64)
        letters = np.frombuffer(data, dtype=np.uint8) if n else np.zeros(0, dtype=np.uint8)
        part = (span_hashes(letters, edges[:-1], edges[1:]) % np.uint64(parts)).astype(np.int64)
        held = batch.column("held_out")
        train = ~held.to_numpy(zero_copy_only=False)
        counts = np.bincount(index[np.repeat(train, words.counts)], minlength=n)
        docs = [
            {"doc_id": d, "held_out": h, "n": int(c)}
            for d, h, c in zip(batch.column("doc_id").to_pylist(), held.to_pylist(), words.counts, strict=True)
        ]
        head = {"task": task, "chunk": chunk}
        rows = [head | {"kind": "t", "part": -1, "docs": docs, "a": pack(index), "b": pack(part)}]
        for p, at in _split(part, parts):
            own = coded.dictionary.take(pa.array(at))
            size = edges[at + 1] - edges[at]
            text = b"".join(own.to_pylist())
            blob = len(text).to_bytes(8, "little") + pa.compress(text, codec="zstd", asbytes=True)
            rows.append(head | {"kind": "w", "part": p, "a": blob, "b": pack(size), "c": pack(counts[at])})
        yield _rows(_CHUNK_SCHEMA, rows)


def _words_of(row: dict) -> pa.Array:
    size = int.from_bytes(row["a"][:8], "little")
    ends = np.concatenate([[0], np.cumsum(unpack(row["b"]))]).astype(np.int64)
    text = pa.py_buffer(pa.decompress(row["a"][8:], size, codec="zstd", asbytes=True))
    return pa.Array.from_buffers(pa.large_binary(), ends.size - 1, [None, pa.py_buffer(ends), text])


WORDS = "kind string, task int, chunk long, part int, a binary, b binary, word binary, id long, count long"
_WORD_SCHEMA = pa.schema(
    [
        ("kind", pa.string()),
        ("task", pa.int32()),
        ("chunk", pa.int64()),
        ("part", pa.int32()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("word", pa.binary()),
        ("id", pa.int64()),
        ("count", pa.int64()),
    ]
)


def _filled(schema: pa.Schema, columns: dict[str, object], n: int) -> pa.Table:
    return pa.table([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _count_words(table: pa.Table, parts: int) -> pa.Table:
    """One partition of the unigram table (``v``) and the answers to its chunks (``r``)."""
    rows = table.select(["task", "chunk", "part", "a", "b", "c"]).to_pylist()
    asked = [_words_of(r) for r in rows]
    coded = pa.concat_arrays(asked).dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    total = np.bincount(index, weights=np.concatenate([unpack(r["c"]) for r in rows]), minlength=len(coded.dictionary)).astype(np.int64)
    place = np.empty(total.size, dtype=np.int64)
    place[np.argsort(-total, kind="stable")] = np.arange(total.size)
    ids = FIRST_WORD + place * parts + rows[0]["part"]
    answers, at = [], 0
    for r, words in zip(rows, asked, strict=True):
        own = index[at : at + len(words)]
        at += len(words)
        answers.append({"kind": "r", "task": r["task"], "chunk": r["chunk"], "part": r["part"], "a": pack(ids[own]), "b": pack(total[own])})
    known = np.flatnonzero(total)
    columns = {
        "kind": pa.array(["v"] * known.size, pa.string()),
        "part": pa.array(np.full(known.size, rows[0]["part"], dtype=np.int32)),
        "word": coded.dictionary.take(pa.array(known)).cast(pa.binary()),
        "id": pa.array(ids[known]),
        "count": pa.array(total[known]),
    }
    return pa.concat_tables([_filled(_WORD_SCHEMA, columns, known.size), pa.Table.from_pylist(answers, schema=_WORD_SCHEMA)])


class Answers:
    """Rows of a table written by task, read back for one chunk at a time."""

    def __init__(self, path: str):
        self.system, self.path = opened(path)

    def table(self, task: int, chunk: int, columns: list[str]) -> pa.Table | None:
        where = f"{self.path}/task={task}"
        if self.system.get_file_info(where).type.name == "NotFound":
            return None
        # A task's share of the executor is one core and little memory: nothing is read ahead.
        return pq.read_table(
            where, columns=columns, filters=[("chunk", "=", chunk)], filesystem=self.system, use_threads=False, pre_buffer=False
        )

    def of(self, task: int, chunk: int, columns: list[str]) -> list[dict]:
        found = self.table(task, chunk, columns)
        return [] if found is None else found.to_pylist()


@dataclass
class Events:
    """The word pairs of a chunk: histories, words and their counts in the training texts."""

    history: np.ndarray
    word: np.ndarray
    history_count: np.ndarray
    word_count: np.ndarray
    bounds: np.ndarray
    docs: list[dict]

    @classmethod
    def of(cls, row: dict, answers: Answers, unigrams: Unigrams) -> Events:
        index, part = unpack(row["a"]), unpack(row["b"])
        found = sorted(answers.of(row["task"], row["chunk"], ["part", "a", "b"]), key=lambda r: r["part"])
        order = np.argsort(part, kind="stable")
        ids, counts = np.zeros(part.size, dtype=np.int64), np.zeros(part.size, dtype=np.int64)
        if found:
            ids[order] = np.concatenate([unpack(r["a"]) for r in found])
            counts[order] = np.concatenate([unpack(r["b"]) for r in found])
        n = np.array([d["n"] for d in row["docs"]], dtype=np.int64)
        ends = np.cumsum(n)
        word = np.insert(ids[index], ends, END)
        count = np.insert(counts[index], ends, unigrams.texts)
        history = np.insert(ids[index], ends - n, START)
        before = np.insert(counts[index], ends - n, unigrams.texts)
        return cls(history, word, before, count, np.concatenate([[0], np.cumsum(n + 1)]), row["docs"])

    def pairs(self, parts: int, hot: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pairs by partition, then key: first event of each, keys, partitions; each event's pair."""
        if max(int(self.history.max(initial=0)), int(self.word.max(initial=0))) >= 1 << 32:
            raise ValueError("more words than 32 bits number")
        key = (self.history.astype(np.uint64) << np.uint64(32)) | self.word.astype(np.uint64)
        order = np.argsort(key, kind="stable")
        new = np.ones(key.size, dtype=bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        first = order[new]
        pair = np.empty(key.size, dtype=np.int64)
        pair[order] = np.cumsum(new) - 1
        distinct = key[first]
        spread = np.where(self.history_count[first] > hot, distinct, self.history[first].astype(np.uint64))
        part = (mix(spread) % np.uint64(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        place = np.empty(by_part.size, dtype=np.int64)
        place[by_part] = np.arange(by_part.size)
        return first[by_part], distinct[by_part], part[by_part], place[pair]


PAIRS = "task int, chunk long, part int, a binary, b binary, c binary, d binary, e binary"
_PAIR_SCHEMA = pa.schema(
    [("task", pa.int32()), ("chunk", pa.int64()), ("part", pa.int32()), *[(c, pa.binary()) for c in "abcde"]]
)


def _ask_pairs(batches: Iterator[pa.RecordBatch], words: str, unigrams: Unigrams, parts: int, hot: int) -> Iterator[pa.RecordBatch]:
    answers = Answers(words)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            events = Events.of(row, answers, unigrams)
            first, keys, part, pair = events.pairs(parts, hot)
            train = np.repeat([not d["held_out"] for d in row["docs"]], np.diff(events.bounds))
            counts = np.bincount(pair[train], minlength=keys.size)
            edges = np.searchsorted(part, np.arange(parts + 1))
            rows = []
            for p in np.flatnonzero(np.diff(edges)).tolist():
                at = slice(int(edges[p]), int(edges[p + 1]))
                history = (keys[at] >> np.uint64(32)).astype(np.int64)
                starts = np.flatnonzero(np.diff(history, prepend=-1))
                blobs = {
                    "a": pack(history[starts]),
                    "b": pack(np.diff(np.append(starts, history.size))),
                    "c": pack((keys[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    "d": pack(counts[at]),
                    "e": pack(np.where(counts[at] > 0, events.word_count[first[at]], 0)),
                }
                rows.append({"task": row["task"], "chunk": row["chunk"], "part": p} | blobs)
            yield _rows(_PAIR_SCHEMA, rows)


BIGRAMS = "kind string, task int, chunk long, part int, a binary, history long, words array<long>, counts array<long>, numbers array<long>, seen double"
_BIGRAM_SCHEMA = pa.schema(
    [
        ("kind", pa.string()),
        ("task", pa.int32()),
        ("chunk", pa.int64()),
        ("part", pa.int32()),
        ("a", pa.binary()),
        ("history", pa.int64()),
        ("words", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("numbers", pa.list_(pa.int64())),
        ("seen", pa.float64()),
    ]
)


def _count_pairs(table: pa.Table, unigrams: Unigrams) -> pa.Table:
    """One partition of the bigram table (``b``), its answers (``r``), and the unseen pairs' histories (``u``)."""
    rows = table.to_pylist()
    keys, counts, others = [], [], []
    for r in rows:
        history = np.repeat(unpack(r["a"]), unpack(r["b"])).astype(np.uint64)
        keys.append(history << np.uint64(32) | unpack(r["c"]).astype(np.uint64))
        counts.append(unpack(r["d"]))
        others.append(unpack(r["e"]))
    distinct, pair = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(pair, weights=np.concatenate(counts), minlength=distinct.size).astype(np.int64)
    word_count = np.zeros(distinct.size, dtype=np.int64)
    np.maximum.at(word_count, pair, np.concatenate(others))
    history = (distinct >> np.uint64(32)).astype(np.int64)
    made, at = [], 0
    answers = []
    for r, own in zip(rows, keys, strict=True):
        mine = pair[at : at + own.size]
        at += own.size
        head = {"task": r["task"], "chunk": r["chunk"], "part": r["part"]}
        answers.append(head | {"kind": "r", "a": pack(total[mine])})
        unseen = np.unique(history[mine[total[mine] == 0]])
        if unseen.size:
            columns = {
                "kind": pa.array(["u"] * unseen.size, pa.string()),
                "task": pa.array(np.full(unseen.size, r["task"], dtype=np.int32)),
                "chunk": pa.array(np.full(unseen.size, r["chunk"], dtype=np.int64)),
                "history": pa.array(unseen),
            }
            made.append(_filled(_BIGRAM_SCHEMA, columns, unseen.size))
    made.append(pa.Table.from_pylist(answers, schema=_BIGRAM_SCHEMA))
    some = total > 0
    history, words, total, word_count = history[some], (distinct[some] & np.uint64(0xFFFFFFFF)).astype(np.int64), total[some], word_count[some]
    if history.size:
        starts = np.flatnonzero(np.diff(history, prepend=-1))
        edges = pa.array(np.append(starts, history.size).astype(np.int32))
        n = starts.size
        owner = np.repeat(np.arange(n), np.diff(np.append(starts, history.size)))
        width = CUTOFF + 2  # counts 1 to CUTOFF + 1, and all above
        numbers = np.bincount(owner * width + np.minimum(total, width) - 1, minlength=n * width)
        columns = {
            "kind": pa.array(["b"] * n, pa.string()),
            "part": pa.array(np.full(n, rows[0]["part"], dtype=np.int32)),
            "history": pa.array(history[starts]),
            "words": pa.ListArray.from_arrays(edges, pa.array(words)),
            "counts": pa.ListArray.from_arrays(edges, pa.array(total)),
            "numbers": pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(numbers)),
            "seen": pa.array(np.add.reduceat(unigrams.chance(word_count), starts)),
        }
        made.append(_filled(_BIGRAM_SCHEMA, columns, n))
    return pa.concat_tables(made)


def _backoff(found: pa.Table | None) -> tuple[np.ndarray, np.ndarray]:
    """Histories in ascending order and their weights, as arrays: a chunk asks for very many."""
    if found is None or not found.num_rows:
        return np.array([-1]), np.array([1.0])
    history, first = np.unique(found["history"].to_numpy(), return_index=True)
    return history, found["weight"].to_numpy()[first]


def _score(
    batches: Iterator[pa.RecordBatch], words: str, pairs: str, weights: str, unigrams: Unigrams, discount: np.ndarray, parts: int, hot: int
) -> Iterator[pa.RecordBatch]:
    word_answers, pair_answers, weight_answers = Answers(words), Answers(pairs), Answers(weights)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            events = Events.of(row, word_answers, unigrams)
            pair = events.pairs(parts, hot)[-1]
            found = sorted(pair_answers.of(row["task"], row["chunk"], ["part", "a"]), key=lambda r: r["part"])
            count = np.concatenate([unpack(r["a"]) for r in found])[pair]
            known, backoff = _backoff(weight_answers.table(row["task"], row["chunk"], ["history", "weight"]))
            at = np.minimum(np.searchsorted(known, events.history), known.size - 1)
            weight = np.where(known[at] == events.history, backoff[at], 1.0)
            lower = weight * unigrams.chance(events.word_count)
            seen = (count - off(discount, count)) / np.maximum(events.history_count, 1)
            score = np.log10(np.where(count > 0, seen, lower))
            starts = events.bounds[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([d["doc_id"] for d in row["docs"]], pa.int64()),
                    pa.array([d["held_out"] for d in row["docs"]], pa.bool_()),
                    pa.array(np.diff(events.bounds)),
                    pa.array(np.add.reduceat((events.word_count > 0).astype(np.int64), starts)),
                    pa.array(np.full(starts.size, unigrams.tokens, dtype=np.int64)),
                    pa.array(np.add.reduceat(unigrams.base(events.word_count), starts)),
                    pa.array(np.add.reduceat(score, starts)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


# --- the job ----------------------------------------------------------------


def _kept(df: DataFrame, label: str, by: str) -> str:
    """``df`` written in folders by a column; their path as a URI."""
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(by).parquet(path)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def _of_kind(spark: SparkSession, path: str, schema: str, kind: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).filter(F.col("kind") == kind)


def _by_task(answers: DataFrame, label: str) -> str:
    """A table in folders by task, each chunk's rows together."""
    return _kept(answers.repartition("task").sortWithinPartitions("task", "chunk"), label, "task")


def score_texts(docs: DataFrame, held_out: Column, parts: int | None = None) -> DataFrame:
    """Every document of ``doc_id, text`` scored by a model of those not ``held_out``.

    Texts are lower-cased (A-Z), their tokens are runs of other characters than
    white space, and one end. ``n_tokens``; ``n_known`` tokens that the training
    texts have; ``train_tokens``; ``base_score`` by add-one unigrams; ``score``, the
    model's log10 probability of the text. A null or empty text is its end alone.
    Repeated documents count and are returned repeatedly. Without training texts
    all words are unknown, and one unknown word has probability 1.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("text").alias("__text"))
    with small_batches(spark):
        chunks = _kept(slim.mapInArrow(lambda b: released(_read_texts(b, parts)), CHUNKS), "text-chunks", "kind")
    texts = _of_kind(spark, chunks, CHUNKS, "t").select("task", "chunk", "docs", "a", "b")

    asked = _of_kind(spark, chunks, CHUNKS, "w").select("task", "chunk", "part", "a", "b", "c")
    words = _kept(asked.groupBy("part").applyInArrow(lambda t: _count_words(t, parts), WORDS), "unigrams", "kind")
    answers = _by_task(_of_kind(spark, words, WORDS, "r").select("task", "chunk", "part", "a", "b"), "unigram-answers")
    trained = texts.select(F.explode("docs").alias("d")).filter(~F.col("d.held_out")).count()
    counts = [F.sum((F.col("count") == r).cast("long")) for r in range(1, CUTOFF + 2)]
    vocabulary = _of_kind(spark, words, WORDS, "v")
    total, types, *numbers = vocabulary.agg(F.sum("count"), F.count("*"), *counts).first()
    numbers = [n or 0 for n in numbers]
    if 0 < trained <= CUTOFF + 1:
        numbers[trained - 1] += 1  # the end is a type, too
    unigrams = Unigrams.of((total or 0) + trained, types + (trained > 0), trained, numbers)
    hot = max(1000, unigrams.tokens // (4 * parts))

    requests = texts.mapInArrow(lambda b: released(_ask_pairs(b, answers, unigrams, parts, hot)), PAIRS)
    with small_batches(spark):
        bigrams = _kept(requests.groupBy("part").applyInArrow(lambda t: _count_pairs(t, unigrams), BIGRAMS), "bigrams", "kind")
    pair_answers = _by_task(_of_kind(spark, bigrams, BIGRAMS, "r").select("task", "chunk", "part", "a"), "bigram-answers")
    table = _of_kind(spark, bigrams, BIGRAMS, "b")
    numbers = table.agg(*[F.sum(F.get("numbers", F.lit(r))) for r in range(CUTOFF + 1)]).first()
    discount = discounts([n or 0 for n in numbers])
    lost = sum((F.sum(F.get("numbers", F.lit(r))) * float(discount[min(r + 1, CUTOFF + 1)]) for r in range(CUTOFF + 2)), F.lit(0.0))
    followed = F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))
    weights = table.groupBy("history").agg((lost / followed / (1 - F.sum("seen"))).alias("weight"))
    unseen = _of_kind(spark, bigrams, BIGRAMS, "u").select("task", "chunk", "history").distinct()
    backoff = _by_task(unseen.join(weights, "history"), "backoff-weights")
    scored = texts.mapInArrow(
        lambda b: released(_score(b, answers, pair_answers, backoff, unigrams, discount, parts, hot)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    with small_batches(spark):
        return stored(scored, "scores")
