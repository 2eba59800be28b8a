"""Importance resampling of documents towards a target distribution.

Features are runs of one to `RUN` words in hashed buckets. A bucket's gain is the
logarithm of its share in the target over its share in the documents; a task
holds the gains as one array and adds up those of a document's features. With a
Gumbel number from its id added, the highest scores are a draw without replacement.

The cutoff is not sorted for: a quantile sketch of the scores gives a bracket
around it, exact counts above and within the bracket say whether the cutoff lies in
it, the bracket widens until it does, and only its rows are ranked. The drawn rows
are ranked by ranges. No table of documents meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.shared import stored
from loanloom.llm.text import WORD_BYTES, Words, steps

BUCKETS = 10_000
RUN = 3
SEED = 42
LEAST_WORDS = 20
SHARE = (5, 100)
#: Ranks are estimated within one part in so many; the first bracket is twice as wide to each side.
ACCURACY = 2_000

# --- crc32 over arrays ------------------------------------------------------

#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), table >> np.uint32(1))
    return table


_BYTE = _byte_table()
#: The register after k zero bytes, for each byte of the register; row k of each table.
_zeros: list[np.ndarray] = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * b) for b in range(4)])]


def _after_zeros(register: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The register after ``count`` zero bytes; it is linear in the register's four bytes."""
    top = int(count.max(initial=0))
    if top > 255:  # by bits of the count: squares of the step of 256 bytes
        register = _after_zeros(register, count & 255)
        count, step = count >> 8, _one_step(256)
        while count.any():
            moved = _through(step[None], np.zeros(count.size, dtype=np.int64), register)
            register = np.where(count & 1, moved, register)
            count, step = count >> 1, np.stack([_through(step[None], np.zeros(256, dtype=np.int64), row) for row in step])
        return register
    while len(_zeros) <= top:
        last = _zeros[-1]
        _zeros.append(_BYTE[last & np.uint32(255)] ^ (last >> np.uint32(8)))
    return _through(np.stack(_zeros[: top + 1]), count, register)


def _one_step(count: int) -> np.ndarray:
    register = _zeros[0]
    for _ in range(count):
        register = _BYTE[register & np.uint32(255)] ^ (register >> np.uint32(8))
    return register


def _through(tables: np.ndarray, row: np.ndarray, register: np.ndarray) -> np.ndarray:
    out = np.zeros(register.size, dtype=np.uint32)
    for b in range(4):
        out ^= tables[row, b, (register >> np.uint32(8 * b)) & np.uint32(255)]
    return out


def crc32_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of each word, byte by byte over all words at once; and the words' bytes."""
    size = words.ends - words.starts
    register = np.full(size.size, 0xFFFFFFFF, dtype=np.uint32)
    open_, at = np.arange(size.size), 0
    while open_.size:
        byte = words.data[words.starts[open_] + at].astype(np.uint32)
        own = register[open_]
        register[open_] = _BYTE[(own ^ byte) & np.uint32(255)] ^ (own >> np.uint32(8))
        at += 1
        open_ = open_[size[open_] > at]
        if open_.size < 64:  # a few long words: the library's function, word by word
            import zlib

            for i in open_:
                data = words.data[words.starts[i] : words.ends[i]].tobytes()
                register[i] = zlib.crc32(data) ^ 0xFFFFFFFF
            break
    return register ^ np.uint32(0xFFFFFFFF), size


def joined_crc32(first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of two strings in a row from their own, ``size`` bytes in the second."""
    return _after_zeros(first, size) ^ second


def features(words: Words, buckets: int = BUCKETS, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every run of 1 to ``run`` words that lies in one text."""
    crc, size = crc32_words(words)
    space = np.full(crc.size, 0xE96CCF45, dtype=np.uint32)  # crc32 of one space
    doc = np.repeat(np.arange(words.counts.size), words.counts)
    docs, found = [doc], [crc % buckets]
    spaced = joined_crc32(space, crc, size)  # each word with a space before it
    whole = crc
    for k in range(1, run):
        whole = joined_crc32(whole[:-1], spaced[k:], size[k:] + 1)
        same = doc[k:] == doc[: doc.size - k]
        docs.append(doc[k:][same])
        found.append((whole % buckets)[same])
    return np.concatenate(docs), np.concatenate(found).astype(np.int64)


# --- counts and gains -------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, dtype=np.int64)
    for batch in steps(batches, "__text"):
        total += np.bincount(features(Words(batch.column("__text"), WORD_BYTES), buckets)[1], minlength=buckets)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "features"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: one array of fixed size."""
    slim = texts.select(F.col("text").alias("__text"))
    rows = slim.mapInArrow(lambda b: _count(b, buckets), "bucket long, features long").groupBy("bucket").agg(F.sum("features"))
    counts = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows.collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))).

    The products are exact integers, their quotient a double.
    """
    import math

    a, b = int(source.sum()) + source.size, int(target.sum()) + target.size
    pairs = zip(source.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * a / ((s + 1) * b))) for s, t in pairs], dtype=np.int64)


# --- weights and scores -----------------------------------------------------


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, keep: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text"):
        words = Words(batch.column("__text"), WORD_BYTES)
        doc, bucket = features(words, gain.size)
        n = batch.num_rows
        weight = np.zeros(n, dtype=np.int64)
        np.add.at(weight, doc, gain[bucket])
        values = [words.counts.astype(np.int64), np.bincount(doc, minlength=n).astype(np.int64), weight]
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in range(keep)] + [pa.array(v) for v in values],
            names=[*batch.schema.names[:keep], "n_words", "n_features", "weight"],
        )


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 * ln(-ln(u))) for a u between 0 and 1 from the first 32 bits of sha256(seed:id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def scored(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every document, stored."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text"))
    weighed = slim.mapInArrow(lambda b: _weigh(b, gain, 1), "doc_id long, n_words long, n_features long, weight long")
    return stored(weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "scored")


# --- the cutoff -------------------------------------------------------------

#: Highest score first, then the smallest id (null last); what is left of ties is told apart by the features.
ORDER = [F.desc, lambda c: F.col(c).asc_nulls_last(), F.desc]
KEYS = ["score", "doc_id", "n_features"]


def _order() -> list[Column]:
    return [how(name) for how, name in zip(ORDER, KEYS, strict=True)]


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` 1, 2, 3... in the order of scores, by ranges.

    Rows are dealt into ranges of the order, ranked within each, and moved up by the
    sizes of the ranges before.
    """
    dealt = stored(rows.repartitionByRange(*_order()).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__part").count()
    # One row per range, so the window over them is as small as the number of partitions.
    before = sizes.select(
        "__part",
        (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__before"),
    )
    within = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("__part").orderBy(*_order())))
    return within.join(F.broadcast(before), "__part").withColumn("rank", F.col("rank") + F.col("__before")).drop("__part", "__before")


def bracket(scores: DataFrame, total: int, wanted: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """The bounds of the scores among which the ``wanted`` highest end, and how many rows lie above.

    ``scores`` has ``total`` rows. The sketch's ranks err by total / accuracy; the
    exact counts decide. A bracket that misses the cutoff is doubled, in the end it is all scores.
    """
    reach = 2.0 / accuracy
    middle = 1 - wanted / total
    while True:
        low, high = max(0.0, middle - reach), min(1.0, middle + reach)
        points = F.percentile_approx("score", [low, high], accuracy)
        ends = (F.min("score"), F.max("score"))
        (a, b), least, most = scores.agg(points, *ends).first()
        a, b = (least if low == 0 else a), (most if high == 1 else b)
        above, within = scores.agg(
            F.count(F.when(F.col("score") > b, 1)), F.count(F.when(F.col("score").between(a, b), 1))
        ).first()
        if above < wanted <= above + within:
            return a, b, above
        reach *= 2


def draw(rows: DataFrame, least_words: int = LEAST_WORDS, share: tuple[int, int] = SHARE, accuracy: int = ACCURACY) -> DataFrame:
    """The scored rows with the ``rank`` of those drawn, null for the others.

    Of the rows with ``least_words`` words the given share, rounded down, is drawn: the
    highest scores, ties to the smaller id. Rows that agree in score, id and features
    are interchangeable, and so many of them are drawn as there is room for.
    """
    fit = F.col("n_words") >= least_words
    total = rows.filter(fit).count()
    wanted = share[0] * total // share[1]
    if wanted == 0:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    low, high, above = bracket(rows.filter(fit).select("score"), total, wanted, accuracy)
    middle = ranked(rows.filter(fit & F.col("score").between(low, high)).select(*KEYS))
    last = middle.filter(F.col("rank") == wanted - above).first()
    # Not behind the last drawn row in the order.
    same_id = F.col("doc_id").eqNullSafe(F.lit(last.doc_id).cast("long"))
    before = F.lit(False) if last.doc_id is None else F.coalesce(F.col("doc_id") < last.doc_id, F.lit(False))
    if last.doc_id is None:
        before = F.col("doc_id").isNotNull()
    tied = before | (same_id & (F.col("n_features") >= last.n_features))
    drawn = fit & ((F.col("score") > last.score) | ((F.col("score") == last.score) & tied))
    rank = F.when(F.col("rank") <= wanted, F.col("rank")).cast("long")
    taken = ranked(rows.filter(drawn)).withColumn("rank", rank)
    return taken.unionByName(rows.filter(~drawn).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` (null if undrawn) of every document.

    Null and empty texts have no features and the weight 0; they are too short to be
    drawn. A null id hashes as an empty one and ranks last among ties. Repeated rows
    are rows of their own with equal scores. An empty target leaves the documents'
    own distribution to weigh against a flat one, an empty table gives an empty
    result. Other columns than ``doc_id`` and ``text`` play no part.
    """
    return draw(scored(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")
