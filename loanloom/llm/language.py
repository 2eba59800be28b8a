"""Language identification with a convolutional network over bytes.

Filters of several widths slide over fixed-length windows of a text's bytes,
each filter's maximum goes into a softmax. The network is trained in numpy on a
bounded sample of labelled rows; it is small (a few hundred kilobytes), so the
tasks get it with their function. Prediction reads every window of every text
and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.shared import stored
from loanloom.llm.text import lower_ascii, released, steps, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Bound of the training sample: distinct labelled texts over all languages, and windows of each.
SAMPLE_ROWS = 2000
SAMPLE_WINDOWS = 3
UNKNOWN = "und"
#: Rows of the table of language counts that are broadcast at most.
BROADCAST_LANGUAGES = 10_000


@dataclass
class ByteNetwork:
    """Weights: one (width, 256, filters) table for each width, and the output layer.

    A filter applied to one-hot bytes is a sum of table rows, so a convolution
    is as many look-ups as the filter is wide.
    """

    labels: list[str]
    tables: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, labels: list[str], seed: int = 7) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3 / w, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        for t in tables:
            t[:, 0] = 0
        features = FILTERS * len(WIDTHS)
        return cls(
            labels,
            tables,
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            rng.normal(0, features**-0.5, (features, len(labels))).astype(np.float32),
            np.zeros(len(labels), np.float32),
        )

    @property
    def weights(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.out, self.out_bias]

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each filter's maximum over each window, cut at zero; optionally its place."""
        found, places = [], []
        for table, bias in zip(self.tables, self.bias, strict=True):
            width = table.shape[0]
            span = windows.shape[1] - width + 1
            total = table[0].take(windows[:, :span], axis=0)
            for j in range(1, width):
                total += table[j].take(windows[:, j : j + span], axis=0)
            if where:
                places.append(total.argmax(axis=1))
            found.append(np.maximum(total.max(axis=1) + bias, 0))
        return np.concatenate(found, axis=1), places

    def predict(self, windows: np.ndarray, block: int = 256) -> np.ndarray:
        """The probability of each label for each window."""
        out = np.empty((windows.shape[0], len(self.labels)), np.float64)
        for a in range(0, windows.shape[0], block):
            out[a : a + block] = softmax(self.pooled(windows[a : a + block])[0] @ self.out + self.out_bias)
        return out

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy, in the order of ``weights``."""
        hidden, places = self.pooled(windows, where=True)
        rows = np.arange(target.size)
        delta = softmax(hidden @ self.out + self.out_bias)
        delta[rows, target] -= 1
        delta /= target.size
        back = (delta @ self.out.T) * (hidden > 0)
        tables, bias = [], []
        for k, (table, place) in enumerate(zip(self.tables, places, strict=True)):
            own = back[:, k * FILTERS : (k + 1) * FILTERS]
            grad = np.zeros_like(table)
            for j in range(table.shape[0]):
                byte = windows[rows[:, None], place + j]
                np.add.at(grad[j], (byte, np.arange(FILTERS)[None, :]), own)
            grad[:, 0] = 0
            tables.append(grad)
            bias.append(own.sum(axis=0))
        return [*tables, *bias, hidden.T @ delta, delta.sum(axis=0)]

    def fit(self, windows: np.ndarray, target: np.ndarray, epochs: int = 12, rate: float = 0.01, seed: int = 7) -> None:
        """Adam over shuffled batches, with a falling rate."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step, batch = 0, 64
        total = epochs * -(-target.size // batch)
        for _ in range(epochs):
            order = rng.permutation(target.size)
            for a in range(0, target.size, batch):
                at = order[a : a + batch]
                step += 1
                pace = rate * (1 - (step - 1) / total)
                for w, g, m, v in zip(self.weights, self.gradients(windows[at], target[at]), first, second, strict=True):
                    g = g + 1e-4 * w
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(data: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Every text as windows of ``size`` bytes, and the text each belongs to.

    The last window of a text ends where the text ends and overlaps the one
    before; a shorter text is padded with zeros.
    """
    length = np.diff(offsets)
    counts = -(-length // size)
    owner = np.repeat(np.arange(length.size), counts)
    nth = np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.maximum(np.minimum(nth * size, length[owner] - size), 0) + offsets[:-1][owner]
    at = start[:, None] + np.arange(size)
    short = at >= offsets[1:][owner][:, None]
    windows = np.append(data, np.zeros(size, np.uint8))[at]
    windows[short] = 0
    return windows, owner


def training_sample(labelled: DataFrame, rows: int = SAMPLE_ROWS, windows: int = SAMPLE_WINDOWS) -> list[tuple[str, str]]:
    """Equally many distinct texts of each language, those of smallest hash, and pieces of them.

    Repeats of a text count once, so copies neither push other texts out nor lower
    their language's rate. A language with fewer distinct texts than its share
    gives all, and every language gives one at least. At most ``rows`` texts (or one
    for each language, if there are more languages) and ``windows`` pieces of
    ``WINDOW`` characters from each come to the driver, however large the corpus is.
    """
    labelled = labelled.filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").select("lang", "text", F.xxhash64("text").alias("hash"))
    distinct = stored(labelled.select("lang", "hash").distinct(), "label-hashes")
    counts = stored(distinct.groupBy("lang").agg(F.count("*").alias("count"), F.min("hash").alias("least")), "languages")
    languages = counts.count()
    each = max(1, rows // max(1, languages))
    # The smallest hashes of a language lie below a bound that twice as many and 50 more are expected
    # to pass, so that only those few are sorted.
    bound = F.lit(float(-(1 << 63))) + F.least(F.lit(1.0), F.lit(2.0 * each + 50) / F.col("count")) * F.lit(float(1 << 64))
    limits = counts.select("lang", bound.alias("bound"), "least")
    near = distinct.join(F.broadcast(limits) if languages <= BROADCAST_LANGUAGES else limits, "lang")
    near = near.filter((F.col("hash") <= F.col("bound")) | (F.col("hash") == F.col("least")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    chosen = stored(near.withColumn("place", place).filter(F.col("place") <= each).select("lang", "hash"), "chosen-texts")
    room = F.greatest(F.length("text") - F.lit(WINDOW), F.lit(0)) + F.lit(1)
    pieces = [
        F.substr("text", F.pmod(F.xxhash64("text", F.lit(k)), room).cast("int") + F.lit(1), F.lit(WINDOW))
        for k in range(windows)
    ]
    few = each * languages <= max(rows, BROADCAST_LANGUAGES)
    texts = labelled.join(F.broadcast(chosen) if few else chosen, ["lang", "hash"])
    found = texts.select("lang", "hash", F.array(*pieces).alias("pieces")).groupBy("lang", "hash").agg(F.min("pieces").alias("pieces"))
    return sorted({(r.lang, piece) for r in found.select("lang", "pieces").collect() for piece in r.pieces})


def train(sample: list[tuple[str, str]]) -> ByteNetwork | None:
    """A network for the languages of the sample; None if it holds none."""
    labels = sorted({lang for lang, _ in sample})
    if not labels:
        return None
    data, offsets = text_bytes(pa.array([piece for _, piece in sample], pa.string()))
    windows, owner = cut(lower_ascii(data), offsets)
    target = np.array([labels.index(lang) for lang, _ in sample])[owner]
    network = ByteNetwork.new(labels)
    network.fit(windows, target)
    return network


def _predict(batches: Iterator[pa.RecordBatch], network: ByteNetwork | None, names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, "__text", 1 << 20):
        n = batch.num_rows
        label, score = [UNKNOWN] * n, np.zeros(n)
        if network is not None:
            data, offsets = text_bytes(batch.column("__text"))
            windows, owner = cut(lower_ascii(data), offsets)
            chance = np.zeros((n, len(network.labels)))
            np.add.at(chance, owner, network.predict(windows))
            chance /= np.maximum(np.bincount(owner, minlength=n), 1)[:, None]
            for i in np.flatnonzero(batch.column("__letter").to_numpy(zero_copy_only=False)):
                best = int(chance[i].argmax())
                label[i], score[i] = network.labels[best], min(1.0, chance[i, best])
        rest = [c for c in batch.schema.names if c not in ("__text", "__letter")]
        own = [pa.array(label, pa.string()), pa.array(score)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + own, names=[*rest, *names])


def identify(docs: DataFrame, network: ByteNetwork | None, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of every document, with ``lang_pred`` and ``score``.

    The prediction is that of the mean probability over all windows of the whole
    text, the score that mean (0 to 1). A text that is null or has no letter is
    ``und`` with score 0, and so is every text if nothing was learned. Repeated
    documents give a row each. Extra columns play no part; where kept ones are
    called like the results, ``prefix`` sets the results apart.
    """
    names = (f"{prefix}lang_pred", f"{prefix}score")
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    slim = docs.select(*keep, F.col("text").alias("__text"), letter.alias("__letter"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)
    return slim.mapInArrow(lambda b: released(_predict(b, network, names)), f"{kept}, `{names[0]}` string, `{names[1]}` double")


def fold(column: str, parts: int) -> Column:
    """crc32 of a number as text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned outside the held-out fourth.

    A document without an id is neither learned from nor held out.
    """
    network = train(training_sample(docs.filter(fold("doc_id", 4) != 2)))
    held = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return identify(docs, network, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score")
