"""Token ids in binary files with Elias-Fano encoded document boundaries.

One range partition of the documents becomes one file: the concatenated ids,
the document ids, and the boundaries as an Elias-Fano sequence (low bits packed,
high bits in unary, a sampled rank for select). A manifest row per file carries
the counts, from which the files' places in the whole stream follow.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanloom.llm.shared import attempt_name, folder, opened, stored
from loanloom.llm.text import released, steps, text_bytes

MAGIC = b"LLTOKEF1"
END_ID = 0
#: Pieces of text whose ids a worker remembers.
CACHE_PIECES = 500_000


# --- Elias-Fano -------------------------------------------------------------


@dataclass
class EliasFano:
    """A non-decreasing sequence of n numbers up to u in about n * (2 + log2(u / n)) bits.

    Number i has its ``low_bits`` lowest bits in ``low`` and its upper part as the
    position of the i-th one in ``high``. ``ranks`` counts the ones before every
    ``BLOCK`` words of ``high``; select searches it and then looks into one block.
    """

    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    ranks: np.ndarray

    BLOCK = 8

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = values.size
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        high = np.zeros(n + (top >> low_bits) + 1, dtype=np.uint8)
        high[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        words = _words(high)
        ones = np.bitwise_count(words).astype(np.uint64)
        ranks = np.concatenate([[0], np.cumsum(ones)])[: words.size : cls.BLOCK].astype(np.uint64)
        return cls(n, low_bits, np.packbits(bits.reshape(-1), bitorder="little"), words, ranks)

    def select(self, index: np.ndarray) -> np.ndarray:
        """The numbers at ``index``."""
        out = np.empty(index.size, dtype=np.int64)
        for a in range(0, index.size, 4096):
            i = index[a : a + 4096].astype(np.int64)
            block = np.searchsorted(self.ranks, i.astype(np.uint64), side="right") - 1
            words = np.zeros((i.size, self.BLOCK), dtype=np.uint64)
            for k in range(self.BLOCK):
                at = block * self.BLOCK + k
                words[:, k] = np.where(at < self.high.size, self.high[np.minimum(at, self.high.size - 1)], 0)
            ones = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
            within = i - self.ranks[block].astype(np.int64)
            place = (np.cumsum(ones, axis=1, dtype=np.int32) > within[:, None]).argmax(axis=1)
            upper = block * self.BLOCK * 64 + place - i
            out[a : a + 4096] = (upper << self.low_bits) | self._lows(i)
        return out

    def _lows(self, i: np.ndarray) -> np.ndarray:
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def sections(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ranks": self.ranks}


def _words(bits: np.ndarray) -> np.ndarray:
    words = np.zeros(bits.size // 64 + 1, dtype=np.uint64)
    packed = np.packbits(bits, bitorder="little")
    words.view(np.uint8)[: packed.size] = packed
    return words


# --- files ------------------------------------------------------------------


class TokenFile:
    """Writes one file: ids as they come, then document ids, boundaries and a footer."""

    def __init__(self, uri: str, width: int):
        self.system, self.path = opened(uri)
        self.out = self.system.open_output_stream(self.path)
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.ids, self.lengths, self.docs, self.absent = 0, [], [], []

    def add(self, ids: np.ndarray, lengths: np.ndarray, docs: pa.Array) -> None:
        self.out.write(ids.astype(self.dtype).tobytes())
        self.ids += ids.size
        self.lengths.append(lengths.astype(np.int64))
        self.docs.append(pc.fill_null(docs, 0).to_numpy(zero_copy_only=False).astype("<i8"))
        self.absent.append(docs.is_null().to_numpy(zero_copy_only=False))

    def close(self) -> int:
        lengths = np.concatenate(self.lengths)
        ends = EliasFano.encode(np.concatenate([[0], np.cumsum(lengths)]))
        parts = {
            "docs": np.concatenate(self.docs),
            "absent": np.packbits(np.concatenate(self.absent), bitorder="little"),
            **ends.sections(),
        }
        at = self.ids * self.dtype.itemsize
        footer = {"ids": self.ids, "documents": int(lengths.size), "id": self.dtype.str, "low_bits": ends.low_bits, "sections": {}}
        for name, part in parts.items():
            footer["sections"][name] = [at, int(part.size), part.dtype.str]
            self.out.write(part.tobytes())
            at += part.nbytes
        text = json.dumps(footer).encode()
        self.out.write(text + len(text).to_bytes(8, "little") + MAGIC)
        self.out.close()
        return int(lengths.size)


class TokenReader:
    """Reads a file's documents by their offsets, without loading its ids whole."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        length = int.from_bytes(tail[:8], "little")
        self.footer = json.loads(self.file.read_at(length, size - 16 - length))
        self.documents = self.footer["documents"]
        self.dtype = np.dtype(self.footer["id"])
        low, high, ranks = (self._section(k) for k in ("low", "high", "ranks"))
        self.ends = EliasFano(self.documents + 1, self.footer["low_bits"], low, high, ranks)

    def _section(self, name: str) -> np.ndarray:
        at, count, kind = self.footer["sections"][name]
        return np.frombuffer(self.file.read_at(count * np.dtype(kind).itemsize, at), dtype=kind)

    def doc_ids(self) -> pa.Array:
        absent = np.unpackbits(self._section("absent"), bitorder="little")[: self.documents].astype(bool)
        return pa.array(self._section("docs"), mask=absent)

    def ids(self, first: int, last: int) -> np.ndarray:
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((last - first) * width, first * width), dtype=self.dtype)


# --- encoding ---------------------------------------------------------------


class Encoder:
    """The ids of whole texts, each distinct piece of text encoded once.

    A byte-level BPE never merges over a single space between two characters
    that are no white space, so texts are cut there; the pieces keep the space in
    front. Around characters that might be white space no cut is made.
    """

    _PLAIN = np.zeros(256, dtype=bool)
    _PLAIN[0x21:0x7F] = True

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, number in vocabulary.items():  # one character stands for one byte
            self.token_bytes[number] = len(token.encode() if token in added else token)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)  # ends[k] is where piece k - 1 ends

    def _learn(self, pieces: list[bytes]) -> None:
        """Encode new pieces, many joined to one text where a cut lies between them."""
        whole = pa.array(pieces, pa.large_binary())
        data = np.frombuffer(whole.buffers()[2] or b"", dtype=np.uint8)
        edges = np.frombuffer(whole.buffers()[1], dtype=np.int64)[: len(pieces) + 1]
        safe = np.isin(edges[:-1], self.cuts(data))
        nth = np.arange(len(pieces))
        first = np.flatnonzero(~safe | (nth % 512 == 0))
        text = data.tobytes()
        bounds = [*edges[first].tolist(), len(text)]
        texts = [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for a in range(0, len(texts), 512):
            part = texts[a : a + 512]
            found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in part], add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in found])
            lo = int(first[a])
            hi = int(first[a + 512]) if a + 512 < first.size else len(pieces)
            # Tokens are bytes of the text in order: their lengths say to which piece each belongs.
            size = np.cumsum(self.token_bytes[ids])
            if ids.size and size[-1] == edges[hi] - edges[lo]:
                ends = np.searchsorted(size, edges[lo + 1 : hi + 1] - edges[lo], side="left") + 1
            else:  # bytes that are no text: piece by piece
                alone = [self.tokenizer.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids for p in pieces[lo:hi]]
                ids = np.array([i for e in alone for i in e], dtype=np.uint32)
                ends = np.cumsum([len(e) for e in alone])
            self._keep(pieces[lo:hi], ids, ends)

    def _keep(self, pieces: list[bytes], ids: np.ndarray, ends: np.ndarray) -> None:
        start = len(self.known)
        base = int(self.ends[start])
        self.flat = _grown(self.flat, base + ids.size)
        self.ends = _grown(self.ends, start + len(pieces) + 1)
        self.flat[base : base + ids.size] = ids
        self.ends[start + 1 : start + len(pieces) + 1] = base + ends
        self.known.update(zip(pieces, range(start, start + len(pieces)), strict=True))

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions of spaces at which a new piece starts."""
        at = np.flatnonzero(data == 0x20)
        at = at[(at > 1) & (at < data.size - 1)]
        before, two, after = data[at - 1], data[at - 2], data[at + 1]
        plain = self._PLAIN
        left = plain[before] | ((before >= 0x80) & (two >= 0xC3) & (two <= 0xDF))
        right = plain[after] | ((after >= 0xC3) & (after <= 0xDF))
        return at[left & right]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        data, offsets = text_bytes(column)
        filled = offsets[:-1][np.diff(offsets) > 0]
        starts = np.concatenate([filled, self.cuts(data)])
        starts.sort()
        starts = starts[np.diff(starts, prepend=-1) > 0]
        ends = np.append(starts[1:], data.size)[: starts.size]
        raw = pa.Array.from_buffers(
            pa.large_binary(), starts.size, [None, pa.py_buffer(np.append(starts, data.size).astype(np.int64)), pa.py_buffer(data)]
        )
        pieces = raw.dictionary_encode() if starts.size else None
        if pieces is None:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(column), dtype=np.int64)
        distinct = pieces.dictionary.to_pylist()
        if len(self.known) + len(distinct) > CACHE_PIECES:
            self.forget()
        self._learn([p for p in distinct if p not in self.known])
        number = np.fromiter(map(self.known.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        number = number[pieces.indices.to_numpy()]
        first = self.ends[number]
        lengths = self.ends[number + 1] - first
        total = np.zeros(number.size + 1, dtype=np.int64)
        np.cumsum(lengths, out=total[1:])
        at = np.arange(total[-1]) + np.repeat(first - total[:-1], lengths)
        bounds = np.searchsorted(starts, offsets)
        return self.flat[at], np.diff(total[bounds])


def _grown(array: np.ndarray, need: int) -> np.ndarray:
    if need < array.size:
        return array
    return np.concatenate([array, np.zeros(max(need + 1 - array.size, array.size), dtype=array.dtype)])


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _write(batches: Iterator[pa.RecordBatch], root: str, tokenizer: str, width: int, end_id: int) -> Iterator[pa.RecordBatch]:
    uri = f"{root}/{attempt_name('ids', '.bin')}"
    out = None
    for batch in steps(batches, "text", 2 << 20):
        ids, lengths = _encoder(tokenizer).encode(batch.column("text"))
        if width == 2 and ids.size and int(ids.max()) > 0xFFFF:
            raise ValueError("an id needs more than two bytes")
        out = out or TokenFile(uri, width)
        ids = np.insert(ids, np.cumsum(lengths), end_id)
        out.add(ids, lengths + 1, batch.column("doc_id"))
    if out is not None:
        documents = out.close()
        row = [[TaskContext.get().partitionId()], [uri], [documents], [out.ids]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=["shard", "uri", "documents", "ids"])


def write_ids(docs: DataFrame, tokenizer: str, width: int = 2, end_id: int = END_ID) -> DataFrame:
    """Encode all documents into files in ascending ``doc_id`` order; the manifest.

    ``tokenizer`` is the path of a tokenizer file on every machine. ``end_id`` is
    appended to each document. The manifest has ``shard, uri, documents, ids,
    start``: files in order, and the ids of all files before. Null ids come
    first, a null or empty text is its end id alone, rows with equal ids stand
    next to each other in no fixed order. An empty table gives no file.
    """
    root = folder(docs.sparkSession, "token-files")
    spread = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text"), F.rand(11))
    ordered = spread.sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = ordered.mapInArrow(
        lambda b: released(_write(b, root, tokenizer, width, end_id)), "shard long, uri string, documents long, ids long"
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return stored(written, "token-manifest").withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file in batch.to_pylist():
            reader = TokenReader(file["uri"])
            docs = reader.doc_ids()
            for a in range(0, reader.documents, 1024):
                b = min(a + 1024, reader.documents)
                ends = reader.ends.select(np.arange(a, b + 1))
                crcs = [
                    zlib.crc32(reader.ids(first, last).astype("<u4").tobytes())
                    for first, last in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [docs[a:b], pa.array(ends[:-1] + file["start"]), pa.array(np.diff(ends)), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_back(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    files = manifest.select("uri", "start")
    spread = files.repartition(max(1, files.count()))
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
