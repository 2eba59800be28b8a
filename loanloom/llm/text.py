"""Vectorised text helpers for Arrow batches: bytes, words and hashes.

All of them work on whole texts. A null text counts as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one step holds as arrays; a longer single text is one step.
STEP_BYTES = 4 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes of `[^\x20\x09-\x0D]+`.
TOKEN_BYTES = np.ones(256, dtype=bool)
TOKEN_BYTES[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size) - size) // limit
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


try:  # of glibc; other allocators keep less
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):
    _trim = None


def release() -> None:
    """Give the memory that was freed back to the system.

    A worker lives on after its task: unless told, the allocators hold what its largest step took.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def released(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows; between them and after the last one freed memory is given back."""
    for row in rows:
        yield row
        del row
        release()
    release()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and its n + 1 offsets into them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    ends = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


class Words:
    """The words of some texts, as positions in their bytes.

    ``bounds[i]:bounds[i + 1]`` are the words of text i; ``starts`` and ``ends``
    are byte positions. ``data`` are the (lower-cased) bytes.
    """

    def __init__(self, column: pa.Array, kind: np.ndarray, lower: bool = True):
        data, self.offsets = text_bytes(column)
        self.data = lower_ascii(data) if lower else data
        self.inside = kind[self.data]
        n = self.data.size
        before = np.zeros(n, dtype=bool)
        after = np.zeros(n, dtype=bool)
        if n:
            before[1:] = self.inside[:-1]
            after[:-1] = self.inside[1:]
            inner = self.offsets[(self.offsets > 0) & (self.offsets < n)]
            before[inner] = False
            after[inner - 1] = False
        self.starts = np.flatnonzero(self.inside & ~before)
        self.ends = np.flatnonzero(self.inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def array(self) -> pa.Array:
        """The words as one Arrow array, in order."""
        ends = np.zeros(self.starts.size + 1, dtype=np.int64)
        np.cumsum(self.ends - self.starts, out=ends[1:])
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(self.data[self.inside])]
        return pa.Array.from_buffers(pa.large_binary(), self.starts.size, buffers)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        words = self.data[self.inside]
        ends = np.cumsum(self.ends - self.starts)
        return span_hashes(words, ends - (self.ends - self.starts), ends)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}
KEPT_POWERS = (1 << 20) + 1


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2^64.

    Those of usual blocks are kept for the next call, longer ones are not.
    """
    held = _powers if n <= KEPT_POWERS else {}
    if "up" not in held or held["up"].size < n:
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps_ = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps_[0] = 1
            held[key] = np.cumprod(steps_, dtype=np.uint64)
    return held["up"][:n], held["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """Polynomial hashes of ``data[starts[i]:ends[i]]``, spans in order and disjoint.

    Prefix sums of byte times power give every span in two look-ups; blocks
    bound the arrays. A span longer than the block is a block of its own.
    """
    out = np.zeros(starts.size, dtype=np.uint64)
    i = 0
    while i < starts.size:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + block, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        up, down = _power(b - a + 1)
        total = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def hashed_windows(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows of each text, and the texts' bounds in them.

    A text of fewer words, but not none, has one window: all its words.
    """
    counts = np.diff(bounds)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    edges = np.zeros(bounds.size, dtype=np.int64)
    np.cumsum(sizes, out=edges[1:])
    at = np.arange(edges[-1]) + np.repeat(bounds[:-1] - edges[:-1], sizes)
    limit = np.repeat(bounds[1:], sizes)
    padded = np.concatenate([words, np.zeros(n, dtype=np.uint64)])
    out = np.zeros(at.size, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            inside = at + k < limit
            out = out * np.uint64(_BASE) + np.where(inside, padded[at + k], np.uint64(0x51ED270B))
    return mix(out), edges


def crc32_text(number: pa.Array) -> np.ndarray:
    """crc32 of each number written as text; -1 for null."""
    import zlib

    return np.array([-1 if x is None else zlib.crc32(str(x).encode()) for x in number.to_pylist()], dtype=np.int64)
