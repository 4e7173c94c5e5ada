"""Texts as flat byte arrays: words, rolling hashes and batches, in numpy.

A batch of texts is one ``uint8`` array with one offset per text. Words are the
runs of bytes outside ``[\\x20\\x09-\\x0D]``; the white space is ASCII, so byte
and code point views agree on them.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that one step handles at once; a longer text is a step alone.
STEP_BYTES = 4 << 20
#: The same for steps that need many arrays as long as the text.
SMALL_STEP = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def steps(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = STEP_BYTES):
    """Cut Arrow batches into pieces of bounded text size; rows stay whole."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    release()


def release() -> None:
    """Give memory that a finished task no longer uses back to the system.

    Workers are kept for later tasks, and what their allocators hold on to counts
    against the executor.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the words, and for each text its first word's index."""
    inside = ~SPACE[data]
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    fresh = np.empty_like(inside)
    fresh[0], fresh[1:] = True, ~inside[:-1]
    fresh[cut] = True
    starts = np.flatnonzero(inside & fresh)
    last = np.empty_like(inside)
    last[-1], last[:-1] = True, ~inside[1:]
    last[cut - 1] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every bit of the input reaches every bit."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n; kept for the next call."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= 1 << 22:
            _POWERS[base] = known
    return known[:n]


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0):
    """64-bit hash of each ``values[start:end]``; equal ranges have equal hashes.

    ``values`` are ``uint64``; ``starts`` ascend. Works in blocks, so memory is
    bounded by the block and the longest range.
    """
    base = _BASE + 2 * salt * 0x1000193
    back = pow(base, -1, 1 << 64)
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        low = int(starts[begin])
        end = max(begin + 1, int(np.searchsorted(starts, low + (1 << 19))))
        high = int(ends[begin:end].max(initial=low))
        part = values[low:high].astype(np.uint64, copy=False)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(part * powers(high - low, base), out=total[1:])
        s, e = starts[begin:end] - low, ends[begin:end] - low
        h = (total[e] - total[s]) * powers(int(s.max(initial=0)) + 1, back)[s]
        out[begin:end] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        begin = end
    return out


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; ``starts`` ascend."""
    out = np.empty(len(starts), np.uint64)
    begin = 0
    while begin < len(starts):
        low = int(starts[begin])
        end = max(begin + 1, int(np.searchsorted(starts, low + (1 << 19))))
        high = int(ends[begin:end].max(initial=low))
        out[begin:end] = range_hash(
            _BYTE[data[low:high]], starts[begin:end] - low, ends[begin:end] - low
        )
        begin = end
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's ``bigint``."""
    return np.asarray(x, np.uint64).view(np.int64)


def lowest_share(hashed: Column, share: float) -> Column:
    """Whether a 64-bit hash lies in the lowest ``share`` of its range."""
    if share >= 1:
        return F.lit(True)
    return hashed < int(share * 2**64) - 2**63
