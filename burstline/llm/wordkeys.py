"""Words as 64-bit keys, in numpy: runs of bytes, and hashes that aren't linear."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

from burstline.llm.textbytes import mix

#: Longer words are hashed one by one.
LONG = 64


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked bytes, and each text's first run.

    ``inside`` marks bytes of texts that lie one after another; ``offsets`` are the
    texts' bounds, which no run crosses.
    """
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = offsets[(offsets > 0) & (offsets < len(inside))]
    change = np.empty(len(inside) + 1, bool)
    change[1:-1] = inside[1:] != inside[:-1]
    change[0] = change[-1] = True
    change[cut] = True
    edges = np.flatnonzero(change)
    own = inside[edges[:-1]]
    starts = edges[:-1][own]
    return starts, edges[1:][own], np.searchsorted(starts, offsets)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit keys of words; equal words have equal keys, none is 0.

    Eight bytes at a time are mixed into a state that starts from the salt and the
    length. Different words may share a key, so users compare the words too.
    """
    lengths = (ends - starts).astype(np.uint64)
    keys = mix(lengths * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 2 + 1))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    rows = np.flatnonzero(lengths <= LONG)
    at, left = starts[rows], lengths[rows]
    while len(rows):
        shift = np.where(left < 8, np.uint64(64) - left * np.uint64(8), np.uint64(0))
        block = blocks[at] << shift
        keys[rows] = mix(mix(keys[rows] ^ block) + np.uint64(0xD6E8FEB86659FD93))
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - np.uint64(8)
    tag = salt.to_bytes(8, "little")
    for i in np.flatnonzero(lengths > LONG).tolist():
        word = data[starts[i] : ends[i]].tobytes()
        keys[i] = int.from_bytes(blake2b(word, digest_size=8, salt=tag).digest(), "little")
    return np.maximum(keys, np.uint64(1))


def number_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """A number for each distinct (word, ``code``), and one occurrence of each number.

    Words are sorted by their keys, then each is compared with the one that stands
    for it, byte by byte; should two different words share a key, they are sorted
    by another one.
    """
    salt = 1
    while True:
        keys = mix(word_keys(data, starts, ends, salt) + code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, sample, number = np.unique(keys, return_index=True, return_inverse=True)
        twin = sample[number]
        if _equal(data, starts, ends, twin) and (code == code[twin]).all():
            return number, sample
        salt += 1


def _equal(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, twin: np.ndarray) -> bool:
    """Whether each word equals word ``twin[i]``."""
    left = ends - starts
    if (left != left[twin]).any():
        return False
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    a, b = starts, starts[twin]
    other = a != b
    a, b, left = a[other], b[other], left[other]
    while len(a):
        shift = np.where(left < 8, 64 - left * 8, 0).astype(np.uint64)
        if (((blocks[a] ^ blocks[b]) << shift) != 0).any():
            return False
        more = left > 8
        a, b, left = a[more] + 8, b[more] + 8, left[more] - 8
    return True


def text_key(text: str, salt: int = 0) -> np.uint64:
    """The key of one short text."""
    tag = salt.to_bytes(8, "little")
    return np.uint64(int.from_bytes(blake2b(text.encode(), digest_size=8, salt=tag).digest(), "little"))


def strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The spans as an Arrow string array."""
    import pyarrow as pa

    lengths = ends - starts
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    place = np.repeat(starts - bounds[:-1], lengths) + np.arange(bounds[-1])
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data[place]))
    ).cast(pa.string())
