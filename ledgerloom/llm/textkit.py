"""Words and shingles of whole Arrow batches at once, by NumPy on the string buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# texts are worked on in pieces of about this many bytes, so memory does not depend on the batch;
# the arrays of a piece take some twenty-five times its bytes while its words are hashed
PIECE_BYTES = 512 << 10

_ROWS = 64
_rng = np.random.Generator(np.random.PCG64(20240607))
_TABLE = _rng.integers(0, 1 << 64, size=_ROWS * 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# for looser comparison: all of ASCII but letters and digits separates words
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) such that a slice has at most about PIECE_BYTES bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > PIECE_BYTES:
            yield start, texts.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < len(texts):
        yield start, texts.slice(start)


def buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls; offsets start at 0."""
    strings = strings.cast(pa.large_binary())
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of many texts: their bytes without white space, word offsets, and each text's range of words.

    Words are runs of anything but ASCII white space (space, and 9 to 13), or but
    the bytes ``between`` marks; A to Z become lower case unless told otherwise.
    A null text has no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = True, between: np.ndarray = _SPACE):
        raw, offsets = buffers(pc.fill_null(texts.cast(pa.large_string()), ""))
        inside = ~between[raw]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][np.diff(offsets) > 0]
        first[begins] = inside[begins]  # a text's end also ends a word
        at = np.flatnonzero(first)
        # places in the bytes of all texts: of words, of texts, and of line feeds
        self.starts, self.text_starts, self.breaks = at, offsets[:-1], np.flatnonzero(raw == 10)
        self.bytes = (_LOWER[raw] if lower else raw)[inside]
        letters = np.concatenate(([0], np.cumsum(inside, dtype=np.int64)))
        self.offsets = np.concatenate((letters[at], [len(self.bytes)]))
        self.bounds = np.searchsorted(at, offsets)

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def arrow(self) -> pa.Array:
        return pa.Array.from_buffers(
            pa.large_string(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(np.ascontiguousarray(self.bytes))]
        )

    def hashes(self) -> np.ndarray:
        """64-bit hashes: a sum of random table entries by place and byte, then mixed."""
        if not len(self):
            return np.empty(0, np.uint64)
        lengths = np.diff(self.offsets)
        place = np.arange(len(self.bytes), dtype=np.int64) - np.repeat(self.offsets[:-1], lengths)
        terms = _TABLE[(place % _ROWS) * 256 + self.bytes]
        if lengths.max() > _ROWS:  # places beyond the table: other odd factors
            with np.errstate(over="ignore"):
                terms = terms * (((place // _ROWS).astype(np.uint64) * _STEP) | np.uint64(1))
        with np.errstate(over="ignore"):
            return mix(np.add.reduceat(terms, self.offsets[:-1]) + lengths.astype(np.uint64) * _STEP)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """63-bit hashes (as int64) of all runs of ``k`` words; of fewer words, of the whole sequence."""
    if not len(words):
        return np.empty(0, np.int64)
    size = min(k, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            total = total * _STEP + words[i : len(words) - size + 1 + i]
        total += np.uint64(size)
    return (mix(total) >> np.uint64(1)).astype(np.int64)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for every text."""
    for first, part in pieces(texts):
        words = Words(part)
        hashes, bounds = words.hashes(), words.bounds
        for i in range(len(part)):
            yield first + i, np.unique(shingle_hashes(hashes[bounds[i] : bounds[i + 1]], k))
