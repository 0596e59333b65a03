"""Vectorised word and shingle hashes over Arrow batches of texts.

Texts are read as one UTF-8 buffer with offsets and handled in chunks of about
CHUNK bytes, so memory is bounded by the chunk and the longest single text.
Words are runs of bytes other than space and \\x09-\\x0D; only A-Z are lowered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S32, _S29, _S8 = np.uint64(32), np.uint64(29), np.uint64(8)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers one to one."""
    x = (x ^ (x >> _S32)) * _M2
    x ^= x >> _S29
    x *= _M1
    x ^= x >> _S32
    return x


_NEAR = 64
_TABLE = mix(np.arange(_NEAR * 256, dtype=np.uint64) + _M1)


def byte_hashes(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each (place in its word, byte); a word's hash is their sum."""
    at = place.astype(np.int32)
    far = np.flatnonzero(at >= _NEAR)
    at <<= 8
    at |= byte
    if not len(far):
        return _TABLE[at]
    beyond = mix((place[far].astype(np.uint64) << _S8) + byte[far] + _M1)
    at[far] = 0
    out = _TABLE[at]
    out[far] = beyond
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column's bytes and offsets (null: empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts
    of about ``size`` bytes."""
    data, offsets = buffers(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all words, and the number of words of each text."""
    inside = ~SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    return starts, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the number of words of each text."""
    starts, counts = word_starts(data, offsets)
    if not len(starts):
        return np.empty(0, np.uint64), counts
    inside = np.flatnonzero(~SPACE[data])
    first = np.searchsorted(inside, starts)
    lengths = np.diff(np.append(first, len(inside)))
    h = byte_hashes(inside - np.repeat(starts, lengths), LOWER[data[inside]])
    return mix(np.add.reduceat(h, first) + lengths.astype(np.uint64)), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of each text's word n-grams, one text after
    the other, and the size of each text's set. With fewer words the whole
    sequence is one element; without words the set is empty."""
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    begins = ends - counts
    n = np.minimum(counts, n_words)
    grams = counts - n + (counts > 0)
    text = np.repeat(np.arange(len(counts)), grams)
    at = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams) + begins[text]
    h = words[at]
    for k in range(1, n_words):
        longer = n[text] > k
        step = mix(h + _M1)
        step[longer] += words[at[longer] + k]
        h = step
    h = mix(h + n[text].astype(np.uint64))
    edges = np.append(0, np.cumsum(grams))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        h[a:b].sort()
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[keep], np.bincount(text[keep], minlength=len(counts))


def set_ids(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A positive 63-bit id of each set (0: the empty one)."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = (np.cumsum(sizes) - sizes)[full]
        total = np.add.reduceat(mix(h ^ _M1), starts)
        out[full] = np.maximum(mix(total + sizes[full].astype(np.uint64)) >> np.uint64(1), np.uint64(1))
    return out.view(np.int64)


def list_array(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow array of lists from values and list sizes."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat.view(np.int64), pa.int64()))
