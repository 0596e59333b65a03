"""Keys along a Hilbert curve."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place along the Hilbert curve of each row of ``cells`` (n x d
    integers below 2**bits; bits * d at most 63), by Skilling's transform."""
    x = cells.astype(np.uint64).T.copy()
    d = len(x)
    one = np.uint64(1)
    q = 1 << (bits - 1)
    while q > 1:
        p, big = np.uint64(q - 1), np.uint64(q)
        for i in range(d):
            up = (x[i] & big) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(up, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.view(np.int64)
