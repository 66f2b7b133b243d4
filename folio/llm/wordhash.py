"""Vectorised 64-bit hashes of the words of many texts at once.

Words are runs of bytes outside x20 and x09-x0D.  A word's hash is a
polynomial of its bytes (prefix sums over the batch), passed through a
64-bit finaliser; a window's hash mixes the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_RNG = np.random.default_rng(20240607)
BYTE_VALUE = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64) | U(1)
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 2**64)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (kept per worker)."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", BASE), ("down", BASE_INV)):
            p = np.full(size, U(base))
            p[0] = U(1)
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def finalise(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = hash of data[i:j] times BASE**i."""
    up, _ = powers(len(data))
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up, out=s[1:])
    return s


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of every
    row (with the total at the end).  Rows end words."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = WORD_BYTE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    s = prefix_sums(data)
    _, down = powers(len(data))
    h = (s[ends] - s[starts]) * down[starts]
    h += (ends - starts).astype(np.uint64)
    return finalise(h)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words (rows not yet considered)."""
    n = max(0, len(h) - size + 1)
    out = np.full(n, U(size * 0x5851F42D4C957F2D % 2**64))
    for j in range(size):
        out = (out ^ h[j:j + n]) * U(0x9FB21C651E98DF25)
        out ^= out >> U(28)
    return finalise(out)
