"""Hashes of words and word shingles of one text, as NumPy arrays.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; a
shingle is five words in a row, or all words if there are fewer.  Hashes have 64
bits and stand for the shingles themselves in set comparisons.
"""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_CHUNK = 1 << 22
_LONG = 1024
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_M1, _M2, _ODD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; a bijection."""
    x = x ^ (x >> np.uint64(33))
    x = x * _M1
    x ^= x >> np.uint64(33)
    x *= _M2
    x ^= x >> np.uint64(33)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed))


_BYTE = seeds(256, 1)
_STEP = seeds(max(16, WORDS) + 1, 2) | np.uint64(1)
_POWER = np.multiply.accumulate(np.full(_LONG + 1, np.uint64(0xD6E8FEB86659FD93)))


def _piece_hashes(b: np.ndarray) -> np.ndarray:
    word = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    inner = np.flatnonzero(word)
    first = np.cumsum(sizes) - sizes
    at = np.arange(len(inner)) - np.repeat(first, sizes)
    sums = np.add.reduceat(_BYTE[b[inner]] * _POWER[np.minimum(at, _LONG)], first)
    out = mixed(sums + sizes.astype(np.uint64) * _ODD)
    for i in np.flatnonzero(sizes > _LONG):
        out[i] = int.from_bytes(hashlib.blake2b(b[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """The hash of each word in order; long texts go in pieces cut at white space."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if lower:
        data = data.lower()
    b = np.frombuffer(data, np.uint8)
    if len(b) <= _CHUNK:
        return _piece_hashes(b)
    out, at = [], 0
    while at < len(b):
        end = min(len(b), at + _CHUNK)
        while end < len(b) and not _SPACE[b[end]]:
            end += 1
        out.append(_piece_hashes(b[at:end]))
        at = end
    return np.concatenate(out)


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _STEP[0]
    for i in range(1, width):
        total += words[i : i + n] * _STEP[i]
    return mixed(total)


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; empty without words."""
    words = word_hashes(text)
    if 0 < len(words) < WORDS:
        return mixed((words * _STEP[: len(words)]).sum(keepdims=True) + np.uint64(len(words)))
    return np.unique(windows(words, WORDS))


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def signature(shingles: np.ndarray, multipliers: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The least value of each of the functions a * x + b over the set."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 2048):
        part = mixed(shingles[i : i + 2048])
        np.minimum(least, (part[:, None] * multipliers + offsets).min(axis=0), out=least)
    return least
