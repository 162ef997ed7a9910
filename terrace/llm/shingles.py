"""Hashed word n-grams of whole texts, and packed lists of them."""

from __future__ import annotations

import numpy as np
import zstandard

_M = (1 << 64) - 1
PIECE = 1 << 22

#: N-grams are hashed to so many bits: a long that is never negative.
BITS = 56


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _odd(seed: int, count: int) -> np.ndarray:
    return _mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTES = _odd(1, 256)
_BYTES[65:91] = _BYTES[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(base: int, count: int) -> np.ndarray:
    """1, base, base squared .. modulo 2 ** 64."""
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word between white space, A-Z as a-z, in order; in memory for a few millions of bytes."""
    data, at, found = text.encode("utf-8", "replace"), 0, []
    while at < len(data):
        end = len(data)
        if end - at > PIECE:  # a piece ends where a word does; a longer word is a piece
            cut = at + PIECE
            while cut < end and not _SPACE[data[cut]]:
                cut += 1
            end = cut
        found.append(_hashed(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _hashed(b: np.ndarray) -> np.ndarray:
    if len(b) >= len(_POWERS[0]):
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = _powers(_BASE, 2 * len(b) + 1), _powers(inverse, 2 * len(b) + 1)
    inside = np.concatenate([[False], ~_SPACE[b], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _POWERS[0][: len(b)], out=sums[1:])
    whole = (sums[ends] - sums[starts]) * _POWERS[1][starts]
    return _mix(whole + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """The distinct n-grams of words, as sorted longs; of fewer words, the whole sequence; of none, nothing."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    size = min(n, len(words))
    factors = _odd(2 + n - size, size)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * factors[k]
    return np.unique(_mix(total) >> np.uint64(64 - BITS))


def set_hash(grams: np.ndarray) -> int:
    """A signed long that stands for a set."""
    total = int(_mix(grams * np.uint64(0xA24BAED4963EE407) + np.uint64(1)).sum()) + len(grams) * _BASE
    return int(_mix(np.array([total & _M], np.uint64)).view(np.int64)[0])



def pack(values: np.ndarray) -> bytes:
    """Whole numbers, small differences in a row for few bytes: the bytes of each weight together, compressed."""
    steps = np.diff(values.astype(np.int64), prepend=np.int64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())
