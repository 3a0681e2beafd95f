"""XXH64 of many short byte spans at once, in numpy."""

from __future__ import annotations

import numpy as np

# The five primes of the published XXH64 definition.
P1 = np.uint64(0x9E3779B185EBCA87)
P2 = np.uint64(0xC2B2AE3D27D4EB4F)
P3 = np.uint64(0x165667B19E3779F9)
P4 = np.uint64(0x85EBCA77C2B2AE63)
P5 = np.uint64(0x27D4EB2F165667C5)


def _rol(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rol(acc + lane * P2, 31) * P1


def xxh64_spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 with `seed` of data[start[i] : start[i] + length[i]] for every i, as uint64."""
    with np.errstate(over="ignore"):
        return _spans(np.concatenate([data, np.zeros(8, np.uint8)]), start, length, np.uint64(seed))


def _spans(data: np.ndarray, start: np.ndarray, length: np.ndarray, seed: np.uint64) -> np.ndarray:
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    four = np.ndarray((len(data) - 3,), "<u4", data, 0, (1,))
    h = np.full(len(start), seed + P5, np.uint64)
    stripes = length >> 5
    at = np.flatnonzero(stripes)
    if len(at):
        at = at[np.argsort(-stripes[at], kind="stable")]
        left, pos = stripes[at], start[at].copy()
        v = [np.full(len(at), x, np.uint64) for x in (seed + P1 + P2, seed + P2, seed, seed - P1)]
        for k in range(int(left[0])):
            live = int(np.searchsorted(-left, -k, "left"))
            for i in range(4):
                v[i][:live] = _round(v[i][:live], eight[pos[:live] + 8 * i])
            pos[:live] += 32
        acc = _rol(v[0], 1) + _rol(v[1], 7) + _rol(v[2], 12) + _rol(v[3], 18)
        for x in v:
            acc = (acc ^ _round(np.zeros_like(x), x)) * P1 + P4
        h[at] = acc
    h += length.astype(np.uint64)
    pos, rest = start + (stripes << 5), length & 31
    for k in range(3):
        m = slice(None) if (some := rest >= 8 * (k + 1)).all() else np.flatnonzero(some)
        h[m] = _rol(h[m] ^ _round(np.zeros((), np.uint64), eight[pos[m] + 8 * k]), 27) * P1 + P4
    pos = pos + (rest & 24)
    m = np.flatnonzero(rest & 4)
    h[m] = _rol(h[m] ^ (four[pos[m]].astype(np.uint64) * P1), 23) * P2 + P3
    pos, rest = pos + (rest & 4), rest & 3
    for k in range(3):
        m = np.flatnonzero(rest > k)
        h[m] = _rol(h[m] ^ (data[pos[m] + k].astype(np.uint64) * P5), 11) * P1
    h ^= h >> np.uint64(33)
    h *= P2
    h ^= h >> np.uint64(29)
    h *= P3
    return h ^ (h >> np.uint64(32))
