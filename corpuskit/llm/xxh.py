"""XXH64 of many slices of one buffer at once, in numpy (public xxHash specification)."""

from __future__ import annotations

import numpy as np
import xxhash

# Fixed values of the xxHash specification.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: Slices longer than this are hashed one by one by the xxhash library.
LONG = 512


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(word: np.ndarray) -> np.ndarray:
    return _rotl(word * P2, 31) * P1


def xxh64_slices(data: bytes, start: np.ndarray, size: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start:start + size]`` for each pair, as uint64."""
    out = np.empty(len(start), np.uint64)
    if not len(start):
        return out
    raw = np.frombuffer(data + bytes(8), np.uint8)
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    halves = np.ndarray((len(raw) - 7,), "<u4", raw, strides=(1,))
    begin, length = start.astype(np.int64), size.astype(np.int64)
    with np.errstate(over="ignore"):
        h = np.full(len(out), np.uint64(seed) + P5)
        at = begin.copy()
        big = np.flatnonzero((length >= 32) & (length <= LONG))
        if len(big):
            seed64 = np.uint64(seed)
            lanes = [np.full(len(big), x) for x in (seed64 + P1 + P2, seed64 + P2, seed64, seed64 - P1)]
            stripes = length[big] // 32
            for s in range(int(stripes.max())):
                live = np.flatnonzero(stripes > s)
                for k in range(4):
                    word = words[begin[big[live]] + 32 * s + 8 * k]
                    lanes[k][live] = _rotl(lanes[k][live] + word * P2, 31) * P1
            merged = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
            for lane in lanes:
                merged = (merged ^ _round(lane)) * P1 + P4
            h[big] = merged
            at[big] += 32 * stripes
        h += length.astype(np.uint64)
        left = begin + length - at
        left[length > LONG] = 0
        for _ in range(3):
            live = np.flatnonzero(left >= 8)
            if not len(live):
                break
            h[live] = _rotl(h[live] ^ _round(words[at[live]]), 27) * P1 + P4
            at[live] += 8
            left[live] -= 8
        live = np.flatnonzero(left >= 4)
        h[live] = _rotl(h[live] ^ (halves[at[live]].astype(np.uint64) * P1), 23) * P2 + P3
        at[live] += 4
        left[live] -= 4
        for _ in range(3):
            live = np.flatnonzero(left >= 1)
            h[live] = _rotl(h[live] ^ (raw[at[live]].astype(np.uint64) * P5), 11) * P1
            at[live] += 1
            left[live] -= 1
        h ^= h >> np.uint64(33)
        h *= P2
        h ^= h >> np.uint64(29)
        h *= P3
        h ^= h >> np.uint64(32)
    for i in np.flatnonzero(length > LONG):
        h[i] = xxhash.xxh64_intdigest(data[begin[i] : begin[i] + length[i]], seed)
    return h
