"""Static binary-fuse filters over 64-bit keys (three slots a key, 8-bit marks).

A filter answers "certainly absent" or "perhaps present" (about 1 in 256
wrong). It is built once for an immutable key set and never changes.
"""

from __future__ import annotations

import math

import numpy as np

_U = np.uint64


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of key + seed."""
    with np.errstate(over="ignore"):
        h = keys.astype(_U) + _U(seed)
        h ^= h >> _U(33)
        h *= _U(0xFF51AFD7ED558CCD)
        h ^= h >> _U(33)
        h *= _U(0xC4CEB9FE1A85EC53)
        return h ^ (h >> _U(33))


def layout(n: int) -> tuple[int, int]:
    """(segment length, number of first segments) for n keys."""
    if n < 2:
        return 4, 1
    seg = 1 << min(18, int(math.floor(math.log(n) / math.log(3.33) + 2.25)))
    room = n * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return seg, max(1, math.ceil(room / seg) - 2)


def slots(h: np.ndarray, seg: int, count: int) -> np.ndarray:
    """The three slots of each hash, one row each."""
    span, mask = _U(seg * count), _U(seg - 1)
    a = ((h >> _U(32)) * span) >> _U(32)
    b = (a + _U(seg)) ^ ((h >> _U(18)) & mask)
    c = (a + _U(2 * seg)) ^ (h & mask)
    return np.stack([a, b, c]).astype(np.int64)


def marks(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> _U(32))) & _U(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, first segments, fingerprints) for any int64 keys."""
    keys = np.unique(np.asarray(keys).astype(np.int64)).view(_U)
    n = len(keys)
    seg, count = layout(n)
    for attempt in range(1000):
        if attempt and attempt % 20 == 0:
            count += 1 + count // 8  # more room after many unlucky seeds
        size = seg * (count + 2)
        seed = (attempt + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
        h = mix(keys, seed)
        at = slots(h, seg, count)
        load = np.zeros(size, np.int64)
        who = np.zeros(size, np.int64)
        ids = np.arange(n)
        for row in at:
            np.add.at(load, row, 1)
            np.bitwise_xor.at(who, row, ids)
        rounds, left = [], n
        free = np.flatnonzero(load == 1)
        while len(free):
            key, first = np.unique(who[free], return_index=True)
            rounds.append((key, free[first]))
            left -= len(key)
            for row in at[:, key]:
                np.subtract.at(load, row, 1)
                np.bitwise_xor.at(who, row, key)
            touched = np.unique(at[:, key])
            free = touched[load[touched] == 1]
        if left:
            continue
        out = np.zeros(size, np.uint8)
        mark = marks(h)
        for key, slot in reversed(rounds):
            three = at[:, key]
            others = out[three[0]] ^ out[three[1]] ^ out[three[2]]  # the own slot is still 0
            out[slot] = mark[key] ^ others
        return seed, seg, count, out.tobytes()
    raise ValueError("no fuse filter found")


def contains(keys: np.ndarray, seed: int, seg: int, count: int, fingerprints: bytes) -> np.ndarray:
    """For each key, whether it may be in the set."""
    h = mix(np.asarray(keys).astype(np.int64).view(_U), seed)
    f = np.frombuffer(fingerprints, np.uint8)
    a, b, c = slots(h, seg, count)
    return (f[a] ^ f[b] ^ f[c]) == marks(h)
