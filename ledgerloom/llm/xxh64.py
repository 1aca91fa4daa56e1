"""XXH64 of many short byte spans at once. Constants and rounds follow the public XXH64 specification."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
#: Fixed values of the XXH64 specification.
PRIME_1 = U(11400714785074694791)
PRIME_2 = U(14029467366897019727)
PRIME_3 = U(1609587929392839161)
PRIME_4 = U(9650029242287828579)
PRIME_5 = U(2870177450012600261)
SHORT = 32  # from this length on the specification uses four lanes


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << U(n)) | (x >> U(64 - n))


def _shifted(data: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian integer that starts at each byte; data must have 8 bytes of padding."""
    raw = np.ndarray(shape=(len(data) - 8,), dtype=kind, buffer=data, strides=(1,))
    return np.ascontiguousarray(raw)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """XXH64(data[start:end], seed) for each span."""
    size = ends - starts
    h = (size + seed).astype(U) + PRIME_5
    short = np.flatnonzero(size < SHORT)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight, at = _shifted(padded, "<u8"), starts.copy()
    for lane in range(3):
        i = short[size[short] >= 8 * (lane + 1)]
        k = _rotl(eight[at[i]] * PRIME_2, 31) * PRIME_1
        h[i] = _rotl(h[i] ^ k, 27) * PRIME_1 + PRIME_4
        at[i] += 8
    i = short[(ends[short] - at[short]) >= 4]
    k = (eight[at[i]] & U(0xFFFFFFFF)) * PRIME_1
    h[i] = _rotl(h[i] ^ k, 23) * PRIME_2 + PRIME_3
    at[i] += 4
    for _ in range(3):
        i = short[at[short] < ends[short]]
        h[i] = _rotl(h[i] ^ (padded[at[i]].astype(U) * PRIME_5), 11) * PRIME_1
        at[i] += 1
    h ^= h >> U(33)
    h *= PRIME_2
    h ^= h >> U(29)
    h *= PRIME_3
    h ^= h >> U(32)
    long = np.flatnonzero(size >= SHORT)
    if len(long):
        view, one = memoryview(np.ascontiguousarray(data)), xxhash.xxh64_intdigest
        h[long] = np.array([one(view[a:b], seed) for a, b in zip(starts[long].tolist(), ends[long].tolist())], U)
    return h
