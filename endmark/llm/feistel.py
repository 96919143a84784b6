"""A keyed permutation of [0, n): a balanced Feistel network on the next even number of bits, walked along its cycle until it is back inside."""

from __future__ import annotations

import numpy as np

ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 (published constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    steps = np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mix(np.uint64(seed % 2**64) + steps)


def _half(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _network(x: np.ndarray, half: int, keys: np.ndarray, forward: bool) -> np.ndarray:
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    left, right = x >> bits, x & mask
    for key in keys if forward else keys[::-1]:
        if forward:
            left, right = right, left ^ (_mix(right + key) & mask)
        else:
            left, right = right ^ (_mix(left + key) & mask), left
    return (left << bits) | right


def permute(x: np.ndarray, n: int, seed: int, forward: bool = True) -> np.ndarray:
    """The place of each row number of x under the permutation of [0, n) that seed names; forward=False undoes it."""
    half, keys = _half(n), _keys(seed)
    with np.errstate(over="ignore"):
        out = _network(np.asarray(x, dtype=np.uint64), half, keys, forward)
        outside = np.flatnonzero(out >= n)
        while outside.size:  # a cycle that starts inside comes back inside
            out[outside] = _network(out[outside], half, keys, forward)
            outside = outside[out[outside] >= n]
    return out.astype(np.int64)
