"""SHA-256 of many equally cut messages at once, with states that can be kept, stored and resumed.

A state is the eight words after some whole blocks. A digest as hexadecimal text is exactly one block of
64 bytes, so the hash over a run of digests has a state between any two of them. `hashlib` can copy a state
but not store it; here states are arrays, one message a column. Nothing here knows Spark.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

STEP = 8192  # messages hashed together: enough to outweigh the calls, few enough to stay in the cache

_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if mid**3 <= n else (low, mid - 1)
    return low


# The constants by their rule: the first 32 bits behind the point of the roots of the first primes.
_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))][:64]
_ROUND = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _PRIMES]
_START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)


def start(n: int) -> np.ndarray:
    """The states of n empty messages: 8 words, n columns."""
    return np.repeat(_START[:, None], n, axis=1)


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def _absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    words = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = words[i - 15], words[i - 2]
            words.append(
                words[i - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                + words[i - 7] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10)))
            )
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + words[i]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack((a, b, c, d, e, f, g, h))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block of 16 words each."""
    if state.shape[1] <= STEP:
        return _absorb(state, block)
    cuts = range(0, state.shape[1], STEP)
    return np.concatenate([_absorb(state[:, k : k + STEP], block[:, k : k + STEP]) for k in cuts], axis=1)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests, 8 words each, of messages that end after so many whole blocks."""
    bits = blocks.astype(np.uint64) * np.uint64(512)
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0] = 1 << 31
    last[14], last[15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return absorb(state, last)


def to_bytes(digest: np.ndarray) -> np.ndarray:
    """Words of columns as rows of bytes: 32 for a digest or state, 64 for a block."""
    return np.ascontiguousarray(digest.T).astype(">u4").view(np.uint8)


def from_bytes(raw: np.ndarray) -> np.ndarray:
    """Rows of bytes as columns of words."""
    return np.ascontiguousarray(np.ascontiguousarray(raw).view(">u4").astype(np.uint32).T)


def hexed(raw: np.ndarray) -> np.ndarray:
    """Rows of 32 digest bytes as rows of the 64 bytes of their hexadecimal text."""
    out = np.empty((len(raw), 64), np.uint8)
    out[:, 0::2], out[:, 1::2] = _HEX[raw >> 4], _HEX[raw & 15]
    return out
