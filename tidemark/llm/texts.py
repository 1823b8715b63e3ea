"""Texts inside a task: Arrow batches as bytes, words and word n-grams as 64-bit hashes.

Nothing here knows Spark. A batch is cut into blocks of about half a megabyte, so the arrays made on the
way stay small however long a text is; a text longer than a block is hashed piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Every ASCII byte but letters and digits, for words without the marks around them.
MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_P)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = (_powers(b, BLOCK + 1) for b in (_P, pow(_P, -1, 1 << 64)))


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; a null row has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _hash_block(raw: np.ndarray, cuts: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a block of bytes and where the words start; no word reaches over a cut."""
    word = ~gaps[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0], edge[-1] = True, True
    edge[1:-1] = ~word[:-1]
    inside = cuts[(cuts > 0) & (cuts < len(raw))]
    edge[inside] = True
    starts = np.flatnonzero(word & edge[:-1])
    edge[1:-1] = ~word[1:]
    edge[inside] = True
    ends = np.flatnonzero(word & edge[1:]) + 1
    if len(raw) > BLOCK:
        up, down = _powers(_P, len(raw) + 1), _powers(pow(_P, -1, 1 << 64), len(raw) + 1)
    else:
        up, down = _UP, _DOWN
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[raw]] * up[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _blocks(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, from, to): whole rows up to a block, or pieces of one long row."""
    row, rows = 0, len(at) - 1
    while row < rows:
        if at[row + 1] - at[row] > BLOCK:
            low, end = int(at[row]), int(at[row + 1])
            while low < end:
                high = min(low + BLOCK, end)
                while high < end:  # on to the end of a word
                    gap = np.flatnonzero(_SPACE[raw[high : high + 4096]])
                    if len(gap):
                        high += int(gap[0])
                        break
                    high = min(high + 4096, end)
                yield row, row + 1, low, high
                low = high
            row += 1
        else:
            last = max(int(np.searchsorted(at, at[row] + BLOCK, "right")) - 1, row + 1)
            yield row, last, int(at[row]), int(at[last])
            row = last


def word_hashes(column: pa.Array, gaps: np.ndarray = _SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words, offsets of the rows in them) for runs of whole rows.

    Words are the runs of bytes between `gaps` (white space: tab to carriage return, and space), with A-Z
    in lower case. Every row comes in exactly one run.
    """
    raw, at = batch_bytes(column)
    parts: list[np.ndarray] = []
    for row, last, low, high in _blocks(raw, at):
        hashes, starts = _hash_block(raw[low:high], at[row : last + 1] - low, gaps)
        if last == row + 1 and (low, high) != (at[row], at[last]):
            parts.append(hashes)
            if high == at[last]:
                whole = np.concatenate(parts)
                parts = []
                yield row, whole, np.array([0, len(whole)])
        else:
            yield row, hashes, np.searchsorted(starts, at[row : last + 1] - low)


_SHINGLE = mix(np.arange(77, 85, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, words: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its n-grams of words); a shorter text is one n-gram, an empty one none."""
    for row, hashes, at in word_hashes(column):
        n = len(hashes) - words + 1
        grams = np.zeros(max(n, 0), np.uint64)
        for k in range(words if n > 0 else 0):
            grams += hashes[k : k + n] * _SHINGLE[k]
        grams = mix(grams)
        for i in range(len(at) - 1):
            low, high = int(at[i]), int(at[i + 1])
            if high - low >= words:
                own = np.sort(grams[low : high - words + 1])
                if len(own) > 1:
                    own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif high > low:
                few = hashes[low:high] * _SHINGLE[: high - low]
                own = mix(few.sum(dtype=np.uint64, keepdims=True) + np.uint64(high - low))
            else:
                own = np.empty(0, np.uint64)
            yield row + i, own


def set_id(values: np.ndarray) -> int:
    """A signed 64-bit number that stands for a set of hashes, whatever their order."""
    total = mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(values))).view(np.int64)[0])
