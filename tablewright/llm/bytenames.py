"""Names (64-bit fingerprints) of byte strings by prefix doubling, with numpy, inside a task.

The name of a string of 2m bytes is made from the names of its two halves, so names of all
strings of a length are had from those of half the length at two offsets.
"""

from __future__ import annotations

import numpy as np

from tablewright.llm.words import VALUE, U

#: Bytes that are named at once.
AT_ONCE = 1 << 18


def paired(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * U(0x9FB21C651E98DF25) + right
    x ^= x >> U(29)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of twice the ``size`` that ``names`` have, at every position."""
    return paired(names[:-size], names[size:])


def names(data: np.ndarray, size: int) -> np.ndarray:
    """Names of all strings of ``size`` bytes, or of ``size`` names, by the binary digits of ``size``."""
    power, at, out, done = VALUE[data] if data.dtype == np.uint8 else data, 1, None, 0
    while True:
        if size & at:
            out = power if out is None else paired(out[: len(data) - done - at + 1], power[done:])
            done += at
        if done == size:
            return out
        power, at = doubled(power, at), at * 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size = 1
    while size * 2 <= width:
        x, size = np.minimum(x[:-size], x[size:]), size * 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x
