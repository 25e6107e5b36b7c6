"""Word hashes of many texts at once, with numpy, for the tasks of several operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Bytes that separate words: white space, or everything but ASCII letters, digits and bytes from 0x80.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
NO_LETTER = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
VALUE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=U)
#: Bytes of text that are hashed at once.
AT_ONCE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    for _ in range(2):
        x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def encoded(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as UTF-8, in runs of about AT_ONCE bytes, with the index of the first."""
    first, size, run = 0, 0, []
    for i, text in enumerate(texts):
        data = (text or "").encode()
        if run and size + len(data) > AT_ONCE:
            yield first, run
            first, size, run = i, 0, []
        run.append(data)
        size += len(data) + 1
    if run:
        yield first, run


def word_hashes(run: list[bytes], between: np.ndarray, prefixes: tuple[int, ...] = ()) -> tuple:
    """Hashes of the words of all texts, where each text's words end, and hashes of word prefixes.

    A-Z are lowered. For each size in ``prefixes`` there is an array of the hashes of the
    words' first so many bytes (of the whole word if it is shorter).
    """
    data = LOWER[np.frombuffer(b"\n".join(run) + b"\n", np.uint8)]
    gap = between[data] | (data == 10)
    before = np.concatenate(([True], gap[:-1]))
    starts, stops = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    sizes = stops - starts
    ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in run]))
    if not len(starts):
        return np.zeros(0, U), ends, [np.zeros(0, U) for _ in prefixes]
    firsts = np.cumsum(sizes) - sizes
    at = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, U))
    parts = VALUE[data[~gap]] * powers[at]
    size_part = sizes.astype(U) * U(0xA24BAED4963EE407)
    whole = mixed(np.add.reduceat(parts, firsts) + size_part)
    heads = [mixed(np.add.reduceat(np.where(at < n, parts, U(0)), firsts) + U(n)) for n in prefixes]
    return whole, ends, heads


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each ``size`` consecutive words."""
    n = len(hashes) - size + 1
    out = hashes[: max(n, 0)].copy()
    for i in range(1, size):
        out = mixed(out * U(0x9FB21C651E98DF25) + hashes[i : i + n])
    return out
