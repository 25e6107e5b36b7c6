"""Packing of token ids into windows by Karmarkar-Karp multiway differencing.

A document is its ids and an end id. It is cut into whole windows and a rest; the rest of one
document in ``CHANGE_OF`` is cut small, as change that evens out the windows. Pieces are
written once, with the CRC of their ids, so that ids never travel. They are then dealt to
groups of about ``GROUP`` pieces by a hash of their row in that table: a hot id or text
spreads like any other, and a re-run task sees the same rows. In a group each rest begins as a
partial partition of its own; the two partitions of the largest imbalance are merged, the
largest sums of one with the smallest of the other, until one is left. Whenever a window is
too full, the window count rises and the group starts anew.

Defined cases: a null or empty text is its end id alone; equal rows are packed as often as
they occur; an empty table gives no windows.

Ids: the merges of the given file are run by tiktoken, which gives the same ids several times
as fast, for texts of ASCII and Latin letters; others, and texts that name a special token, go
through the tokenizers library itself.
"""

from __future__ import annotations

import heapq
import json
import zlib
from bisect import insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import written

WINDOW = 2048
END_ID = 1
GROUP = 2048
CHANGE_OF = 20
CHANGE = 32

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"


@cache
def encoder(path: str):
    """text -> numpy array of ids, by the byte-level BPE file at ``path``."""
    import regex
    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = [x["content"] for x in model["added_tokens"]]
    # the file spells bytes as printable characters: those that are printable stand for themselves
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    ranks = {bytes(byte_of[c] for c in k): i for k, i in model["model"]["vocab"].items() if k not in special}
    fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)
    odd = regex.compile("|".join([r"[^\x00-ɏ‐-‧€]", *map(regex.escape, special)]))

    def ids(text: str) -> np.ndarray:
        if odd.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(fast.encode_ordinary(text), "<u4")

    return ids


def cuts(size: int, window: int, small: bool) -> list[int]:
    """The lengths of a document's pieces."""
    full, rest = divmod(size, window)
    tail = [CHANGE] * (rest // CHANGE) + [rest % CHANGE] if small else [rest]
    return [window] * full + [x for x in tail if x]


def pieces(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: the pieces of each row of ``docs``."""
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                start, whole = 0, zlib.crc32(ids.tobytes())
                for length in cuts(len(ids), window, whole % CHANGE_OF == 0):
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)))
                    start += length
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInPandas(cut, f"doc_id {kind}, {PIECES}")


def differenced(lengths: list[int], windows: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(sum, node) of each window by multiway differencing, ascending.

    Node i below ``len(lengths)`` is that length; ``joined`` tells what the others hold. Partial
    partitions list their windows that are not empty.
    """
    n, joined = len(lengths), []
    heap = [(-x, i, [(x, i)]) for i, x in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, at, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a) < len(b):
            a, b = b, a
        over = len(a) + len(b) - windows  # so many windows of both get a part of each
        if over <= 0:
            both = a + b
        else:
            # the smallest of a with the largest of b; the empty windows of each with the rest
            both = a[over:] + b[: len(b) - over]
            for (x, i), (y, j) in zip(a[:over], reversed(b[len(b) - over :]), strict=True):
                both.append((x + y, n + len(joined)))
                joined.append((i, j))
        if len(b) == 1:
            insort(both, both.pop())
        else:
            both.sort()
        low = both[0][0] if len(both) == windows else 0
        heapq.heappush(heap, (low - both[-1][0], at, both))
    return heap[0][2], joined


def members(node: int, n: int, joined: list[tuple[int, int]]) -> list[int]:
    out, open_ = [], [node]
    while open_:
        x = open_.pop()
        if x < n:
            out.append(x)
        else:
            open_ += joined[x - n]
    return out


def windows_of(lengths: list[int], window: int) -> list[list[int]]:
    """The lengths that share a window, by index; no window exceeds ``window``."""
    if not lengths:
        return []
    count = -(-sum(lengths) // window)
    while True:
        parts, joined = differenced(lengths, count)
        if parts[-1][0] <= window:
            return [members(node, len(lengths), joined) for _, node in parts]
        count += 1


def pack_group(group: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """The pieces of a group with their window and their place in it."""
    group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
    lengths = group["length"].tolist()
    full = sum(x == window for x in lengths)
    of = list(range(len(lengths)))
    for i, together in enumerate(windows_of(lengths[full:], window)):
        for x in together:
            of[full + x] = full + i
    group["window"] = of
    group = group.sort_values(["window", "doc_id", "start"], kind="stable")
    group["offset"] = group.groupby("window")["length"].cumsum() - group["length"]
    group["sequence_id"] = group["group"] * (1 << 32) + group["window"]
    return group


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """All pieces of ``docs``, with the sequence each lies in and its offset there."""
    cut = written(pieces(docs, path, window).withColumn("row", F.monotonically_increasing_id()), "pieces")
    groups = -(-cut.count() // GROUP) or 1
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))).drop("row")
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {PIECES}, sequence_id long, offset long"
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return dealt.groupBy("group").applyInPandas(lambda x: pack_group(x, window)[names], schema)
