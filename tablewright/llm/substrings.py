"""Removal of repeated passages: every byte covered by a long string that occurs twice.

The method is prefix doubling of a suffix array, made sparse. Names (fingerprints of pairs of
names) stand for ranks, so a round needs no global sort, only a grouping by name; positions
whose name is unique leave after each round, until the threshold is met. That is a ``Measure``:
``BYTES`` has windows of 400 bytes, ``WORDS`` of 51 words (A-Z lowered, whatever white space is
between); ``removed`` takes one or more and cuts what any of them finds. Units are bytes or words.

Round 1, in the tasks: names of 1, 2, 4, ... up to ``key`` and ``length`` units at every position, by
pairs at growing offsets. Every window of ``length`` units has one anchor: the least name of ``key``
units in it, the first if several are. Equal windows have equal anchors at equal offsets, so
only anchors are compared: one row for the run of windows that share an anchor, with the key
name and the name of the whole stretch of the run. Rows whose key name is unique cannot lie in
a repeat; rows of equal stretches are repeats as a whole.
Round 2: other runs, one for each different stretch, are cut by offset into cells of ``cell``
windows. A cell is named by the units that all its windows share, and by its whole stretch; cells
leave by the first if unique, and are settled by the second if equal.
Round 3: what is left are cells at the ends of repeats; their windows are named one by one.

Names are compared within equal key names, so 128 bits decide; the strings themselves are not
compared again. Every grouping combines before its shuffle and is dealt anew for the join that uses
it, which AQE can split then, so hot passages and copies never gather in one task; text is shuffled
by document only, and matches are intervals, never pairs. Each table of a round is deleted when the
next one is written, and a measure leaves only its intervals.

Defined cases: null and empty texts have no bytes; texts shorter than a window lose nothing;
rows with equal id and text are two documents with equal texts; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.bytenames import AT_ONCE, doubled, names, paired, sliding_min
from tablewright.llm.common import text_key, written
from tablewright.llm.words import AT_ONCE as BYTES_AT_ONCE
from tablewright.llm.words import SPACE, U, word_hashes
from tablewright.operators.joins import distinct_keys, per_join_key


def bytes_of(rows: list[bytes]) -> Iterator[np.ndarray]:
    for data in rows:
        yield np.frombuffer(data, np.uint8)


def words_of(rows: list[bytes]) -> Iterator[np.ndarray]:
    """The hashes of each text's words."""
    run, size = [], 0
    for i, data in enumerate(rows):
        run.append(data)
        size += len(data)
        if size >= BYTES_AT_ONCE or i == len(rows) - 1:
            hashes, ends, _ = word_hashes(run, SPACE)
            yield from np.split(hashes, ends[:-1])
            run, size = [], 0


def byte_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(len(data) + 1)
    return at[:-1], at[1:]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends, in bytes."""
    gap = np.concatenate(([True], SPACE[np.frombuffer(data, np.uint8)], [True]))
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


@dataclass(frozen=True)
class Measure:
    """Windows of ``length`` units, and into what units a text falls."""

    length: int
    key: int
    cell: int
    core: int  # two of these cover what the windows of a cell share
    least: int  # bytes of the shortest window
    units: Callable[[list[bytes]], Iterator[np.ndarray]]
    bounds: Callable[[bytes], tuple[np.ndarray, np.ndarray]]

    @property
    def span(self) -> int:
        """Positions of a key in a window."""
        return self.length - self.key + 1


BYTES = Measure(400, 100, 16, 256, 400, bytes_of, byte_bounds)
#: More than 50 words; a word and a space are two bytes at least.
WORDS = Measure(51, 12, 4, 32, 101, words_of, word_bounds)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with k1, k2: equal only for equal ids and texts."""
    return docs.withColumns({"k1": F.xxhash64("doc_id"), "k2": text_key(F.col("text"))})


def segments(rows: list[bytes], m: Measure) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of about AT_ONCE units: the units, and of each piece its row, offset and end in the run.

    A long text is cut; pieces overlap so that each window lies in exactly one.
    """
    run, size = [], 0
    for i, data in enumerate(m.units(rows)):
        for base in range(0, max(len(data) - m.length + 1, 0), AT_ONCE):
            piece = data[base : base + AT_ONCE + m.length - 1]
            run.append((i, base, piece))
            size += len(piece)
            if size >= AT_ONCE:
                yield _joined(run)
                run, size = [], 0
    if run:
        yield _joined(run)


def _joined(run: list[tuple[int, int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.concatenate([x for _, _, x in run])
    ends = np.cumsum([len(x) for _, _, x in run])
    return data, np.array([i for i, _, _ in run]), np.array([b for _, b, _ in run]), ends


def find_anchors(batches: Iterator[pd.DataFrame], m: Measure) -> Iterator[pd.DataFrame]:
    low = U((1 << 20) - 1)  # a run has fewer positions than this
    for batch in batches:
        k1, k2 = batch["k1"].to_numpy(), batch["k2"].to_numpy()
        for data, row, base, ends in segments(batch["data"].tolist(), m):
            key = names(data, m.key)
            long = doubled(doubled(key, m.key), 2 * m.key) if m.length == 4 * m.key else names(data, m.length)
            least = sliding_min((key & ~low) | np.arange(len(key), dtype=U), m.span) & low
            piece = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[: len(least)]
            s = np.flatnonzero(np.arange(len(least)) + m.length <= ends[piece])
            new = np.flatnonzero(np.concatenate(([True], (least[s[1:]] != least[s[:-1]]) | (s[1:] != s[:-1] + 1))))
            first, last = s[new], s[np.append(new[1:] - 1, len(s) - 1)]
            at = least[first].astype(np.int64)
            n, before, of = last - first + 1, at - first, piece[first]
            begins = np.concatenate(([0], ends))[of]
            whole = paired(paired(long[first], long[last]), (n + 1024 * before).astype(U))
            yield pd.DataFrame(
                {
                    "k1": k1[row[of]], "k2": k2[row[of]], "start": first - begins + base[of], "n": n, "before": before,
                    "key": key[at].view(np.int64), "whole": whole.view(np.int64),
                }
            )


ANCHORS = "k1 long, k2 long, start long, n int, before int, key long, whole long"


def in_documents(docs: DataFrame, items: DataFrame, name, schema: str, columns: list[str]) -> DataFrame:
    """``name`` applied to the texts that ``items`` lie in, with the items' columns as arrays."""
    wanted = per_join_key(items, ["k1", "k2"], *(F.collect_list(c).alias(c) for c in columns))
    texts = docs.select("k1", "k2", F.col("text").cast("binary").alias("data"))
    return wanted.join(texts, ["k1", "k2"]).mapInPandas(name, schema)


def stretches(
    batch: pd.DataFrame, columns: list[str], m: Measure
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Runs of items with the joined units of their windows and where each begins there."""
    sizes = batch["start"].map(len).to_numpy()
    flat = {c: np.concatenate(batch[c].tolist()) for c in columns}
    flat |= {c: np.repeat(batch[c].to_numpy(), sizes) for c in ("k1", "k2")}
    row = np.repeat(np.arange(len(batch)), sizes)
    data, step = list(m.units(batch["data"].tolist())), max(1, AT_ONCE // (m.length + m.span))
    for i in range(0, len(row), step):
        part = {c: v[i : i + step] for c, v in flat.items()}
        cut = [data[r][s : s + n + m.length - 1] for r, s, n in zip(row[i : i + step], part["start"], part["n"], strict=True)]
        ends = np.cumsum([len(x) for x in cut])
        yield part, np.concatenate(cut), ends - np.array([len(x) for x in cut])


def find_cells(batches: Iterator[pd.DataFrame], m: Measure) -> Iterator[pd.DataFrame]:
    columns = ["start", "n", "before", "key", "whole", "many"]
    for batch in batches:
        for x, data, begins in stretches(batch, columns, m):
            core, long = names(data, m.core), names(data, m.length)
            # offsets of the anchor in its windows run from before - n + 1 to before
            first, last = (x["before"] - x["n"] + 1) // m.cell, x["before"] // m.cell
            of = np.repeat(np.arange(len(first)), last - first + 1)
            cell = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last, strict=True)])
            top = np.minimum(cell * m.cell + m.cell - 1, x["before"][of])
            least = np.maximum(cell * m.cell, (x["before"] - x["n"] + 1)[of])
            start = begins[of] + x["before"][of] - top  # of the first window of the cell
            n = top - least + 1
            shared = begins[of] + x["before"][of] - cell * m.cell  # where the last window of a full cell starts
            part = paired(core[shared], core[shared + m.length - m.cell + 1 - m.core])
            full = n == m.cell
            end = np.where(full, start + m.cell - 1, start)
            all_of_it = paired(long[start], long[end]).view(np.int64)
            yield pd.DataFrame(
                {
                    "k1": x["k1"][of], "k2": x["k2"][of], "start": x["start"][of] + x["before"][of] - top, "n": n,
                    "key": x["key"][of], "cell": cell, "core": part.view(np.int64),
                    "all": pd.array(np.where(full, all_of_it, 0), "Int64"), "full": full,
                    "run": x["whole"][of], "many": x["many"][of],
                }
            )


CELLS = "k1 long, k2 long, start long, n int, key long, cell int, core long, all long, full boolean, run long, many boolean"


def find_windows(batches: Iterator[pd.DataFrame], m: Measure) -> Iterator[pd.DataFrame]:
    columns = ["start", "n", "key", "cell", "run", "many"]
    for batch in batches:
        for x, data, begins in stretches(batch, columns, m):
            long = names(data, m.length)
            of = np.repeat(np.arange(len(begins)), x["n"])
            i = np.arange(len(of)) - np.repeat(np.cumsum(x["n"]) - x["n"], x["n"])
            out = {c: x[c][of] for c in ("k1", "k2", "key", "cell", "run", "many")}
            yield pd.DataFrame(out | {"start": x["start"][of] + i, "name": long[begins[of] + i].view(np.int64)})


WINDOWS = "k1 long, k2 long, key long, cell int, run long, many boolean, start long, name long"


def several(rows: DataFrame, by: list[str]) -> DataFrame:
    """The groups of ``by`` in which two runs meet, or one that has copies; and the least run."""
    met = per_join_key(rows, by, F.min("run").alias("one"), F.max("run").alias("other"), F.max("many").alias("copied"))
    return met.filter((F.col("one") != F.col("other")) | F.col("copied")).select(*by, "one")


def repeated(docs: DataFrame, m: Measure = BYTES) -> DataFrame:
    """k1, k2, start, n: runs of n windows (from the unit ``start`` on) that occur again; written."""
    docs = keyed(docs)
    texts = docs.select("k1", "k2", F.col("text").cast("binary").alias("data")).filter(F.octet_length("text") >= m.least)
    anchors = written(texts.mapInPandas(lambda x: find_anchors(x, m), ANCHORS), "anchors")
    runs = anchors.groupBy("key", "whole").agg(
        F.count("*").alias("copies"), F.min(F.struct("k1", "k2", "start", "n", "before")).alias("x")
    )
    runs = written(runs, "runs")
    copied = anchors.join(runs.filter("copies > 1").select("key", "whole"), ["key", "whole"], "left_semi")
    copied = written(copied.select("k1", "k2", "start", "n"), "copied", instead_of=[anchors])
    met = per_join_key(runs, ["key"], F.count("*").alias("runs")).filter("runs > 1").select("key")
    open_ = runs.join(met, "key", "left_semi").select("x.*", "key", "whole", (F.col("copies") > 1).alias("many"))
    cells = in_documents(docs, open_, lambda x: find_cells(x, m), CELLS, ["start", "n", "before", "key", "whole", "many"])
    cells = written(cells, "cells", instead_of=[runs])
    # cells whose shared bytes meet another run, and of these the ones that are equal as a whole
    by_core = several(cells.withColumn("many", F.lit(False)), ["key", "cell", "core"]).drop("one")
    alive = written(cells.join(by_core, ["key", "cell", "core"], "left_semi"), "cells-alive", instead_of=[cells])
    by_all = several(alive.filter("full"), ["key", "cell", "all"]).withColumnRenamed("all", "as_all")
    by_all = by_all.select(F.col("key").alias("as_key"), F.col("cell").alias("as_cell"), "as_all", "one")
    same = F.col("full") & (F.col("key") == F.col("as_key")) & (F.col("cell") == F.col("as_cell")) & (F.col("all") == F.col("as_all"))
    told = alive.join(by_all, same, "left").withColumn("met", F.col("one").isNotNull())
    told = written(told.drop("as_key", "as_cell", "as_all"), "cells-told", instead_of=[alive])
    settled = told.filter(F.col("met") & ~F.col("many"))
    left = told.filter(~F.col("met") | (F.col("run") == F.col("one"))).withColumn("many", F.col("many") | F.col("met"))
    # only where a cell that is not settled may meet others
    unsettled = distinct_keys(left.filter(~F.col("many")), ["key", "cell", "core"])
    left = left.join(unsettled, ["key", "cell", "core"], "left_semi")
    windows = in_documents(docs, left, lambda x: find_windows(x, m), WINDOWS, ["start", "n", "key", "cell", "run", "many"])
    windows = written(windows, "windows")
    again = several(windows, ["key", "cell", "name"]).drop("one")
    ends = windows.filter(~F.col("many")).join(again, ["key", "cell", "name"], "left_semi").withColumn("n", F.lit(1))
    out = [x.select("k1", "k2", "start", F.col("n").cast("int").alias("n")) for x in (copied, settled, ends)]
    return written(out[0].unionAll(out[1]).unionAll(out[2]), "repeats", instead_of=[copied, told, windows])


def merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of bytes that the pieces cover."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], ends[order]
    reach = np.maximum.accumulate(ends)
    new = np.flatnonzero(np.concatenate(([True], begins[1:] > reach[:-1])))
    return begins[new], reach[np.append(new[1:] - 1, len(reach) - 1)]


def pieces(data: bytes, which: np.ndarray, first: np.ndarray, n: np.ndarray, measures: tuple[Measure, ...]) -> tuple:
    """Begin and end, in bytes, of the runs of windows of the measures."""
    begins, ends = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
    for k in np.unique(which):
        mine, (begin, end) = which == k, measures[k].bounds(data)
        begins[mine] = begin[first[mine]]
        ends[mine] = end[first[mine] + n[mine] + measures[k].length - 2]
    return begins, ends


def cut_one(
    x: bytes, which: np.ndarray, starts: np.ndarray, counts: np.ndarray, measures: tuple[Measure, ...]
) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and the runs removed."""
    if not len(which):
        return x, 0, 0
    begins, ends = merged(*pieces(x, which, starts, counts, measures))
    left = b"".join(x[a:b] for a, b in zip([0, *ends], [*begins, len(x)], strict=True))
    return left, len(x) - len(left), len(begins)


def cut(
    data: pd.Series, which: pd.Series, starts: pd.Series, counts: pd.Series, measures: tuple[Measure, ...]
) -> Iterator[tuple[bytes, int, int]]:
    """``cut_one`` for each text; a null list has nothing to cut."""
    for x, k, s, n in zip(data, which, starts, counts, strict=True):
        yield cut_one(x or b"", np.asarray(k), np.asarray(s), np.asarray(n), measures) if k is not None else (x or b"", 0, 0)


def with_spans(docs: DataFrame, measures: tuple[Measure, ...]) -> tuple[DataFrame, list[Column]]:
    """row (all columns of ``docs``), text and its repeated windows; and the arguments of ``cut``."""
    found = [repeated(docs, m).withColumn("which", F.lit(k)) for k, m in enumerate(measures)]
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionAll(more)
    # a set: each copy of a row has found the same
    spans = per_join_key(spans, ["k1", "k2"], F.collect_set(F.struct("which", "start", "n")).alias("spans"))
    spans = spans.select(F.col("k1").alias("s1"), F.col("k2").alias("s2"), "spans")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")
    rows = keyed(rows).drop("doc_id", "text")
    joined = rows.join(spans, (F.col("k1") == F.col("s1")) & (F.col("k2") == F.col("s2")), "left")
    return joined, [F.col("row.text").cast("binary"), *(F.col(f"spans.{c}") for c in ("which", "start", "n"))]


SUMMARY = "n_removed long, n_spans long, kept_sha256 string, n_word_spans long"


def report(docs: DataFrame, measures: tuple[Measure, ...] = (BYTES, WORDS)) -> DataFrame:
    """A row for each row of ``docs``: bytes, bytes and runs removed, digest of what is left.

    These go by the first measure, windows of 400 bytes. ``n_word_spans`` are the maximal runs of units
    that the windows of the last one cover, 51 words, which may be shorter than 400 bytes;
    ``repeats`` tells whether there is either.
    """
    other = len(measures) - 1

    def summary(data: pd.Series, which: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.DataFrame:
        rows = []
        for x, k, s, n in zip(data, which, starts, counts, strict=True):
            k, s, n = (np.array([] if v is None else v, np.int64) for v in (k, s, n))
            left, lost, spans = cut_one(x or b"", *(v[k == 0] for v in (k, s, n)), measures)
            first, many = s[k == other], n[k == other]
            word_spans = len(merged(first, first + many + measures[other].length - 1)[0]) if len(first) else 0
            rows.append((lost, spans, hashlib.sha256(left).hexdigest(), word_spans))
        return pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "n_word_spans"])

    joined, arguments = with_spans(docs.select("doc_id", "text"), measures)
    found = joined.withColumn("x", F.pandas_udf(summary, SUMMARY)(*arguments))
    n_bytes = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long").alias("n_bytes")
    repeats = ((F.col("x.n_spans") > 0) | (F.col("x.n_word_spans") > 0)).alias("repeats")
    return found.select("row.doc_id", n_bytes, "x.n_removed", "x.n_spans", "x.kept_sha256", "x.n_word_spans", repeats)


def removed(docs: DataFrame, measures: tuple[Measure, ...] = (BYTES,)) -> DataFrame:
    """``docs`` without the repeated passages; ``n_chars`` follows the text, all columns stay."""

    def remainder(data: pd.Series, which: pd.Series, starts: pd.Series, counts: pd.Series) -> pd.Series:
        """The text left; bytes of a character that was cut through go with it."""
        return pd.Series([x.decode(errors="ignore") for x, _, _ in cut(data, which, starts, counts, measures)])

    joined, arguments = with_spans(docs, measures)
    cut_text = F.pandas_udf(remainder, "string")(*arguments)
    left = joined.withColumn("left", F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut_text))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return left.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
