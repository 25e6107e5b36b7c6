"""Spelling variants: the words of a corpus, the words one edit away, and the form each leads to.

Two words one edit apart share all code points before the edit and all after it, so they share
the first or the last half of the shorter one's length. Words meet in groups by length and half;
a group that is too large is split by half of what it has not in common, until one code
point is left, where the alphabet bounds it. So no group gathers more than ``GROUP`` words, nothing
is capped, and each pair is decided in exactly one group: halves are chosen by where the words
first differ.

Groups are dealt to tasks by a hash. A task sorts its words and searches all of them at once: a
state is a word, a range of the sorted list that shares a prefix, and the three cells of
the edit matrix's row within one of the diagonal. The adjacent longest common prefixes cut a range into
the ranges of the next code point; they share the row reached so far, and a range leaves when no cell
of its row is at most one, which skips all words that begin with it.

Forms are followed by pointer jumping: a form is at least ten times as frequent, so chains end.

Defined cases: a null text has no words; in the hash a null id is empty; equal rows count
as often as they occur; words and texts may be of any length; without a word that is frequent enough
the result is empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import lower_ascii, ship, written

#: The letters of a run, what a word must have, and how much more frequent a form is.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_CHARS = 7
LEAST_COUNT = 2
FACTOR = 10
#: One run in so many, by hash, loses a code point.
SLIP = 31
#: Words in a group; with one free code point a group has at most 90 + 90 * 90.
GROUP = 16384
#: Rows in a task, about, and words that it searches at once.
TASK = 20000
AT_ONCE = 2048

KEYS = ["size", "head", "tail", "hash"]


def vocabulary(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of all texts, counted."""
    # shorter runs give no word; counts are combined before the shuffle, so no word is hot
    found = F.regexp_extract_all(F.col("text"), F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    hashed = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _keyed(rows: DataFrame) -> DataFrame:
    """``hash`` from what the words of the group have in common; words that differ may share it by chance."""
    text, tail = F.col("word"), F.col("tail")
    ends = F.when(tail == 0, F.lit("")).otherwise(F.substring(text, F.length(text) - tail + 1, tail))
    return rows.withColumn("hash", F.xxhash64(F.substring(text, F.lit(1), F.col("head")), ends))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row twice: with the first half, and the last half, of the free code points added to what is shared."""
    free = F.col("size") - F.col("head") - F.col("tail")
    half = F.floor(free / 2).cast("int")
    first = F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail"))
    last = F.struct(F.col("head").alias("head"), (F.col("tail") + free - half).alias("tail"))
    both = rows.withColumn("half", F.explode(F.array(first, last)))
    return _keyed(both.select("word", "n", "size", "half.head", "half.tail"))


def grouped(words: DataFrame, least_chars: int = LEAST_CHARS, limit: int = GROUP) -> DataFrame:
    """word, n and the keys of the groups, each of at most ``limit`` words unless one code point is free."""
    size = F.length("word")
    # a pair is of the size of its shorter word, so a word looks for its own size and one less
    sizes = F.filter(F.array(size, size - 1), lambda x: x >= least_chars)
    rows = words.select("word", "n", F.explode(sizes).alias("size"), F.lit(0).alias("head"), F.lit(0).alias("tail"))
    rows = written(_halves(rows), "spelling-groups")
    done = []
    while True:
        large = rows.filter(F.col("size") - F.col("head") - F.col("tail") > 1).groupBy(*KEYS).agg(F.count("*").alias("many"))
        large = written(large.filter(F.col("many") > limit).select(*KEYS), "spelling-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, KEYS, "left_anti"))
        rows = written(_halves(rows.join(large, KEYS, "left_semi")), "spelling-groups")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def common_prefixes(chars: np.ndarray, start: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many code points the words ``a`` and ``b`` have in common from the first on."""
    out = np.zeros(len(a), np.int64)
    open_, depth = np.arange(len(a)), 0
    while len(open_):
        open_ = open_[(size[a[open_]] > depth) & (size[b[open_]] > depth)]
        open_ = open_[chars[start[a[open_]] + depth] == chars[start[b[open_]] + depth]]
        depth += 1
        out[open_] = depth
    return out


def flat(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all words, and where each word begins and how many it has."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    chars = np.frombuffer("".join(words).encode("utf-32-le") + b"\0\0\0\0", "<u4")
    return chars, np.cumsum(size) - size, size


def near_pairs(words: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (a, b), both ways, of all words of one group that are one edit apart.

    ``words`` ascend within a group and groups ascend.
    """
    chars, start, size = flat(words)
    m = len(words)
    lcp = np.full(m, -1)  # with the word before; -1 where a group begins
    same = np.flatnonzero(group[1:] == group[:-1]) + 1
    lcp[same] = common_prefixes(chars, start, size, same - 1, same)
    firsts = np.flatnonzero(lcp == -1)
    ends = np.append(firsts[1:], m)
    of = np.searchsorted(firsts, np.arange(m), "right") - 1
    # the places where the list branches, by the depth at which it does
    order = np.argsort(lcp, kind="stable")
    depth_of = np.searchsorted(lcp[order], np.arange(int(lcp.max(initial=0)) + 2))
    out_a, out_b = [], []

    def cell(cost: np.ndarray, q: np.ndarray, column: np.ndarray, c: np.ndarray) -> np.ndarray:
        """``cost`` and one more where the word's code point at ``column`` is another; 2 beyond its end."""
        inside = (column >= 0) & (column < size[q])
        other = chars[np.where(inside, start[q] + column, 0)] != c
        return np.where(inside, np.minimum(cost + other, 2), 2).astype(np.int8)

    for chunk in range(0, m, AT_ONCE):
        q = np.arange(chunk, min(chunk + AT_ONCE, m))
        lo, hi = firsts[of[q]], ends[of[q]]
        row = [np.full(len(q), x, np.int8) for x in (2, 0, 1)]  # one before the diagonal, on it, one behind
        depth = 0
        while len(q):
            # a word that is the shared prefix itself comes first in its range
            whole = size[lo] == depth
            off = size[q] - depth
            cost = np.select([off == -1, off == 0, off == 1], row, 2)
            hit = whole & (cost == 1)
            out_a.append(q[hit])
            out_b.append(lo[hit])
            lo = lo + whole
            alive = lo < hi
            q, lo, hi, row = q[alive], lo[alive], hi[alive], [x[alive] for x in row]
            # the ranges of the next code point begin where the prefixes in common end here
            cuts = order[depth_of[depth] : depth_of[depth + 1]] if depth + 1 < len(depth_of) else order[:0]
            left, right = np.searchsorted(cuts, lo, "right"), np.searchsorted(cuts, hi, "left")
            n = right - left + 1
            parent = np.repeat(np.arange(len(q)), n)
            nth = np.arange(len(parent)) - np.repeat(np.cumsum(n) - n, n)
            begin = np.where(nth == 0, lo[parent], cuts[np.minimum(left[parent] + nth - 1, len(cuts) - 1)] if len(cuts) else 0)
            last = nth == n[parent] - 1
            end = np.where(last, hi[parent], cuts[np.minimum(left[parent] + nth, len(cuts) - 1)] if len(cuts) else 0)
            q, old = q[parent], [x[parent] for x in row]
            c = chars[start[begin] + depth]
            column = np.full(len(q), depth)
            before = np.minimum(cell(old[0], q, column - 1, c), old[1] + 1)
            on = np.minimum(np.minimum(cell(old[1], q, column, c), old[2] + 1), before + 1)
            behind = np.minimum(cell(old[2], q, column + 1, c), on + 1)
            # beyond the word's end there is no cell
            on[column + 1 > size[q]] = 2
            behind[column + 2 > size[q]] = 2
            keep = np.minimum(np.minimum(before, on), behind) <= 1
            q, lo, hi = q[keep], begin[keep], end[keep]
            row = [np.minimum(x[keep], 2).astype(np.int8) for x in (before, on, behind)]
            depth += 1
    return np.concatenate(out_a or [q]), np.concatenate(out_b or [q])


def near_in_task(rows: pd.DataFrame) -> pd.DataFrame:
    """For each word of the task's groups: how many near words it has there, and the best of them."""
    rows = rows.reset_index(drop=True)
    parts = []
    # where the ends are what is shared, words are compared from behind
    for backward in (False, True):
        part = rows[(rows["tail"] > rows["head"]) == backward]
        if len(part) > 1:
            part = part.assign(by=[x[::-1] for x in part["word"]] if backward else part["word"])
            part = part.assign(group=part.groupby(KEYS, sort=True).ngroup()).sort_values(["group", "by"])
            a, b = near_pairs(part["by"].tolist(), part["group"].to_numpy())
            words, n = part["word"].tolist(), part["n"].to_numpy()
            size, head, tail = (part[c].to_numpy() for c in KEYS[:3])
            chars, start, length = flat(words)
            apart = common_prefixes(chars, start, length, a, b)
            # of the groups in which both meet, the one whose free part holds the first difference
            here = (np.minimum(length[a], length[b]) == size[a]) & (apart >= head[a])
            here &= (apart < (size - tail)[a]) | (tail[a] == 0)
            a, b = a[here], b[here]
            near = pd.Series([words[i] for i in b], dtype=object)
            parts.append(pd.DataFrame({"word": pd.Series([words[i] for i in a], dtype=object), "near": near, "near_n": n[b]}))
    pairs = pd.concat(parts) if parts else pd.DataFrame({"word": [], "near": [], "near_n": []})
    pairs = pairs.sort_values(["word", "near_n", "near"], ascending=[True, False, True])
    best = pairs.drop_duplicates("word").set_index("word")
    out = pairs.groupby("word").size().rename("n_near").to_frame().join(best)
    return out.reset_index()[["word", "n_near", "near", "near_n"]].astype({"word": object, "near": object})


def near_words(words: DataFrame, least_chars: int = LEAST_CHARS, limit: int = GROUP, task: int = TASK) -> DataFrame:
    """word, n_near, near, near_n: of every word with a near one, how many, and the most frequent (the least of equals)."""
    groups = written(grouped(words, least_chars, limit), "spelling-grouped")
    tasks = groups.count() // task + 1
    dealt = groups.withColumn("task", F.pmod(F.xxhash64(*KEYS), F.lit(tasks)))
    schema = "word string, n_near long, near string, near_n long"
    found = dealt.groupBy("task").applyInPandas(near_in_task, schema)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the chains of (word, form) end; every round doubles the steps."""
    steps = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = written(steps.join(further, "root", "left").select("word", "root", "next"), "spelling-roots")
        steps = jumped.select("word", F.coalesce("next", "root").alias("root"))
        if jumped.filter(F.col("next").isNotNull()).isEmpty():
            return steps


def variants(words: DataFrame, least_chars: int = LEAST_CHARS, limit: int = GROUP, task: int = TASK, factor: int = FACTOR) -> DataFrame:
    """word, n, n_near, form, form_n, root for a counted vocabulary (word, n)."""
    ship(words.sparkSession)
    near = near_words(words, least_chars, limit, task)
    met = written(words.join(near, "word", "left"), "spelling-near")
    is_form = F.col("near_n") >= factor * F.col("n")
    told = met.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n"),
    )
    ends = roots(told.filter(F.col("form").isNotNull()))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def report(docs: DataFrame) -> DataFrame:
    """The spelling variants of ``docs``: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs), "spelling-words")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")

