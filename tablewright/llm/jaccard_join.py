"""Exact Jaccard join of documents as sets of word shingles, in the metric space of the sets.

Jaccard distance is a metric, but texts that share nothing all lie at distance 1, where pivots
tell nothing. So documents are first brought to regions in which distances mean something:

1. Equal sets become one class. Of each class the smallest shingle hashes are listed, a share of
   the set a little above what a linked set may lack. Linked sets share at least a known number of these, so a class with fewer shared
   ones has no link and leaves.
2. The size of a set is its distance from the empty pivot: linked sets lie in the same band of
   sizes or the next, so each band is joined with the boundary of the next one replicated in.
   In a band, classes that share one of their rarest shared hashes (a prefix filter, so none is
   lost) are gathered to regions by connected components.
3. A region of more than ``REGION`` shingles is split: pivots drawn from it by a hash, every member
   at its distance from each, and home in the Voronoi region of the nearest. Two linked members
   meet at the home of the one nearer to its pivot, so the other is replicated into every region
   whose pivot is at most r further than its own (triangle inequality), unless pivots connect the
   two already: it is linked to that pivot, or to its own and links of pivots lead from one to the
   other. A group of near copies is thus not copied to each of its pivots. Members at home within
   r of the pivot need to meet only members beyond r, and those that are too near the pivot for
   that (triangle inequality again) leave. Regions are split again until they are small; one that
   pivots cannot split is joined exactly in blocks.
4. Small regions are joined exactly, many to a task, and give links that span what is linked.
   Components of the links, and the classes' members, give the result.

No step gathers a hot shingle, copy group or region in one task. Sets are of 64-bit shingle
hashes, and classes are 64-bit hashes of sets.

Defined cases: null, empty and wordless texts are empty sets, linked with nothing, and their
own component; fewer words than a shingle are one shingle; equal texts link; rows that repeat
an id are documents of their own with that id; ids that are null count for no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import text_key, written
from tablewright.llm.components import components
from tablewright.llm.words import SPACE, U, encoded, mixed, runs, word_hashes
from tablewright.operators.joins import per_join_key

WORDS = 4
PERCENT = 85
#: The share of a set that is listed beyond the share that a linked set may lack.
HEAD = 0.05
#: Shingles beyond which a region is split by pivots, and shingles that one task joins.
REGION = 10_000
TASK = 400_000
PIVOTS = 16
MOST_SPLITS = 8


def sets_of(texts: list[str | None], words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Index and sorted distinct shingle hashes of each text."""
    for first, run in encoded(texts):
        hashes, ends, _ = word_hashes(run, SPACE)
        for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            w = hashes[a:b]
            yield first + i, np.unique(runs(w, min(words, len(w)))).view(np.int64) if len(w) else w.view(np.int64)


def class_of(shingles: np.ndarray) -> int:
    """A hash of a set."""
    x = shingles.view(U)
    at = np.arange(len(x), dtype=U) * U(0x9E3779B97F4A7C15)
    return int(mixed(np.array([mixed(x ^ at).sum(dtype=U) + U(len(x))]))[0].astype(np.int64))


def heads(docs: DataFrame, percent: int, words: int) -> DataFrame:
    """doc_id, text hash, class, n and head: the smallest shingle hashes."""
    share = 1 - percent / 100 + HEAD

    def head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cls, n, out = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), [None] * len(batch)
            for i, s in sets_of(batch["text"].tolist(), words):
                s = np.sort(s.view(U)).view(np.int64)
                cls[i], n[i], out[i] = class_of(s), len(s), s[: math.ceil(share * len(s) - 1e-9)]
            yield batch[["doc_id", "key"]].assign(cls=cls, n=n, head=out)

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return rows.mapInPandas(head, f"doc_id {kind}, key long, cls long, n long, head array<long>")


def least_shared(n: Column, percent: int) -> Column:
    """How many listed hashes a set of ``n`` shares with any set linked to it, at least.

    Of the two, let x have the smaller largest listed hash: all it lists and shares, the other
    lists too. That is what x lists less what it does not share; the least over all sizes that
    can be linked is at one of their ends.
    """
    t = percent / 100
    share = min(HEAD, t / (1 + t) + (HEAD - t + t / (1 + t)) / t)
    return F.greatest(F.lit(1), F.floor(F.lit(share) * n - 1e-6))


def shared_hashes(listed: DataFrame, percent: int) -> DataFrame:
    """cls, n, hash: of classes that may have links, their rarest shared hashes, enough to meet."""
    posts = listed.select("cls", "n", F.explode("head").alias("hash"))
    met = per_join_key(posts, ["hash"], F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low <> high")
    shared = written(posts.join(met.select("hash"), "hash", "left_semi").select("cls", "n", "hash").distinct(), "shared")
    enough = shared.groupBy("cls").agg(F.count("*").alias("m"), F.max("n").alias("of"))
    enough = enough.filter(F.col("m") >= least_shared(F.col("of"), percent)).select("cls")
    alive = written(shared.join(enough, "cls", "left_semi"), "shared-alive")
    counts = per_join_key(alive, ["hash"], F.count("*").alias("k")).filter("k > 1")
    by_class = W.partitionBy("cls")  # a class's own list
    ranked = alive.join(counts, "hash").withColumns(
        {"m": F.count("*").over(by_class), "rank": F.row_number().over(by_class.orderBy("k", "hash"))}
    )
    return ranked.filter(F.col("rank") <= F.col("m") - least_shared(F.col("n"), percent) + 1).select("cls", "n", "hash")


def regions(shared: DataFrame, percent: int) -> DataFrame:
    """region, cls, n: classes that may be linked share a region."""
    step = -math.log(percent / 100) * 1.0001
    band = F.floor(F.log("n") / step)
    posts = shared.select("cls", "n", "hash", F.explode(F.array(band, band - 1)).alias("band"), band.alias("home"))
    posts = posts.withColumn("node", F.xxhash64("cls", "band"))
    groups = per_join_key(
        posts, ["hash", "band"], F.min("node").alias("low"), F.count("*").alias("k"), F.min("home").alias("first")
    )
    groups = groups.filter((F.col("k") > 1) & (F.col("first") == F.col("band"))).drop("k", "first")
    met = written(posts.join(groups, ["hash", "band"]).select("node", "low", "cls", "n").distinct(), "region-links")
    found = components(met.select(F.col("node").alias("a"), F.col("low").alias("b")))
    nodes = met.select("node", "cls", "n").distinct()
    return nodes.join(found, "node").select(F.col("root").alias("region"), "cls", "n")


def class_sets(docs: DataFrame, listed: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """cls, shingles of the wanted classes, from the text of one document of each."""
    one = listed.join(wanted.select("cls").distinct(), "cls", "left_semi").groupBy("cls")
    one = one.agg(F.min(F.struct("doc_id", "key")).alias("x")).select("cls", "x.doc_id", "x.key")
    one = one.withColumnsRenamed({"doc_id": "of_id", "key": "of_key"})

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [s for _, s in sets_of(batch["text"].tolist(), words)]
            yield pd.DataFrame({"cls": batch["cls"], "shingles": found})

    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    same = rows["doc_id"].eqNullSafe(one["of_id"]) & (rows["key"] == one["of_key"])
    return rows.join(one, same).select("cls", "text").mapInPandas(sets, "cls long, shingles array<long>")


def region_links(cls: np.ndarray, sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that span the linked members of a region."""
    n = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
    _, which, df = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.argsort(which, kind="stable")
    holders, begins = owner[order], np.cumsum(df) - df
    ends = np.cumsum(n)
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i in range(len(sets) - 1):
        mine = which[ends[i] - n[i] : ends[i]]
        mine = mine[df[mine] > 1]
        size = df[mine]
        if not len(mine):
            continue
        at = np.repeat(begins[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        common = np.bincount(holders[at], minlength=len(sets))
        near = np.flatnonzero(100 * common >= percent * (n[i] + n - common))
        for j in near[near > i]:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                yield int(cls[i]), int(cls[j])


def small_links(rows: DataFrame, percent: int, task: int) -> DataFrame:
    """a, b: links within regions that fit a task; many regions go to one."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-2 * int(total) // task))

    def joined(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, x in group.groupby("region"):
            x = x.drop_duplicates("cls")
            if len(x) > 1:
                out += region_links(x["cls"].to_numpy(), x["shingles"].tolist(), percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    dealt = rows.withColumn("task", F.pmod(F.xxhash64("region"), F.lit(tasks)))
    return dealt.groupBy("task").applyInPandas(joined, "a long, b long")


def with_kin(pivots: DataFrame, percent: int) -> DataFrame:
    """``pivots`` with ``kin``: those of a region that have the same one are connected by links of its pivots."""
    other = pivots.select("region", F.col("pivot").alias("other"), F.col("pn").alias("on"), F.col("ps").alias("os"))
    common = F.size(F.array_intersect("ps", "os"))
    linked = 100 * common >= percent * (F.col("pn") + F.col("on") - common)
    pairs = written(pivots.join(other, "region").filter(linked).select("region", "pivot", "other"), "pivot-links")
    low = pairs.groupBy("region", "pivot").agg(F.min("other").alias("low")).withColumnRenamed("pivot", "other")
    kin = pairs.join(low, ["region", "other"]).groupBy("region", "pivot").agg(F.min("low").alias("kin"))
    return pivots.join(kin, ["region", "pivot"])


def split(
    rows: DataFrame, sizes: DataFrame, percent: int, turn: int, most: Column
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links with pivots, the Voronoi regions with their boundaries replicated in, and the regions left as they
    are, which would have more than ``most`` rows."""
    r = 1 - percent / 100
    draw = F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)
    # the least class is one as well, so that no region is without
    drawn = (draw < PIVOTS / F.col("members")) | (F.col("cls") == F.col("least"))
    pivots = rows.join(sizes, "region").filter(drawn)
    pivots = pivots.select("region", F.col("cls").alias("pivot"), F.col("n").alias("pn"), F.col("shingles").alias("ps"))
    pivots = written(with_kin(written(pivots, "pivots"), percent), "pivots")
    common = F.size(F.array_intersect("shingles", "ps"))
    near = written(
        rows.join(pivots, "region")
        .select("region", "cls", "pivot", "kin", (F.col("n") + F.col("pn") - common).alias("union"), common.alias("common"))
        .withColumn("d", 1 - F.col("common") / F.col("union")),
        "pivot-distances",
    )
    linked = 100 * F.col("common") >= percent * F.col("union")
    links = near.filter(linked & (F.col("cls") != F.col("pivot"))).select(F.col("cls").alias("a"), F.col("pivot").alias("b"))
    entry = F.struct("d", "pivot", "kin", linked.alias("linked"))
    home = near.groupBy("region", "cls").agg(F.min(entry).alias("home"), F.collect_list(entry).alias("near"))

    def border(d: Column, kin: Column, is_linked: Column) -> Column:
        apart = ~(F.col("home.linked") & (kin == F.col("home.kin")))
        return ~is_linked & (d <= F.col("home.d") + r + 1e-9) & apart

    # a region that would have too many rows is not replicated; its unlinked rows are counted before they are made
    unlinked = F.size(F.filter("near", lambda x: border(x.d, x.kin, x.linked) | (~x.linked & (x.pivot == F.col("home.pivot")))))
    home = written(home.select("region", "cls", "home", unlinked.alias("unlinked")), "homes")
    after = home.groupBy("region").agg(F.sum("unlinked").alias("after"))
    crowded = written(sizes.join(after, "region").filter(F.col("after") > most).select("region"), "crowded")
    kept = border(F.col("d"), F.col("kin"), linked) | (F.col("pivot") == F.col("home.pivot"))
    home = home.drop("unlinked").join(crowded, "region", "left_anti")
    inside = near.join(home, ["region", "cls"]).filter(kept)
    inside = inside.withColumns({"linked": linked, "new": F.xxhash64("region", "pivot")})
    # members linked to the pivot are at home, and need to meet only those that are not
    beyond = inside.filter(~F.col("linked")).groupBy("new").agg(F.min("d").alias("outer"))
    inside = inside.join(beyond, "new").filter(~F.col("linked") | (F.col("d") >= F.col("outer") - r - 1e-9))
    return links, inside.select("region", "cls", "new"), crowded


def in_blocks(rows: DataFrame, sizes: DataFrame, task: int) -> DataFrame:
    """Regions that pivots do not split, as pairs of parts: every two members share one.

    A region that a task can hold is one part.
    """
    parts = F.when(F.col("shingles_in") <= task, 1).otherwise(F.ceil(2 * F.col("shingles_in") / F.lit(task)))
    part = F.pmod(F.xxhash64("cls", F.lit(-1)), F.col("parts"))
    dealt = rows.join(sizes.select("region", parts.alias("parts")), "region").withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = dealt.select("*", other)
    pair = F.xxhash64("region", F.least("part", "other"), F.greatest("part", "other"))
    return dealt.select(pair.alias("region"), "cls", "n", "shingles")


def links(docs: DataFrame, listed: DataFrame, percent: int, words: int, region: int, task: int) -> DataFrame:
    """a, b: links between classes that connect all that is connected."""
    placed = written(regions(shared_hashes(listed.filter("n > 0"), percent), percent), "regions")
    sets = written(class_sets(docs, listed, placed, words), "sets")
    rows = placed.join(sets.dropDuplicates(["cls"]), "cls").select("region", "cls", "n", "shingles")
    out, names = [], ["region", "cls", "n", "shingles"]
    for turn in range(MOST_SPLITS + 1):
        sizes = placed.groupBy("region").agg(
            F.count("*").alias("members"), F.sum("n").alias("shingles_in"), F.min("cls").alias("least")
        )
        sizes = written(sizes, "region-sizes")
        large = sizes.filter(F.col("shingles_in") > region)
        small = rows.join(large, "region", "left_anti")
        out.append(written(small_links(small, percent, task), "region-links"))
        if not large.head(1):
            break
        rows = written(rows.join(large.select("region"), "region", "left_semi").select(*names), "large-regions")
        if turn == MOST_SPLITS:
            out.append(written(small_links(in_blocks(rows, large, task), percent, task), "region-links"))
            break
        # a region that hardly shrinks is joined as it is where a task can hold it, else in blocks
        most = F.when(F.col("shingles_in") <= task, 1.5).otherwise(3.0) * F.col("members")
        found, inside, crowded = split(rows, large, percent, turn, most)
        out.append(written(found, "region-links"))
        inside = written(inside, "voronoi")
        after = inside.groupBy("region").agg(F.count("*").alias("after"))
        still = large.join(after, "region").filter(F.col("after") > most).select("region")
        stuck = written(large.join(still.unionAll(crowded), "region", "left_semi"), "stuck")
        if stuck.head(1):
            blocks = in_blocks(rows.join(stuck.select("region"), "region", "left_semi"), stuck, task)
            out.append(written(small_links(blocks, percent, task), "region-links"))
        inside = inside.join(stuck.select("region"), "region", "left_anti")
        rows = written(
            inside.select("cls", "new").join(rows.drop("region").dropDuplicates(["cls"]), "cls")
            .select(F.col("new").alias("region"), "cls", "n", "shingles"),
            "split-regions",
        )
        placed = rows.select("region", "cls", "n")
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionAll(more)
    return whole


def join(
    docs: DataFrame, percent: int = PERCENT, words: int = WORDS, region: int = REGION, task: int = TASK
) -> DataFrame:
    """A row for each row of ``docs``: doc_id, key (text hash), n_shingles, component_id, root.

    ``root`` is the least class of the component, which tells components apart whatever ids they
    have; null where there are no words.
    """
    listed = written(heads(docs, percent, words), "heads")
    found = components(links(docs, listed, percent, words, region, task)).withColumnRenamed("node", "cls")
    of_class = listed.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    labelled = of_class.join(found, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    of_root = labelled.groupBy("root").agg(F.min("least").alias("component"))
    of_class = labelled.join(of_root, "root").select("cls", "component", "root")
    rows = listed.select("doc_id", "key", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    joined = rows.join(of_class, "cls", "left")
    component = F.coalesce("component", "doc_id").alias("component_id")
    return joined.select("doc_id", "key", F.col("n").alias("n_shingles"), component, "root")


def report(docs: DataFrame, **settings: int) -> DataFrame:
    return join(docs, **settings).drop("key", "root")


def deduplicated(docs: DataFrame, **settings: int) -> DataFrame:
    """``docs`` with one document of each component: of its smallest id, the first text by hash.

    Components whose documents share an id, or have none, are told apart by their root. Equal rows
    of that id count as one document; documents without words stay. All columns stay.
    """
    found = join(docs.select("doc_id", "text"), **settings).filter(
        F.col("component_id").eqNullSafe(F.col("doc_id")) | (F.col("n_shingles") == 0)
    )
    kept = found.filter("n_shingles > 0").groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("x"))
    kept = kept.select(F.col("x.doc_id").alias("kept_id"), F.col("x.key").alias("kept_key"))
    empty = found.filter("n_shingles = 0").select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key")).distinct()
    kept = kept.unionAll(empty)
    kept = kept.select(F.xxhash64("kept_id").alias("id"), F.col("kept_key").alias("key"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("doc_id").alias("id"), text_key(F.col("text")).alias("key"))
    return rows.join(kept, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]).select("row.*")
