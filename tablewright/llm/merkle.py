"""A Merkle manifest of a table: a tree for each source, and one above their roots.

Every node is labelled by the interval of leaf ranks [lo, hi) that it covers. Leaves are ranked by
a range partitioning with sorted partitions; a source's rows in a partition are counted, so no
source is gathered. Levels fall into buckets of ``LEVELS``: a block is the up to ``FAN ** LEVELS``
nodes that lie in one interval of the next bucket, and is worked out in one row of bounded size.
Upwards, each block gives its top node. Downwards, blocks join the ancestor whose interval contains
theirs and inherit the siblings found above it, once for a block; within the block, a node's
siblings are what is left of its parent's interval without its own. So a document never
becomes a row for each level, and a tree of n leaves takes log(n) / log(729) joins each way.

Defined cases: nulls have the contract's `-`; a null source comes first; rows of one source
and id are ordered by leaf, null ids first, so equal rows are leaves of their own; texts of any length
are hashed whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablewright.llm.common import ship, written

#: Children of a node, and the fields of a leaf.
FAN = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels in a bucket; a block has up to 729 nodes.
LEVELS = 6
BLOCK = FAN**LEVELS
#: The siblings on the way up: the digests left of the node and those right of it, level by level.
PATH = "array<string>"


def field(value: Column) -> Column:
    as_text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(as_text).cast("string"), F.lit(":"), as_text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    return F.sha2(F.concat(*(field(text if c == "text" else F.col(c)) for c in FIELDS)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """has, src (no null, in the order of sources), doc_id, leaf and the leaf after tampering."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    cut = F.when(touched, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return docs.select(
        F.col("source").isNotNull().cast("int").alias("has"), F.coalesce("source", F.lit("")).alias("src"), "doc_id",
        leaf_digest(F.col("text")).alias("leaf"), leaf_digest(cut).alias("tampered"),
    )


def labelled(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with lo and hi (the rank within ``by``, from 0, and the next one) and n (the rows of ``by``)."""
    ordered = [*by, *(F.col(c).asc_nulls_first() for c in order)]
    # the sort decides the place of every row but equal ones, so a re-run task numbers them alike
    placed = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy(*by, "part").agg(F.min("place").alias("first"), F.count("*").alias("here"))
    # a row for each source and partition that meet: a window holds as many as there are partitions
    group = W.partitionBy(*by)
    before = F.sum("here").over(group.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    runs = runs.select(
        *by, "part", (F.col("first") - F.coalesce(before, F.lit(0))).alias("start"), F.sum("here").over(group).alias("n")
    )
    met = placed.join(written(runs, name + "-runs"), [*by, "part"])
    lo = F.col("place") - F.col("start")
    return met.select(*rows.columns, lo.alias("lo"), (lo + 1).alias("hi"), "n")


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(digests: list[str], nodes: int) -> list[list[str]]:
    """The nodes of a block on each of its levels, in a tree that has ``nodes`` on the lowest."""
    out = [digests]
    while nodes > 1 and len(out) <= LEVELS:
        out.append([joined(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
        nodes = -(-nodes // FAN)
    return out


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """For each level of the block, what the parent's interval holds left and right of the node's own."""
    out, width = [], 1  # intervals in nodes of the lowest level
    for nodes in levels[:-1]:
        lo, parent = at - at % width, at - at % (FAN * width)
        left, right = (parent, lo), (lo + width, parent + FAN * width)
        out += ["".join(nodes[a // width : b // width]) for a, b in (left, right)]
        width *= FAN
    return out


def climbed(nodes: DataFrame, by: list[str], name: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each bucket of levels from below, and the root of each tree as ``top``.

    ``nodes`` has ``by``, lo, hi, digest, what it carries, and n, the leaves of the tree.
    """
    kinds = dict(nodes.dtypes)
    group = "".join(f"{c} {kinds[c]}, " for c in by)
    rounds, width = [], 1  # leaves under a node of the bucket
    while True:

        def tops(batches: Iterator[pd.DataFrame], width: int = width) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = batch[[*by, "lo", "hi", "n"]].copy()
                pairs = zip(batch["members"], batch["n"], strict=True)
                out["digest"] = [levels_of([x["digest"] for x in members], -(-n // width))[-1][0] for members, n in pairs]
                yield out

        block = F.expr(f"lo DIV {width * BLOCK}").alias("block")
        members = F.array_sort(F.collect_list(F.struct("lo", *(c for c in nodes.columns if c not in (*by, "lo", "n")))))
        interval = [F.min("lo").alias("lo"), F.max("hi").alias("hi")]
        blocks = nodes.groupBy(*by, block).agg(members.alias("members"), *interval, F.max("n").alias("n"))
        rounds.append(written(blocks, f"{name}-{len(rounds)}"))
        nodes = rounds[-1].mapInPandas(tops, f"{group}lo long, hi long, n long, digest string")
        width *= BLOCK
        if (rounds[-1].agg(F.max("n")).first()[0] or 0) <= width:
            return rounds, written(nodes.select(*by, F.col("digest").alias("top")), f"{name}-tops")


def descended(rounds: list[DataFrame], above: DataFrame, by: list[str], carried: dict[str, str]) -> DataFrame:
    """The nodes of the lowest bucket with ``path``, their siblings up to the root, and what ``above`` has.

    ``above`` has ``by``, path and more for each tree; ``carried`` are columns of the lowest nodes.
    """
    more = [c for c in above.columns if c not in (*by, "path")]
    kinds = dict(above.dtypes)
    # a root covers whatever there is
    ancestors = above.withColumns({"up_lo": F.lit(0).cast("long"), "up_hi": F.lit(1 << 62)})
    for k in reversed(range(len(rounds))):
        kept, width = carried if k == 0 else {}, BLOCK**k
        schema = [f"{c} {kinds[c]}" for c in (*by, *more)] + ["up_lo long", "up_hi long", f"path {PATH}"]
        schema += [f"{c} {t}" for c, t in kept.items()]

        def paths(batches: Iterator[pd.DataFrame], kept: dict[str, str] = kept, width: int = width) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.to_dict("records"):
                    members = row["members"]
                    levels = levels_of([x["digest"] for x in members], -(-row["n"] // width))
                    rest = list(row["path"])
                    out = {c: [row[c]] * len(members) for c in (*by, *more)}
                    out |= {"up_lo": [x["lo"] for x in members], "up_hi": [x["hi"] for x in members]}
                    out["path"] = [siblings(levels, i) + rest for i in range(len(members))]
                    for c, t in kept.items():
                        out[c] = pd.array([x[c] for x in members], "Int64" if t == "bigint" else object)
                    yield pd.DataFrame(out)

        # blocks and ancestors of a bucket are as wide as each other, so an equal number finds the container
        bucket = F.expr(f"up_lo DIV {width * BLOCK}").alias("block")
        met = rounds[k].join(ancestors.select("*", bucket), [*by, "block"])
        met = met.filter((F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi")))
        ancestors = met.mapInPandas(paths, ", ".join(schema))
    return ancestors


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = joined([left, leaf, right])
    return leaf


def manifest(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: source, rank in it, doc_id, leaf, leaf after tampering, roots and path.

    ``path`` are the siblings from the leaf up, on either side; folding a leaf with it must give the root.
    """
    ship(docs.sparkSession)
    by = ["has", "src"]
    rows = written(leaves(docs), "merkle-leaves")
    ranked = labelled(rows, by, ["doc_id", "leaf"], "merkle-ranked").withColumnRenamed("leaf", "digest")
    rounds, subroots = climbed(ranked, by, "merkle")
    sources = labelled(subroots, [], by, "merkle-sources").withColumnRenamed("top", "digest")
    source_rounds, root = climbed(sources, [], "merkle-above")
    start = root.select(F.array().cast(PATH).alias("path"), F.col("top").alias("root"))
    of_source = descended(source_rounds, start, [], {"has": "int", "src": "string", "digest": "string"})
    of_source = written(of_source.select(*by, "path", "root", F.col("digest").alias("subroot")), "merkle-of-source")
    found = descended(rounds, of_source, by, {"doc_id": dict(docs.dtypes)["doc_id"], "digest": "string", "tampered": "string"})
    return found.select(
        F.when(F.col("has") == 1, F.col("src")).alias("source"), F.col("up_lo").alias("rank"), "doc_id",
        F.col("digest").alias("leaf"), "tampered", "subroot", "root", "path",
    )


def report(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: leaf, roots, digest of the proof, and the root of the tampered copy."""
    kind = dict(docs.dtypes)["doc_id"]

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["doc_id", "leaf", "subroot", "root"]].copy()
            if kind == "bigint":
                out["doc_id"] = pd.array(out["doc_id"], "Int64")
            out["proof_sha256"] = [joined(path) for path in batch["path"]]
            out["folded_root"] = [folded(leaf, path) for leaf, path in zip(batch["tampered"], batch["path"], strict=True)]
            out["verified"] = out["folded_root"] == out["root"]
            yield out

    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return manifest(docs).select("doc_id", "leaf", "tampered", "subroot", "root", "path").mapInPandas(checked, schema)
