"""Transcript parsing: roles of lines by a hidden Markov model, then canonical turns.

A transcript is lines in order. States are role and place (first line of a turn or a later
one); a line shows a speaker marker (of many spellings, or none), its length, and whether it
asks. Transition and emission counts are summed by Spark over labelled lines; they are a few
dozen numbers. Lines are range-partitioned and sorted by conversation and order, and written with their
place; up to ``BLOCK`` lines that follow each other are a block. The likeliest states of a
conversation are found by Viterbi over a tree of blocks: each block becomes one max-plus matrix
over the states, up to ``FAN`` matrices that follow each other become one, and so on until a
conversation has few; then the states at the ends of each are handed down, and each block is decoded
between its ends. Lines become pieces at each first line; a piece that goes on from another block
belongs to the last turn begun before, which the same tree finds, and the pieces of a turn are
joined and written in one canonical form. Python steps through all blocks of an Arrow batch at once.

Scores are whole numbers, so a sum does not depend on how it is split, and ties are broken by a
hash of the line that is far smaller than what the model can tell apart: the turns are the same at
every size of blocks.

Defined cases: a null or empty text is one empty line; a null role is a line without a marker
and teaches nothing; rows that repeat a turn number are ordered by line and text, and rows
without one come first; each line without a conversation id is a transcript of its own; a conversation
may have any number of lines, and a line any length; only the text of a single turn is held
together; an empty table gives no turns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bind, written

ROLES = ["system", "user", "assistant"]
STATES = [(role, first) for role in ROLES for first in (True, False)]
#: Spellings of speakers that are read as markers, besides the roles' own names.
SPEAKERS = {
    "system": ["system", "instructions", "context"],
    "user": ["user", "human", "q", "customer"],
    "assistant": ["assistant", "ai", "a", "bot"],
}
MARKERS = ["none", *ROLES]
LENGTHS = [0, 20, 40, 80, 160, 320]
#: Lines in a block, matrices that become one, and so many of a conversation that they are gathered.
BLOCK = 256
FAN = 256
FEW = 1024
#: Scores are in units of 2**-30; a line's tie break is below 2**16 of them.
UNIT = 1 << 30
NOISE = 16
NEVER = -(1 << 60)
#: One turn in so many has lost its marker in the transcripts made from labelled turns.
LOST = 3


def transcripts(turns: DataFrame, lost: int = LOST) -> DataFrame:
    """conv_id, turn, line, text, role: lines as a log would show them, some without a speaker.

    The spelling of the marker, and whether it is missing, follow from a hash of the turn.
    """
    draw = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(1 << 20))
    spelled = F.lit(None).cast("string")
    for role, names in SPEAKERS.items():
        name = F.get(F.array(*map(F.lit, names)), (F.floor(draw / lost) % len(names)).cast("int"))
        spelled = F.when(F.col("role") == role, F.concat(F.initcap(name), F.lit(": "))).otherwise(spelled)
    marker = F.when(draw % lost == 0, "").otherwise(F.coalesce(spelled, F.lit("")))
    text = F.concat(marker, F.coalesce("text", F.lit("")))
    return turns.select("conv_id", "turn", "role", F.posexplode(F.split(text, "\\n")).alias("line", "text"))


def marker_of(text: Column) -> Column:
    found = F.lower(F.regexp_extract(text, r"^\s*\W{0,3}([A-Za-z]{1,12})\W{0,3}:\s", 1))
    out = F.lit("none")
    for role, names in SPEAKERS.items():
        out = F.when(found.isin(names), role).otherwise(out)
    return out


def observed(lines: DataFrame) -> DataFrame:
    """``lines`` with seen: the number of what a line shows."""
    size = F.lit(0)
    for i, least in enumerate(LENGTHS):
        size = F.when(F.length("text") >= least, i).otherwise(size)
    marker = F.array_position(F.array(*map(F.lit, MARKERS)), marker_of(F.col("text"))) - 1
    asks = F.col("text").rlike(r"\?\s*$").cast("int")
    return lines.withColumn("seen", ((marker * len(LENGTHS) + size) * 2 + asks).cast("int"))


def counted(lines: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of transitions and emissions, from labelled lines.

    The last state of the transitions is the one before the first line.
    """
    n, kinds = len(STATES), len(MARKERS) * len(LENGTHS) * 2
    known = lines.filter(F.col("role").isin(ROLES))
    state = (F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1) * 2 + (F.col("line") > 0).cast("int")
    emission = np.full((n + 1, kinds), 0.1)
    for r in known.groupBy(state.alias("s"), "seen").agg(F.count("*").alias("n")).collect():
        emission[r["s"], r["seen"]] += r["n"]
    # within a turn the states follow from its number of lines; between turns from the roles
    turns = known.groupBy("conv_id", "turn", "role").agg(F.max("line").alias("last"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    change = np.full((n + 1, n + 1), 0.1)
    pairs = turns.join(following, ["conv_id", "turn"]).groupBy("role", "next", (F.col("last") > 0).alias("long"))
    for r in pairs.agg(F.count("*").alias("n")).collect():
        change[2 * ROLES.index(r["role"]) + r["long"], 2 * ROLES.index(r["next"])] += r["n"]
    sums = turns.groupBy("role").agg(
        F.count(F.when(F.col("last") > 0, 1)).alias("goes_on"),
        F.sum(F.greatest(F.col("last") - 1, F.lit(0))).alias("stays"),
        F.count(F.when(F.col("turn") == 0, 1)).alias("begins"),
    )
    for r in sums.collect():
        i = 2 * ROLES.index(r["role"])
        change[i, i + 1] += r["goes_on"]
        change[i + 1, i + 1] += r["stays"]
        change[n, i] += r["begins"]
    change, emission = (np.log(x / x.sum(axis=1, keepdims=True)) for x in (change, emission))
    change[:, n] = -np.inf
    for i, (role, first) in enumerate(STATES):  # a later line follows only a line of its role
        if not first:
            change[[j for j in range(n + 1) if j == n or STATES[j][0] != role], i] = -np.inf
    return change, emission


def places(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each place in order: the sequences that have it, and where it is in all of them joined."""
    order, starts = np.argsort(-sizes, kind="stable"), np.cumsum(sizes) - sizes
    for place in range(sizes.max(initial=0)):
        rows = order[: np.searchsorted(-sizes[order], -place)]
        yield rows, starts[rows] + place


def scaled(logs: np.ndarray) -> np.ndarray:
    """Log probabilities as whole numbers; what cannot be stays so in any sum."""
    return np.where(np.isfinite(logs), np.round(np.where(np.isfinite(logs), logs, 0) * UNIT), NEVER).astype(np.int64)


def unit_matrix(n: int) -> np.ndarray:
    return np.where(np.eye(n) > 0, 0, NEVER).astype(np.int64)


def products(sizes: np.ndarray, score: Callable[[np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """The best score of a way through each sequence, by its first and its last state."""
    out = np.tile(unit_matrix(n), (len(sizes), 1, 1))
    for rows, at in places(sizes):
        out[rows] = np.maximum((out[rows][:, :, :, None] + score(at)[:, None]).max(axis=2), NEVER)
    return out


def viterbi(
    sizes: np.ndarray, score: Callable[[np.ndarray], np.ndarray], n: int, enters: np.ndarray, leaves: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The likeliest states before and after each place of all sequences joined.

    ``enters`` and ``leaves`` are the states at their ends; -1 leaves the last one free.
    """
    best, steps = unit_matrix(n)[enters], []
    for rows, at in places(sizes):
        both = best[rows][:, :, None] + score(at)
        steps.append((rows, at, both.argmax(axis=1).astype(np.int8)))
        best[rows] = np.maximum(both.max(axis=1), NEVER)
    state = np.where(leaves < 0, best.argmax(axis=1), leaves)
    before, after = (np.zeros(sizes.sum(), np.int8) for _ in range(2))
    for rows, at, back in reversed(steps):
        after[at] = state[rows]
        state[rows] = before[at] = back[np.arange(len(rows)), state[rows]]
    return before, after


Values = list[np.ndarray]


def through_tree(
    nodes: DataFrame, by: list[str], join: Callable[[list[Values]], Values], push: Callable[[list[Values], Values], list[Values]],
    top: list[int], few: int = FEW,
) -> DataFrame:
    """by, id and ``given``: what every node is handed, in a tree over the nodes of each group in the order of id.

    ``nodes`` has by, id and value (whole numbers). ``join`` makes one value of those of nodes that follow each other,
    for many such runs at once; ``push`` hands each node of a run its part of what the run was handed;
    ``top`` is handed to whole groups. No task sees more than ``few`` nodes of a group.
    """
    kinds = dict(nodes.dtypes)
    group = ", ".join(f"{c} {kinds[c]}" for c in by)
    members = F.array_sort(F.collect_list(F.struct("id", "value"))).alias("members")

    def split(members: pd.Series) -> list[Values]:
        return [[np.asarray(x["value"], np.int64) for x in run] for run in members]

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            yield rows[[*by, "id"]].assign(value=list(join(split(rows["members"]))))

    def pushed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            given = push(split(rows["members"]), [np.asarray(x, np.int64) for x in rows["given"]])
            out = rows[by].loc[rows.index.repeat([len(x) for x in given])].reset_index(drop=True)
            ids = [x["id"] for run in rows["members"] for x in run]
            yield out.assign(id=ids, given=[g for run in given for g in run])

    runs = []
    while (nodes.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0) > few:
        runs.append(written(nodes.groupBy(*by, F.expr(f"id DIV {FAN}").alias("parent")).agg(members), "transcript-runs"))
        nodes = runs[-1].withColumnRenamed("parent", "id").mapInPandas(joined, f"{group}, id long, value array<long>")
        nodes = written(nodes, "transcript-nodes")
    whole = nodes.groupBy(*by).agg(members).withColumn("given", F.array(*(F.lit(x).cast("long") for x in top)))
    given = whole.mapInPandas(pushed, f"{group}, id long, given array<long>")
    for run in reversed(runs):
        met = run.join(given.withColumnRenamed("id", "parent"), [*by, "parent"])
        given = met.mapInPandas(pushed, f"{group}, id long, given array<long>")
    return given


def joined_matrices(runs: list[Values]) -> Values:
    n = len(STATES) + 1
    sizes, m = np.array([len(r) for r in runs]), np.array([x for r in runs for x in r]).reshape(-1, n, n)
    return list(products(sizes, m.__getitem__, n).reshape(-1, n * n))


def pushed_ends(runs: list[Values], given: Values) -> list[Values]:
    n = len(STATES) + 1
    sizes, m = np.array([len(r) for r in runs]), np.array([x for r in runs for x in r]).reshape(-1, n, n)
    ends = np.array(given)
    both = np.stack(viterbi(sizes, m.__getitem__, n, ends[:, 0], ends[:, 1]), axis=1).astype(np.int64)
    return [list(x) for x in np.split(both, np.cumsum(sizes)[:-1])]


def joined_lasts(runs: list[Values]) -> Values:
    """The last turn begun in a run; -1 if there is none."""
    return [np.array([max(int(x[0]) for x in run)]) for run in runs]


def pushed_lasts(runs: list[Values], given: Values) -> list[Values]:
    """The last turn begun before each node."""
    out = []
    for run, first in zip(runs, given, strict=True):
        known = np.maximum.accumulate([int(first[0]), *(int(x[0]) for x in run)])
        out.append([np.array([x]) for x in known[:-1]])
    return out


def parse(lines: DataFrame, model: tuple[np.ndarray, np.ndarray], block: int = BLOCK, few: int = FEW) -> DataFrame:
    """conv_id, turn, role, n_lines, rendered: the turns found, each at its first line's turn."""
    change, emission = map(scaled, model)
    n = len(STATES) + 1
    by = ["has", "conv", "loose"]
    strip = F.regexp_replace("text", r"^\s*\W{0,3}[A-Za-z]{1,12}\W{0,3}:\s+", "")
    shown = F.when(marker_of(F.col("text")) == "none", F.col("text")).otherwise(strip)
    has = F.col("conv_id").isNotNull()
    rows = observed(lines).select(
        has.cast("int").alias("has"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.when(has, F.lit(0).cast("long")).otherwise(F.xxhash64("turn", "line", "text")).alias("loose"),
        "conv_id", "turn", "line", "text", shown.alias("shown"), F.col("seen").cast("int").alias("seen"),
        F.xxhash64("turn", "line", "text").alias("tie"),
    )
    order = [*by, F.col("turn").asc_nulls_first(), "line", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("line", "text")
    placed = written(placed.withColumn("place", F.monotonically_increasing_id()), "transcript-placed")
    blocks = placed.groupBy(*by, F.expr(f"place DIV {block}").alias("id")).agg(
        F.first("conv_id").alias("conv_id"),
        F.array_sort(F.collect_list(F.struct("place", "turn", "shown", "seen", "tie"))).alias("rows"),
    )
    columns = [F.col(f"rows.{c}").alias(c) for c in ("place", "turn", "shown", "seen", "tie")]
    blocks = written(blocks.select(*by, "id", "conv_id", *columns), "transcript-blocks", instead_of=[placed])
    shifts = np.arange(n, dtype=np.uint64)

    def shows(rows: pd.DataFrame) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
        sizes, seen = rows["seen"].map(len).to_numpy(np.int64), np.concatenate(rows["seen"].to_list())
        tie = np.concatenate(rows["tie"].to_list()).astype(np.int64).view(np.uint64)
        noise = (((tie[:, None] >> (8 * shifts)) ^ (tie[:, None] << (3 * shifts))) & np.uint64((1 << NOISE) - 1)).astype(np.int64)
        return sizes, lambda at: np.maximum(change + (emission[:, seen[at]].T + noise[at])[:, None, :], NEVER)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            yield rows[[*by, "id"]].assign(value=list(products(*shows(rows), n).reshape(-1, n * n)))

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in filter(len, batches):
            sizes, score = shows(rows)
            ends = np.array([np.asarray(x, np.int64) for x in rows["given"]])
            _, path = viterbi(sizes, score, n, ends[:, 0], ends[:, 1])
            yield rows[[*by, "id"]].assign(path=np.split(path, np.cumsum(sizes)[:-1]))

    # Python sees numbers only, no text
    numbers, kind = blocks.select(*by, "id", "seen", "tie"), "has int, conv string, loose long, id long"
    nodes = written(numbers.mapInPandas(matrices, f"{kind}, value array<long>"), "transcript-matrices")
    ends = through_tree(nodes, by, joined_matrices, pushed_ends, [n - 1, -1], few)
    paths = numbers.join(ends, [*by, "id"]).mapInPandas(decoded, f"{kind}, path array<tinyint>")
    paths = written(paths, "transcript-paths", instead_of=[nodes])
    pieces = blocks.join(paths, [*by, "id"]).select(*by, "id", "conv_id", F.posexplode(pieces_of(F.col("path"))).alias("k", "x"))
    pieces = written(pieces.select(*by, "id", "conv_id", "k", "x.*"), "transcript-pieces", instead_of=[blocks, paths])
    began = pieces.groupBy(*by, "id").agg(F.coalesce(F.max(F.when(F.col("first"), F.col("place"))), F.lit(-1)).alias("last"))
    lasts = through_tree(began.select(*by, "id", F.array("last").alias("value")), by, joined_lasts, pushed_lasts, [-1], few)
    lasts = written(lasts.select(*by, "id", F.col("given")[0].alias("before")), "transcript-lasts")
    # a piece without a first line is the rest of the turn before, or the beginning of all
    of = F.when(F.col("first") | (F.col("before") < 0), F.col("place")).otherwise(F.col("before"))
    turns = pieces.join(lasts, [*by, "id"]).withColumn("of", of).groupBy(*by, "of").agg(
        F.first("conv_id").alias("conv_id"), F.min_by("turn", "place").alias("turn"), F.min_by("role", "place").alias("role"),
        F.sum("n_lines").cast("int").alias("n_lines"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "\n").alias("text"),
    )
    rendered = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>")).alias("rendered")
    return turns.select("conv_id", "turn", "role", "n_lines", rendered)


def pieces_of(path: Column) -> Column:
    """The pieces of a block: a new one wherever the path has a first line, and at the block's first line."""
    starts = F.filter(F.sequence(F.lit(0), F.size(path) - 1), lambda i: (i == 0) | (F.get(path, i) % 2 == 0))

    def piece(starts: Column, i: Column, k: Column) -> Column:
        size = F.coalesce(F.get(starts, k + 1), F.size(path)) - i
        return F.struct(
            F.get("place", i).alias("place"), F.get("turn", i).alias("turn"),
            F.get(F.array(*map(F.lit, ROLES)), F.floor(F.get(path, i) / 2).cast("int")).alias("role"),
            (F.get(path, i) % 2 == 0).alias("first"), size.alias("n_lines"),
            F.array_join(F.slice("shown", i + 1, size), "\n").alias("text"),
        )

    return bind(starts, lambda starts: F.transform(starts, lambda i, k: piece(starts, i, k)))


def recovered(turns: DataFrame) -> DataFrame:
    """The turns of the transcripts made from labelled ``turns``, by a model counted on them."""
    lines = transcripts(turns)
    shown = written(observed(lines).select("conv_id", "turn", "line", "role", "seen"), "transcript-lines")
    return parse(lines.drop("role"), counted(shown))
