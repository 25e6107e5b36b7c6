"""Toxicity by non-negative positive-unlabelled learning.

The classifier is logistic, over the presence of hashed words and word beginnings, trained
with numpy on confirmed toxic documents and on unlabelled ones. Its risk is that of Kiryo and
others (2017): with class prior p, ``p R+(positives) + max(0, R-(unlabelled) - p R-(positives))``;
where the second term falls below zero the step goes up it instead, so that hidden positives
among the unlabelled are not fitted as negatives.

Training takes a sample bounded by ``POSITIVES`` and ``UNLABELLED`` documents, drawn by a hash
of the id, one text for each id, so that an id which many rows share cannot fill it; the driver
gets the sample's feature numbers only. All counts are over whole texts, and every document is
scored in one pass; the weights (1 MB) go to every task.

Defined cases: null and empty texts have no features and score by the bias alone; texts of any length
are scored whole; equal rows get equal scores; documents without an id are scored and not learnt from;
null labels are ignored; without a positive example every score is below 1e-15; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.words import NO_LETTER, U, encoded, word_hashes

#: Documents that training uses at most, about; the bound does not depend on the input.
POSITIVES = 2000
UNLABELLED = 4000
FEATURES = 1 << 18
PREFIXES = (4, 5, 6)
STEPS = 300
EVIDENCE = 14
CUT = 0.3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def features(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: index of the first, distinct features, and the text of each."""
    for first, run in encoded(texts):
        words, ends, heads = word_hashes(run, NO_LETTER, PREFIXES)
        owner = np.repeat(np.arange(len(run), dtype=U), np.diff(ends, prepend=0))
        each = [owner * U(FEATURES) + x % U(FEATURES) for x in (words, *heads)]
        pairs = np.unique(np.concatenate(each))
        yield first, (pairs % U(FEATURES)).astype(np.int32), (pairs // U(FEATURES)).astype(np.int64)


def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [np.zeros(0, np.int32)] * len(batch)
        for first, found, owner in features(batch["text"].tolist()):
            stops = np.searchsorted(owner, np.arange(int(owner.max(initial=-1)) + 2))
            for i in range(len(stops) - 1):
                out[first + i] = found[stops[i] : stops[i + 1]]
        yield batch[["doc_id", "positive"]].assign(found=out)


def sample(docs: DataFrame, labels: DataFrame) -> tuple[pd.DataFrame, float]:
    """Features of positives and of unlabelled documents, and the class prior."""
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    marks = marks.filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    n, known = marks.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count("toxic")).first()
    total = docs.count()

    def drawn(seed: int, most: int, of: int) -> Column:
        part = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
        return part < most / max(of, 1)

    positives = docs.join(marks.filter("toxic = 1"), F.col("doc_id") == F.col("id")).filter(drawn(1, POSITIVES, n))
    unlabelled = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & drawn(2, UNLABELLED, total))
    both = positives.select("doc_id", "text", F.lit(True).alias("positive")).unionAll(
        unlabelled.select("doc_id", "text", F.lit(False).alias("positive"))
    )
    # repeated rows of an id become one in each task before the shuffle
    both = both.groupBy("doc_id", "positive").agg(F.min("text").alias("text"))
    kind = dict(docs.dtypes)["doc_id"]
    rows = both.mapInPandas(featured, f"doc_id {kind}, positive boolean, found array<int>").toPandas()
    # in one order, so that a run adds up like any other
    return rows.sort_values(["positive", "doc_id"], ignore_index=True), n / max(known, 1)


def telling(in_positives: np.ndarray, in_others: np.ndarray, n: int, u: int) -> np.ndarray:
    """Which features more positives have than chance allows, by a log-likelihood ratio of EVIDENCE.

    Without this, the many rare words of a long text would add up to noise.
    """
    a, b = (np.bincount(x, minlength=FEATURES).astype(float) for x in (in_positives, in_others))
    part = n / (n + u)
    usual_a, usual_b = np.maximum((a + b) * part, 1e-9), np.maximum((a + b) * (1 - part), 1e-9)
    ratio = 2 * (a * np.log(np.maximum(a, 1e-9) / usual_a) + b * np.log(np.maximum(b, 1e-9) / usual_b))
    return (a > usual_a) & (ratio > EVIDENCE)


def risk(z: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """What a step lowers, and its gradient by the scores ``z``.

    That is the risk while its second term is not negative, and else the second term with its sign changed.
    """
    n, u = positive.sum(), (~positive).sum()
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss = np.logaddexp(0, z)  # of calling a text negative
    rest = loss[~positive].mean() - prior * loss[positive].mean()
    g = np.zeros(len(z))
    if rest >= 0:
        g[positive] = prior * (p[positive] - 1) / n - prior * p[positive] / n
        g[~positive] = p[~positive] / u
        return prior * np.logaddexp(0, -z[positive]).mean() + rest, g
    g[positive] = prior * p[positive] / n
    g[~positive] = -p[~positive] / u
    return -rest, g


def train(rows: pd.DataFrame, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam on the non-negative risk."""
    found = rows.pop("found").tolist()
    positive = rows["positive"].to_numpy(bool)
    weight, bias = np.zeros(FEATURES), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if not positive.any() or positive.all():
        return weight, -50.0
    sizes = np.array([len(x) for x in found])
    flat = np.concatenate(found).astype(np.int32)  # an empty list comes as floats
    owner = np.repeat(np.arange(len(found), dtype=np.int32), sizes)
    found = range(len(found))  # only their number is needed from here
    n, u = positive.sum(), (~positive).sum()
    told = telling(flat[positive[owner]], flat[~positive[owner]], n, u)[flat]
    flat, owner = flat[told], owner[told]
    m, v, mb, vb = np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.0
    for step in range(1, steps + 1):
        z = np.bincount(owner, weight[flat], minlength=len(found)) + bias
        _, g = risk(z, positive, prior)
        gw = np.bincount(flat, g[owner], minlength=FEATURES) + 1e-5 * weight
        gb = g.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        a, b = 1 - 0.9**step, 1 - 0.99**step
        weight -= 0.1 * (m / a) / (np.sqrt(v / b) + 1e-4)
        bias -= 0.1 * (mb / a) / (np.sqrt(vb / b) + 1e-4)
    # the bias at which the unlabelled texts are positive as often as the prior says
    z, low, high = np.bincount(owner, weight[flat], minlength=len(found))[~positive], -50.0, 50.0
    for _ in range(60):
        bias = (low + high) / 2
        over = (1 / (1 + np.exp(-np.clip(z + bias, -30, 30)))).mean() > prior
        low, high = (low, bias) if over else (bias, high)
    return weight, bias


def score(docs: DataFrame, weight: np.ndarray, bias: float) -> DataFrame:
    """doc_id and score of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(weight.astype(np.float32))

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = np.full(len(batch), bias)
            for first, found, owner in features(batch["text"].tolist()):
                size = int(owner.max(initial=-1)) + 1
                z[first : first + size] += np.bincount(owner, shared.value[found], minlength=size)
            yield batch[["doc_id"]].assign(score=1 / (1 + np.exp(-np.clip(z, -40, 40))))

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInPandas(scored, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: whether it was held out, its score, the prediction."""
    docs = docs.select("doc_id", "text")
    weight, bias = train(*sample(docs, labels.select("doc_id", "toxic")))
    return score(docs, weight, bias).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
