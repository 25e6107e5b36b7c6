"""Quality classifier by importance resampling: how much likelier a text is as target than as raw.

Texts are bags of hashed words and word pairs. The target model is counted on the documents
labelled as good, the raw model on all documents; both are smoothed distributions over
``BUCKETS`` buckets, so their size is fixed and the two together (1 MB) go to every task. The
log weight of a text is the log of the ratio of its probabilities under the two models, the sum over its
features. Gumbel noise drawn from a hash of id and text turns the ``k`` largest sums into a sample without
replacement in proportion to the weights. The k-th largest key is found exactly by a search that
narrows the range of written keys: a few passes, each a histogram of at most 65,536 rows.

Counts are summed per task before Spark shuffles them, so a hot text or bucket is one row per
task. Defined cases: null and empty texts have no features and log weight 0; rows of one id but other
texts draw their own noise, so do texts without an id; equal rows get equal keys, and of rows that tie with
the last key those written first are kept, as many as fill ``k``; texts count whole at any length;
without labels both models are equal; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import written
from tablewright.llm.words import NO_LETTER, U, encoded, runs, word_hashes
from tablewright.operators.joins import left_outer

BUCKETS = 1 << 16
SMOOTHING = 1.0


def features(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: index of the first, buckets of all features, and the text of each."""
    for first, run in encoded(texts):
        words, ends, _ = word_hashes(run, NO_LETTER)
        owner = np.repeat(np.arange(len(run)), np.diff(ends, prepend=0))
        pairs = runs(words, 2) if len(words) > 1 else words[:0]
        same = owner[1:] == owner[:-1] if len(words) > 1 else owner[:0].astype(bool)
        both = np.concatenate([words, pairs[same]])
        yield first, (both % U(BUCKETS)).astype(np.int64), np.concatenate([owner, owner[1:][same]])


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        good = batch["good"].to_numpy(bool)
        for first, bucket, owner in features(batch["text"].tolist()):
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[first + owner]], minlength=BUCKETS)
    seen = np.flatnonzero(raw)
    yield pd.DataFrame({"bucket": seen, "raw": raw[seen], "target": target[seen]})


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """For each bucket, the log of target over raw probability."""
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    # labels grow with the documents: the same merge join at every size, documents without an id spread
    marked = left_outer(docs.select("doc_id", "text"), good.hint("merge"), "doc_id", "good_id", "text")
    marked = marked.select("text", F.col("good_id").isNotNull().alias("good"))
    sums = marked.mapInPandas(counted, "bucket long, raw long, target long").groupBy("bucket")
    rows = sums.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    models = {}
    for name in ("raw", "target"):
        counts = np.full(BUCKETS, SMOOTHING)
        counts[rows["bucket"]] += rows[name]
        models[name] = np.log(counts / counts.sum())
    return models["target"] - models["raw"] if rows["target"].sum() else np.zeros(BUCKETS)


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id, draw (a hash of id and text), n_features and weight (the log of it) of each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, total = np.zeros(len(batch), np.int64), np.zeros(len(batch))
            for first, bucket, owner in features(batch["text"].tolist()):
                size = int(owner.max(initial=-1)) + 1
                n[first : first + size] = np.bincount(owner, minlength=size)
                total[first : first + size] = np.bincount(owner, shared.value[bucket], minlength=size)
            yield batch[["doc_id", "draw"]].assign(n_features=n, weight=total)

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, draw long, n_features long, weight double"
    return docs.select("doc_id", "text", "draw").mapInPandas(score, schema)


def kth_largest(keys: DataFrame, k: int) -> tuple[float, int]:
    """The k-th largest of column ``key``, by narrowing its range 65,536-fold until it is one value.

    And how many of the rows that have it are among the first ``k``.
    """
    low, high = keys.agg(F.min("key"), F.max("key")).first()
    while low < high:
        step = (high - low) / 65536
        cell = F.least(F.floor((F.col("key") - low) / step), F.lit(65535)) if step > 0 else F.lit(0)
        inside = keys.filter(F.col("key").between(low, high))
        cells = inside.groupBy(cell.alias("cell")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        for row in sorted(cells.collect(), key=lambda r: -r["cell"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low, k


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 0) -> DataFrame:
    """A row for each row of ``docs``: weight, Gumbel key and whether it is in the sample.

    ``share`` of the rows is sampled; by default as large a share as the labels call good.
    """
    docs, labels = docs.select("doc_id", "text"), labels.select("doc_id", "quality")
    if share is None:
        share = labels.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0] or 0.0
    drawn = docs.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 52)))
    uniform = (F.col("draw") + 0.5) / float(1 << 52)
    keyed = weights(drawn, log_ratios(docs, labels)).withColumn("key", F.col("weight") - F.log(-F.log(uniform)))
    keyed = written(keyed.drop("draw").withColumn("row", F.monotonically_increasing_id()), "importance")
    k = round(share * keyed.count())
    kept = F.lit(False)
    if k:
        last, of_last = kth_largest(keyed, k)
        ties = keyed.filter(F.col("key") == last).select((-F.col("row")).alias("key"))
        row, _ = kth_largest(ties, of_last)
        kept = (F.col("key") > last) | ((F.col("key") == last) & (-F.col("row") >= row))
    return keyed.withColumn("kept", kept).drop("row")
