"""Benchmark decontamination: 10-word windows of documents found in a hash set of benchmark windows.

Everything is DataFrame functions. Words are hashed once and windows by the hashes of their words; a
bitmap of the benchmark's window hashes, at most ``BITMAP_WORDS`` numbers of 64 bits, tells which windows of a
document can be one of these, and only such a window is made a string. The benchmark's windows
are a table keyed by the window's own words, so a hit of the join is verified by the strings
themselves. That table is broadcast when its counted size is below ``BROADCAST_BYTES``; beyond it the same
join is left to Spark, which shuffles the windows that the bitmap lets through and can split a hot one.
Documents are read once: each row yields these windows and one marker row; only markers and hits leave
the join, so the only other shuffle holds a row for each document and hit. Windows are made from blocks
of words, so a very long text is never one array of strings.

Defined cases: null and empty texts have no words and are clean; an item without an id still
hits, but is not counted; items that repeat an id count once; equal rows of documents give
equal rows of the result; an empty benchmark hits nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bind, lower_ascii, split_words, text_key
from tablewright.operators.joins import per_join_key

WINDOW = 10
#: The largest benchmark that is broadcast, in bytes of its distinct windows and their items.
BROADCAST_BYTES = 64 << 20
#: Words of a document from which windows are made at once.
BLOCK = 2048
#: The bitmap has a power of two of 64-bit numbers, 16 bits for a window, and at most so many (1 MB).
BITMAP_WORDS = 1 << 17

#: Characters that are no part of a word, after A-Z are lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same before A-Z are lowered: words, and what stands between them.
WORD_IN_TEXT = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return split_words(lower_ascii(text), BETWEEN)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """gram (words joined by a space), size and the ids of the items that have it."""

    def grams(w: Column) -> Column:
        size = F.least(F.size(w), F.lit(window))
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - size + 1),
            lambda i: F.struct(
                F.concat_ws(" ", F.slice(w, i, size)).alias("gram"), size.alias("size"),
                window_hash(F.transform(F.slice(w, i, size), lambda x: F.xxhash64(x)), F.lit(1), size).alias("hash"),
            ),
        )

    each = bind(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, grams(w)))
    each = benchmark.select(F.col("item_id").cast("string").alias("item"), F.explode(each).alias("x"))
    keys = each.select("x.gram", "x.size", "x.hash", "item")
    return per_join_key(keys, ["gram", "size", "hash"], F.collect_set("item").alias("items"))


def window_hash(hashes: Column, at: Column, size: Column | int) -> Column:
    return F.xxhash64(F.slice(hashes, at, size))


def bitmap(grams: DataFrame, n: int) -> tuple[Column, int]:
    """The bits of the window hashes as a constant array, and how many numbers it has."""
    words = min(BITMAP_WORDS, max(64, 1 << (n // 4).bit_length()))
    place, _ = _place(F.col("hash"), words)
    rows = grams.groupBy(place.alias("place")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")).alias("bits"))
    bits = [0] * words
    for r in rows.collect():  # as many as the bitmap has numbers, at most
        bits[r["place"]] = r["bits"]
    return F.from_json(F.lit(json.dumps(bits)), "array<bigint>"), words


def _place(hash_: Column, words: int) -> tuple[Column, Column]:
    """The number and the bit in it that stand for a hash."""
    place = F.shiftrightunsigned(hash_, 6).bitwiseAND(F.lit(words - 1)).cast("int")
    return place, hash_.bitwiseAND(F.lit(63)).cast("int")


def document_windows(docs: DataFrame, sizes: list[int], bits: Column, bit_words: int) -> DataFrame:
    """doc_id, key, n_words, at, size, gram: the windows of ``sizes`` words that the bitmap has, and a marker at -1."""
    longest = max(sizes, default=1)

    def blocks(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(BLOCK))
        return F.transform(
            starts,
            lambda b: F.struct(
                b.alias("start"), F.size(w).alias("n_words"), F.slice(w, b + 1, BLOCK + longest - 1).alias("words")
            ),
        )

    def told(hashes: Column, i: Column) -> Column:
        place, bit = _place(F.get(hashes, i - 1), bit_words)
        return F.getbit(F.get(bits, place), bit) == 1

    def windows(size: int) -> Column:
        last = F.least(F.size("b.words") - size + 1, F.lit(BLOCK))
        hashes = F.transform(F.sequence(F.lit(1), last), lambda i: window_hash(F.col("hashes"), i, size))
        of_size = F.transform(
            bind(hashes, lambda h: F.filter(F.sequence(F.lit(1), last), lambda i: told(h, i))),
            lambda i: F.struct(
                (F.col("b.start") + i - 1).alias("at"), F.lit(size).alias("size"),
                F.concat_ws(" ", F.slice("b.words", i, size)).alias("gram"),
            ),
        )
        return F.when(last >= 1, of_size).otherwise(F.slice(marker, 1, 0))

    marker = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("size"), F.lit("").alias("gram")))
    first = F.when(F.col("b.start") == 0, marker).otherwise(F.slice(marker, 1, 0))
    cut = docs.select(
        "doc_id", text_key(F.col("text")).alias("key"),
        F.explode(bind(words_of(F.col("text")), blocks)).alias("b"),
    )
    # a column of its own: the hashes of the words serve windows of every size
    cut = cut.select("doc_id", "key", "b", F.transform("b.words", lambda x: F.xxhash64(x)).alias("hashes"))
    return cut.select(
        "doc_id", "key", "b.n_words", F.explode(F.concat(first, *map(windows, sizes))).alias("x")
    ).select("doc_id", "key", "n_words", "x.at", "x.size", "x.gram")


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, key, rows (how many equal rows), n_words, hits (word positions) and items."""
    grams = benchmark_windows(benchmark, window)
    # a window of many items has a row as long as their list
    items = F.octet_length(F.concat_ws("", "items")) + 16 * F.size("items")
    size = grams.groupBy("size").agg(F.count("*").alias("n"), F.sum(2 * F.octet_length("gram") + items).alias("bytes")).collect()
    bits = bitmap(grams, sum(r["n"] for r in size))
    if sum(64 * r["n"] + r["bytes"] for r in size) <= BROADCAST_BYTES:
        grams = F.broadcast(grams)
    found = (
        document_windows(docs, sorted(r["size"] for r in size), *bits)
        .join(grams.drop("size", "hash"), "gram", "left")
        .filter(F.col("items").isNotNull() | (F.col("at") < 0))
    )
    spread = F.flatten(F.transform("at", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1)))
    return (
        found.groupBy("doc_id", "key", "n_words")
        .agg(
            F.count(F.when(F.col("at") < 0, 1)).alias("rows"),
            F.collect_set(F.when(F.col("at") >= 0, F.struct("at", "size"))).alias("at"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .withColumn("hits", F.array_distinct(spread))
        .drop("at")
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """A row for each row of ``docs``: words, hit words, items that occur in it."""
    found = scan(docs, benchmark, window)
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row"),
    ).drop("row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit words cut out (``remove="spans"``).

    Cut words leave what stood between them. ``n_chars`` follows the text; all columns stay.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove {remove!r}: documents or spans")
    bad = scan(docs, benchmark, window).filter(F.size("hits") > 0)
    bad = bad.select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key"), "hits")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text_key(F.col("text")).alias("key"))
    same = rows["doc_id"].eqNullSafe(bad["bad_id"]) & (rows["key"] == bad["bad_key"])
    if remove == "documents":
        return rows.join(bad, same, "left_anti").select("row.*")
    text = F.col("row.text")
    words, gaps = F.regexp_extract_all(text, F.lit(f"({WORD_IN_TEXT})")), F.split(text, WORD_IN_TEXT)
    left = bind(
        words,
        lambda w: F.concat(
            bind(gaps, lambda g: g[0]),
            F.array_join(
                F.zip_with(
                    F.transform(w, lambda x, i: F.when(F.array_contains("hits", i), "").otherwise(x)),
                    bind(gaps, lambda g: F.slice(g, 2, F.size(g))),
                    lambda x, g: F.concat(x, g),
                ),
                "",
            ),
        ),
    )
    kept = rows.join(bad, same, "left").withColumn("left", F.when(F.col("hits").isNull(), text).otherwise(left))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return kept.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
