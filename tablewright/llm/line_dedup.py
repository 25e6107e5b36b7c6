"""Lines that many documents share, kept in one of them; the answer is a bitmap for each document.

A row of 128-bit line hash, document and position stands for each long line. The rows are
range-partitioned by hash and document and sorted by position within, the largest document
first, so that the stream of a hash begins with the document that keeps the line; a hash that
a third of all rows carry is cut over several partitions by its documents. Each partition's
sorted stream gives, for each of its hashes, the number of documents and the first one; these
heads meet by hash, one row for each hash and partition, and tell which hashes are shared and
who keeps them. What the other documents lose is gathered as words of 64 bits, so text moves
once, to meet the bitmap of its document.

All of it is DataFrame functions. Heads and bitmaps are written before they are joined, so the
lines of a hot hash, and the copies of a hot row, lie on a side that AQE splits.

Defined cases: a document is a doc_id, so rows of one id count once, and all of them keep a line
whose largest id they have; a null id is a document, smaller than all others; a null or empty
text is one empty line; lines of any length are hashed whole, and a text of any number of lines
costs time in proportion; an empty table gives no rows; other columns are ignored by
``keep_bitmaps`` and kept by ``deduplicated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import bind, lower_ascii, text_key, written

#: What is stripped from a line, its least size in code points, and the documents.
STRIPPED = " \t\n\x0b\x0c\r"
LEAST_CHARS = 20
LEAST_DOCUMENTS = 3
#: Lines in a word of a bitmap.
BITS = 64


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(STRIPPED)))


def hashed(docs: DataFrame, least_chars: int) -> DataFrame:
    """doc_id, key (of the text), at (from 0), h1, h2: a row for each line of enough characters."""

    def entry(line: Column, at: Column) -> Column:
        return bind(
            line_key(line),
            lambda x: F.struct(
                at.alias("at"), F.length(x).alias("chars"),
                F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(LEAST_CHARS), x).alias("h2"),
            ),
        )

    # a line too short before it is stripped needs no hash
    long = F.filter(
        F.transform(lines(F.col("text")), lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
        lambda x: F.length(x["line"]) >= least_chars,
    )
    entries = F.transform(long, lambda x: entry(x["line"], x["at"]))
    one = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.explode(entries).alias("x"))
    return one.filter(F.col("x.chars") >= least_chars).select("doc_id", "key", "x.at", "x.h1", "x.h2")


def shared_lines(rows: DataFrame, least_documents: int) -> DataFrame:
    """h1, h2, keeper: the hashes of at least ``least_documents`` documents, and the largest of these."""
    streams = rows.repartitionByRange("h1", "h2", F.col("doc_id").desc_nulls_last()).sortWithinPartitions(
        "h1", "h2", F.col("doc_id").desc_nulls_last(), "at"
    )
    # the range partitioning serves this grouping as well: it needs no other shuffle
    per_document = streams.groupBy("h1", "h2", "doc_id").agg(F.min("at").alias("first"))
    heads = per_document.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
    return heads.filter(F.col("documents") >= least_documents).select("h1", "h2", "keeper")


def bitmaps(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """drop_id, drop_key, drop: the lines that each text loses, as words (number, bits) that are not 0."""
    lost = rows.join(shared, ["h1", "h2"]).filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("keeper")))
    bit = F.expr(f"shiftleft(1L, CAST(at % {BITS} AS INT))")
    # bits are combined by OR, so copies of a row cost nothing more and a hot row is one row a task
    words = lost.groupBy("doc_id", "key", F.expr(f"at DIV {BITS}").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy(F.col("doc_id").alias("drop_id"), F.col("key").alias("drop_key")).agg(
        F.collect_list(F.struct("word", "bits")).alias("drop")
    )


def keep_bitmaps(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS, text: bool = False
) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_lines, n_dropped and ``keep``, the compressed bitmap.

    ``keep`` holds words of 64 lines, as (word, bits) in order: bit i of word w is line 64 w + i, 1 if
    it stays. Words of which all lines stay are left out. ``text`` adds the text.
    """
    carried = ["doc_id", "text"] if text else ["doc_id"]
    met = _with_drops(docs.select("doc_id", "text"), least_chars, least_documents)
    # without drops there is nothing to find in the text but its line breaks
    n_lines = F.length("row.text") - F.length(F.translate("row.text", "\n", "")) + 1
    keep = F.transform(F.array_sort("drop"), lambda x: F.struct(x["word"].alias("word"), F.bitwise_not(x["bits"]).alias("bits")))
    none = F.array().cast("array<struct<word:int,bits:bigint>>")
    return met.select(
        *(F.col("row")[c].alias(c) for c in carried),
        F.coalesce(n_lines, F.lit(1)).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("drop", F.lit(0), lambda s, x: s + F.bit_count(x["bits"])), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(keep, none).alias("keep"),
    )


def _with_drops(docs: DataFrame, least_chars: int, least_documents: int) -> DataFrame:
    """row (all columns of ``docs``) and ``drop``, null where nothing goes."""
    rows = written(hashed(docs, least_chars), "lines")
    shared = written(shared_lines(rows, least_documents), "lines-shared")
    drops = written(bitmaps(rows, shared), "lines-dropped")
    whole = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", text_key(F.col("text")).alias("key"))
    on = whole["doc_id"].eqNullSafe(drops["drop_id"]) & (whole["key"] == drops["drop_key"])
    return whole.join(drops, on, "left").select("row", "drop")


def kept_text(text: Column, keep: Column) -> Column:
    """What a bitmap of ``keep_bitmaps`` leaves of a text, lines joined by line breaks."""
    gone = F.flatten(
        F.transform(
            keep,
            lambda x: F.transform(
                F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit(F.bitwise_not(x["bits"]), i) == 1),
                lambda i: x["word"] * BITS + i,
            ),
        )
    )
    left = bind(
        lines(text),
        # both lists are hashed once, so the cost follows the number of lines
        lambda x: F.array_join(
            F.transform(F.array_except(F.sequence(F.lit(0), F.size(x) - 1), gone), lambda i: F.get(x, i)), "\n"
        ),
    )
    return F.when(F.size(keep) == 0, text).otherwise(left)


def report(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """A row for each row of ``docs``: lines, lines dropped, digest of what is left."""
    found = keep_bitmaps(docs, least_chars, least_documents, text=True)
    left = F.coalesce(kept_text(F.col("text"), F.col("keep")), F.lit(""))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(left, 256).alias("kept_sha256"))


def deduplicated(docs: DataFrame, least_chars: int = LEAST_CHARS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` without the dropped lines; ``n_chars`` follows the text, all columns stay."""
    met = _with_drops(docs, least_chars, least_documents)
    keep = F.transform("drop", lambda x: F.struct(x["word"].alias("word"), F.bitwise_not(x["bits"]).alias("bits")))
    met = met.withColumn("left", F.when(F.col("drop").isNull(), F.col("row.text")).otherwise(kept_text(F.col("row.text"), keep)))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return met.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
