"""Quality rules: base statistics of a text, and lines that too many documents of a host share.

Everything is DataFrame functions. Each text is read and hashed once: its statistics and line
hashes are written, and the rest works on that table. Lines are counted after a distinct of (host,
line, text), so exact copies of a text count as one document, and a hot line or host is combined
before each shuffle. Frequent lines are written and meet the lines again in an ordinary join,
which AQE can broadcast when they are few and split when one of them is hot.

Defined cases: a null text has no words and fails the base rules; a null source is the host
''; rows that repeat an id are judged by their own texts, and equal rows alike; texts are judged
whole at any length; an empty table gives an empty result; other columns are ignored by ``judge``
and kept by ``clean``. Two hashes of 64 bits stand for windows of words within one text and for
lines of one host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SPACES, bind, lower_ascii, split_words, text_key, written

#: A line is frequent beyond this number of distinct texts of its host, whatever the host's size.
MAX_DOCUMENTS = 20
#: A document that loses more than this share of its line characters is depleted.
MAX_LOST = 0.5

SYMBOLS = "#*$%&|<>"


def lines_of(text: Column) -> Column:
    """The lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(" \t\x0b\x0c\r")) != "")


def normalised_lines(text: Column) -> Column:
    """All lines with A-Z lowered and white space made one space; a line without a word is empty."""
    # on the whole text, line breaks apart: one pass instead of one for each line
    return F.transform(F.split(lower_ascii(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")), "\n"), lambda x: F.trim(x))


def repeated_words(words: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more.

    Windows are hashed; where some are equal, they are sorted with their positions, so that equal
    ones are neighbours.
    """

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(w[i - 1], w[i], w[i + 1]))

    def placed(hashes: Column) -> Column:
        return F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("at")))

    def covered(s: Column) -> Column:
        again = F.filter(
            s,
            lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
        )
        spread = F.flatten(F.transform(again, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
        return F.size(F.array_distinct(spread))

    return bind(
        words,
        lambda w: F.when(F.size(w) < 3, 0).otherwise(
            bind(
                windows(w),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(
                    bind(F.sort_array(placed(h)), covered)
                ),
            )
        ),
    )


def line_hashes(text: Column) -> Column:
    """The distinct normalised lines of a text: hash and characters."""

    lines = F.array_distinct(F.filter(normalised_lines(text), lambda x: x != ""))
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("chars")))


#: What tells one row of documents from another here; equal rows share it and the verdict.
def row_key() -> list[Column]:
    return [F.col("doc_id"), F.coalesce("source", F.lit("")).alias("host"), text_key(F.col("text")).alias("key")]


def base(docs: DataFrame) -> DataFrame:
    """The row key, the base statistics and the distinct lines, one row for each row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    counted = docs.select(
        *row_key(),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bind(lines_of(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.coalesce(line_hashes(F.col("text")), F.array().cast("array<struct<line:bigint,chars:int>>")).alias("lines"),
        bind(
            split_words(text, SPACES),
            lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("again")),
        ).alias("words"),
    )
    n, again = F.col("words.n"), F.col("words.again")
    return counted.select(
        "doc_id", "host", "key", "lines", characters("lines").alias("chars"), n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        again.alias("n_repeat_words"), ((n < 50) | (100 * again > 50 * n)).alias("base_failed"),
    )


def frequent_lines(based: DataFrame, most: int = MAX_DOCUMENTS) -> DataFrame:
    """host, line: the lines of more than ``most`` distinct texts of a host."""
    lines = based.select("host", "key", F.explode("lines.line").alias("line")).distinct()
    return lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(F.col("n") > most).select("host", "line")


def lost_lines(based: DataFrame, most: int, rows: list[str]) -> DataFrame:
    """``rows``, with the frequent lines of each and their characters, where there are any."""
    frequent = written(frequent_lines(based, most), "lines-frequent")
    lines = based.select(*dict.fromkeys([*rows, "host"]), F.explode("lines").alias("x")).withColumn("line", F.col("x.line"))
    # a set: rows that are equal have lost the same
    lost = lines.join(frequent, ["host", "line"]).groupBy(*rows).agg(F.collect_set("x").alias("lost"))
    return lost.withColumn("lost_chars", characters("lost"))


def characters(lines: str) -> Column:
    return F.aggregate(lines, F.lit(0), lambda sum_, x: sum_ + x["chars"])


def judge(docs: DataFrame, most: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST) -> DataFrame:
    """A row for each row of ``docs``: statistics, share of line characters lost, ``kept``."""
    # numbered once written, so a row finds its own lines again, whatever rows are equal
    based = written(base(docs).withColumn("row", F.monotonically_increasing_id()), "quality-base")
    lost = written(lost_lines(based, most, ["row"]).drop("lost"), "quality-lost")
    gone = F.coalesce(F.col("lost_chars") / F.col("chars"), F.lit(0.0))
    return based.join(lost, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        gone.alias("lost_share"), (~F.col("base_failed") & (gone <= max_lost)).alias("kept"),
    )


def clean(docs: DataFrame, most: int = MAX_DOCUMENTS, max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` without rejected documents, and without the frequent lines of the others.

    ``text`` keeps its other lines as they are, and ``n_chars`` follows it. All columns stay.
    """
    key = ["doc_id", "host", "key"]
    based = written(base(docs).select(*key, "lines", "chars", "base_failed"), "quality-base")
    lost = lost_lines(based, most, [*key, "chars", "base_failed"])
    depleted = F.col("lost_chars") / F.col("chars") > max_lost
    marked = lost.select(*key, "base_failed", depleted.alias("depleted"), F.col("lost.line").alias("lost_lines"))
    failed = based.filter("base_failed").select(*key, "base_failed", F.lit(False), F.lit(None)).distinct()
    marked = marked.filter(~F.col("base_failed")).unionAll(failed)
    marked = written(marked, "quality-lost", instead_of=[based])
    rows = docs.select(F.struct(*docs.columns).alias("row"), *row_key())
    same = [rows["doc_id"].eqNullSafe(marked["doc_id"]), rows["host"] == marked["host"], rows["key"] == marked["key"]]
    met = rows.join(marked, same, "left").filter(F.expr("NOT coalesce(base_failed OR depleted, FALSE)"))
    text = F.col("row.text")
    # the lines as they are beside what they are compared by
    both = F.arrays_zip(F.split(text, "\n").alias("line"), normalised_lines(text).alias("key"))
    left = F.filter(both, lambda x: ~F.array_contains(F.col("lost_lines"), F.xxhash64(x["key"])))
    left = F.array_join(F.transform(left, lambda x: x["line"]), "\n")
    kept = met.withColumn("left", F.when(F.col("lost_lines").isNull(), text).otherwise(left))
    new = {"text": F.col("left"), "n_chars": F.length("left").cast("long")}
    return kept.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
