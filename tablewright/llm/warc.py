"""WARC archives: writing, reading back, and revisit records in place of repeated payloads.

Archives are gzip files of WARC/1.1 records, written by Spark's own text writer: a record is
a string, and the four bytes that end every record are the line separator. Reading is the
text source with the same separator, and a small parser in the tasks that puts records back
together by their Content-Length, one record at a time; a payload may hold the separator.

``resolve`` shuffles headers (digest, id) only to find the original of each payload: the
record with the largest id. The originals meet the records again in a join on the digest,
where AQE splits a digest that a third of all records have. Archived revisit records have no
payload, and get the original of their digest too. Headers are made anew: every record has the date of
its writing, and a revisit names its original's record, URI and date. A record's id is its page's, so
rows that repeat a page id are one record in several versions.

Defined cases: a null payload is empty; a null id counts below all others; records that
repeat the largest id of their payload are all responses; equal rows give equal records; a
revisit without an original stays as it is; payloads of any length are written and read whole; an empty
table gives no records. Archives must be gzip files, which Spark does not split; others are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import scratch_folder
from tablewright.operators.joins import per_join_key

END = "\r\n\r\n"
#: The digits of base 32, as conv() writes them and as WARC digests do.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, refers_to_uri string"


def digest(payload: Column) -> Column:
    """SHA-1 in upper-case base 32, 10 hexadecimal digits at a time."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def as_records(pages: DataFrame) -> DataFrame:
    """A response record for each page, with its payload."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id", "url", F.lit("response").alias("record_type"), digest(payload.cast("binary")).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.lit(None).cast("long").alias("refers_to"),
        F.lit(None).cast("string").alias("refers_to_uri"), payload.alias("payload"),
    )


def resolve(records: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Records with a response for each payload, the one with the largest id, and revisits of it.

    Payloads of fewer than ``min_bytes`` bytes are all responses.
    """
    large = records.filter(F.col("payload_bytes") >= min_bytes)
    responses = large.filter(F.col("record_type") == "response").withColumn("of_digest", F.col("payload_digest"))
    first = F.max(F.struct("page_id", "url")).alias("first")  # a null id is below all others
    originals = per_join_key(responses, ["of_digest"], first, F.count("*").alias("n"))
    originals = originals.select("of_digest", F.col("first.page_id").alias("original"), F.col("first.url").alias("uri"), "n")
    # a payload of one response needs no change, but revisits from other archives may refer to it
    once = (F.col("n") == 1) & (F.col("record_type") == "response")
    found = records.join(
        originals, (F.col("payload_digest") == F.col("of_digest")) & (F.col("payload_bytes") >= min_bytes), "left"
    )
    again = F.col("of_digest").isNotNull() & ~once & ~F.col("page_id").eqNullSafe(F.col("original"))
    return found.select(
        "page_id", "url",
        F.when(again, F.lit("revisit")).otherwise(F.col("record_type")).alias("record_type"),
        "payload_digest", "payload_bytes",
        F.when(again, F.col("original")).otherwise(F.col("refers_to")).alias("refers_to"),
        F.when(again, F.col("uri")).otherwise(F.col("refers_to_uri")).alias("refers_to_uri"),
        F.when(again, F.lit("")).otherwise(F.col("payload")).alias("payload"),
    )


def record_text(record_id: Column, date: str) -> Column:
    """The record as text, without the END after its block."""
    revisit = F.col("record_type") == "revisit"

    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")))

    head = [
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:record:"), record_id, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:record:"), F.col("refers_to"), F.lit(">")))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, F.regexp_replace("refers_to_uri", r"[\r\n]", ""))),
        line("WARC-Refers-To-Date", F.when(revisit & F.col("refers_to").isNotNull(), F.lit(date))),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("X-Page-ID", F.col("page_id")),
        line("X-Payload-Length", F.col("payload_bytes")),
        F.concat(F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(END)),
    ]
    return F.concat(F.concat_ws("", *head), F.col("payload"))


def write_archives(records: DataFrame, folder: str, date: str | None = None) -> None:
    """Write archives, all records of one date (ISO 8601, UTC; by default now)."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    text = record_text(F.coalesce(F.col("page_id").cast("string"), F.lit("none")), date)
    records.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


def parsed(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    """Records from the pieces of files: a piece ends where END stood."""
    end = END.encode()
    whole, name = bytearray(), None

    def record() -> tuple | None:
        at = whole.find(end)
        if at < 0:
            return None
        head = {}
        for row in bytes(whole[:at]).decode().lstrip("\r\n").split("\r\n")[1:]:
            key, _, value = row.partition(": ")
            head[key] = value
        stop = at + len(end) + int(head["Content-Length"])
        if len(whole) < stop + len(end):
            return None
        block = bytes(whole[at + len(end) : stop])
        del whole[: stop + len(end)]
        number = lambda key: int(head[key].removeprefix("<urn:record:").rstrip(">")) if key in head else None
        row = (
            number("X-Page-ID"), head.get("WARC-Target-URI"), head["WARC-Type"],
            head["WARC-Payload-Digest"].removeprefix("sha1:"), number("X-Payload-Length"), number("WARC-Refers-To"),
            head.get("WARC-Refers-To-Target-URI"),
        )
        return (*row, block) if payloads else row

    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * payloads
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payloads
    schema = pa.schema(list(zip(names, kinds, strict=True)))
    for batch in batches:
        out = []
        for piece, file in zip(batch.column(0), batch.column(1), strict=True):
            if file.as_py() != name:
                if not file.as_py().endswith(".gz"):
                    raise ValueError(f"{file} is no gzip file, so a record may lie in two splits of it")
                whole, name = bytearray(), file.as_py()
            whole += piece.as_py() + end
            while row := record():
                out.append(row)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], schema=schema)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the archives in a folder, with their payloads (binary) if asked for."""
    pieces = spark.read.option("lineSep", END).text(folder)
    pieces = pieces.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"))
    schema = RECORD + ", payload binary" * payloads
    return pieces.mapInArrow(lambda batches: parsed(batches, payloads), schema)


def deduplicated(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as deduplicated archives and read their records back."""
    folder = scratch_folder(spark, "warc")
    write_archives(resolve(as_records(pages), min_bytes), folder)
    return read_archives(spark, folder)
