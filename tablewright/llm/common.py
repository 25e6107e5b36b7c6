"""Reading, scratch tables and expressions that several operators share."""

from __future__ import annotations

import gc
import shutil
import tempfile
from collections.abc import Callable, Iterable
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import new_folder

#: The Latin capitals that the contracts lower, and nothing else.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A run of white space between words, as the contracts define words.
SPACES = r"[\x20\x09-\x0D]+"


@cache
def _ship(application: str, spark: SparkSession) -> None:
    top = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="package-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{top.name}", "zip", top.parent, top.name))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    _ship(spark.sparkContext.applicationId, spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir, deleted when the application ends."""
    folder = new_folder(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def written(df: DataFrame, name: str, instead_of: Iterable[DataFrame] = ()) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there: cuts its lineage.

    ``instead_of`` are tables of this function that nothing reads from now on; they are deleted.
    """
    spark = df.sparkSession
    folder = scratch_folder(spark, name)
    df.write.parquet(folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out.scratch_folder = folder
    discarded(*instead_of)
    freed(spark)
    return out


def discarded(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_.scratch_folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, though ``body`` uses it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z lowered and no other letter."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def split_words(text: Column, between: str) -> Column:
    """The words of a text; an empty array for null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), between), lambda w: w != "")
    return words


def text_key(text: Column) -> Column:
    """With the document's id, what tells rows of one id apart; equal rows share it."""
    return F.xxhash64(text)


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that nothing refers to any more.

    Its cleaner does so when the driver's JVM collects garbage, which may otherwise take long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
