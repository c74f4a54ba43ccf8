"""Helpers shared by the operators: reading, stored intermediate tables, row keys, fresh names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polfin.session import new_work_path

# A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
TEXT_BATCH_BYTES = "4m"
BLANKS = " \t\n\x0b\f\r"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared work folder, read back.

    Cuts lineage in a way that outlives executors, keeps what stands above from being
    computed twice, and gives the planner true sizes to choose joins by.
    """
    path = new_work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Column names that clash with none taken, whatever their case."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_key(text: Column) -> Column:
    """Tells apart texts that stand under one doc_id; with the id it names a document."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(spark: SparkSession) -> None:
    """Sends texts to Python workers in small batches, whatever their length, which bounds the workers' memory.

    A setting of the session, since plans run later; number batches stay as they are.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", TEXT_BATCH_BYTES)
