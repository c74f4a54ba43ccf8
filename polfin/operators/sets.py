"""Deduplication, ranking and key comparison that hold when one key dominates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polfin.functions.columns import asc, c, cols
from polfin.sources.sinks import stored_copy


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order; remaining ties go by all other columns.

    ``row_number() = 1`` directly below a filter lets Spark keep one row per key
    and task before the shuffle, so a dominant key does not pile up in one task.
    """
    rest = [asc(n) for n in df.columns if n not in keys]
    place = Window.partitionBy(*cols(keys)).orderBy(*order, *rest)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def latest_per_key(df: DataFrame, keys: Sequence[str], by: str, ties: Sequence[str] = ()) -> DataFrame:
    """Most recent row of every key; ties go by the named columns, highest first."""
    order = [c(by).desc_nulls_last(), *[c(n).desc_nulls_last() for n in ties]]
    rest = [c(n).desc_nulls_last() for n in df.columns if n not in {*keys, by, *ties}]
    place = Window.partitionBy(*cols(keys)).orderBy(*order, *rest)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")


def union_tagged(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by column name, each row marked with the name of its frame."""
    result = None
    for name, df in frames.items():
        marked = df.withColumn(tag, F.lit(name))
        result = marked if result is None else result.unionByName(marked)
    return result


def all_present(keys: Sequence[str]) -> Column:
    """True when no key column is NULL."""
    return reduce(and_, (c(k).isNotNull() for k in keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*cols(keys)).agg(F.count("*").alias("copies")).where("copies > 1")


def key_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on either side (``in_left``, ``in_right``).

    Both sides are counted in one grouping after a union: partial counts collapse
    repeated keys before the shuffle, where a full outer join would move them all.
    """
    a = left.select(*cols(keys), F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = right.select(*cols(keys), F.lit(0).alias("l"), F.lit(1).alias("r"))
    return (
        a.unionByName(b)
        .groupBy(*cols(keys))
        .agg(F.sum("l").alias("in_left"), F.sum("r").alias("in_right"))
    )


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-NULL keys of the left side that the right side lacks."""
    a = left.select(*cols(keys)).where(all_present(keys)).distinct()
    return a.join(right.select(*cols(keys)).distinct(), list(keys), "left_anti")


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side lacks, NULLs being equal."""
    return left.subtract(right)


def distinct_rows(df: DataFrame) -> DataFrame:
    """DISTINCT that moves wide rows only where it must.

    Rows are fingerprinted (64 bits) and fingerprints seen more than once are stored.
    Rows with another fingerprint are unique and pass where they stand; only the rest is
    shuffled and compared in full. Input made by a costly plan should be stored first,
    since it is read three times.
    """
    names = df.columns
    print_ = F.xxhash64(*cols(names)).alias("__print")
    repeated = stored_copy(
        df.select(print_).groupBy("__print").agg(F.count("*").alias("n")).where("n > 1").select("__print"), "repeated"
    )
    marked = df.withColumn("__print", print_)
    unique = marked.join(repeated, "__print", "left_anti").select(*cols(names))
    several = marked.join(repeated, "__print", "left_semi").select(*cols(names)).distinct()
    return unique.unionByName(several)
