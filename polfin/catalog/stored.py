"""Datasets that queries need as files, written once per application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polfin.catalog.standins import contributions, terms
from polfin.session import new_work_path
from polfin.sources.sinks import write_cycles

_written: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _written:
        path = new_work_path(spark, label)
        write(path)
        _written[key] = path
    return _written[key]


def contributions_root(spark: SparkSession, sf_dir: str) -> str:
    """Contributions as Parquet with one folder per cycle, written where items meet their orders."""
    return _once(
        spark,
        sf_dir,
        "contributions",
        lambda path: write_cycles(contributions(spark, sf_dir, by_cycle="cycle"), path, gather=False),
    )


def shifted_root(spark: SparkSession, sf_dir: str) -> str:
    """The same with two cycles moved: one beyond the published range, one to an odd year."""
    shifted = "CAST(CASE cycle WHEN 1996 THEN 2023 WHEN 1998 THEN 2026 ELSE cycle END AS INT)"
    return _once(
        spark,
        sf_dir,
        "contributions-shifted",
        lambda path: write_cycles(contributions(spark, sf_dir, by_cycle=shifted), path, gather=False),
    )


def csv_path(spark: SparkSession, df: DataFrame, label: str, *, encoding: str, null: str, gzip: bool) -> str:
    """A frame as CSV files with headers, doubled quotes and the given null marker."""
    path = new_work_path(spark, label)
    options = {"header": True, "encoding": encoding, "quote": '"', "escape": '"', "nullValue": null}
    if gzip:
        options["compression"] = "gzip"
    df.write.options(**options).csv(path)
    return path


def terms_path(spark: SparkSession, sf_dir: str) -> str:
    """Nested terms as JSON lines."""
    return _once(spark, sf_dir, "terms", lambda path: terms(spark, sf_dir).write.json(path))
