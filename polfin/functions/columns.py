"""Naming and ordering helpers for columns whose names contain dots."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(name: str, alias: str | None = None) -> Column:
    """Column reference that treats dots as part of the name."""
    escaped = name.replace("`", "``")
    if alias:
        return F.col(f"{alias}.`{escaped}`")
    return F.col(f"`{escaped}`")


def cols(names: Iterable[str], alias: str | None = None) -> list[Column]:
    return [c(n, alias) for n in names]


def underscore(name: str) -> str:
    return name.replace(".", "_")


def sanitize(df: DataFrame) -> DataFrame:
    """Replace dots by underscores in every column name (database boundary)."""
    renamed = [underscore(n) for n in df.columns]
    if len(set(renamed)) != len(renamed):
        raise ValueError("column names collide once dots become underscores")
    return df.toDF(*renamed)


def asc(name: str) -> Column:
    """Ascending order with NULLs last."""
    return c(name).asc_nulls_last()


def desc(name: str) -> Column:
    """Descending order with NULLs last."""
    return c(name).desc_nulls_last()
