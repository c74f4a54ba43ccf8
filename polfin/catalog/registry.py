"""Registry of queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polfin.catalog.standins import with_prefix
from polfin.functions.columns import c

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Sums of cents end up exactly on a cent, averages may fall halfway between two.
# The nudge moves both engines to the same side.
_NUDGE = 1e-7


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where the result can be said in SQL."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_prefix(sql)
        return fn

    return add


def money(col: Column | str, digits: int = 2) -> Column:
    col = c(col) if isinstance(col, str) else col
    return F.round(col + F.lit(_NUDGE), digits)


def money_sql(expression: str, digits: int = 2) -> str:
    return f"ROUND(({expression}) + 1e-7, {digits})"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round money columns in place for comparison."""
    return df.select(*[money(n).alias(n) if n in names else c(n) for n in df.columns])
