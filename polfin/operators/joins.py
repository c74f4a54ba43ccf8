"""Joins of a large side with a lookup whose size is measured, never assumed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.functions.columns import c
from polfin.sources.sinks import stored_copy

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 32


def measured_bytes(df: DataFrame) -> int:
    """Exact payload of a frame plus a fixed overhead per row, found in one pass."""
    widths = [F.coalesce(F.octet_length(c(n).cast("string")), F.lit(0)) for n in df.columns]
    per_row = reduce(add, widths, F.lit(ROW_OVERHEAD_BYTES)).cast("long")
    return df.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    is_stored: bool = False,
) -> DataFrame:
    """Join on equal keys, where any key may dominate the big side.

    The lookup is computed once, into a stored copy (unless it is one already), and
    measured there. One that fits is broadcast and the big side is not moved. A larger
    one is joined by a shuffle, in which adaptive execution splits the partitions of
    dominant keys and no others. Valid for inner, left, left_semi and left_anti.
    """
    table = lookup if is_stored else stored_copy(lookup, "lookup")
    fits = measured_bytes(table) <= max_bytes
    return big.join(F.broadcast(table) if fits else table.hint("merge"), list(keys), how)
