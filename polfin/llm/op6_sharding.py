"""Sharding along a Hilbert curve.

Source, language and size of a document are quantised, each to ``BITS`` bits, and
the three numbers are a cell of a cube. A Hilbert curve through the cube puts cells
that are near in all dimensions near in one order; the order is cut into runs of
equal row counts. A run spans few sources, languages and sizes at once, so minimum
and maximum of any of them let a reader skip most files.

No global sort: rows are counted per cell (at most 2^15 cells), and cells with many
rows are split by a hash of the id. A row's place is the rows before its piece,
summed over pieces, plus its place within the piece.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import fresh, stored

BITS = 5
DIMS = 3
ROWS_PER_PIECE = 4000


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of coordinates below 2**bits.

    Coordinates are turned into the transposed index by undoing, from the highest bit
    down, the exchanges and inversions of the curve's recursion, then Gray coded.
    """
    x = np.asarray(points, dtype=np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            invert = (x[i] >> b) & 1 == 1
            swap = np.where(invert, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(invert, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


@F.pandas_udf(T.LongType())
def _curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a, b, c], axis=1)) if len(a) else [], dtype="int64")


def _depth_grid(rows: DataFrame, column: str) -> DataFrame:
    """(value, step): values in order, NULL first, in steps of about equal row counts."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col(column).asc_nulls_first())
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(F.col(column).alias("value"), F.floor(before * (1 << BITS) / total).cast("int").alias("step"))


def _log_grid(size: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 2), F.lit((1 << BITS) - 1)).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 40, text: str = "text") -> DataFrame:
    """``docs`` with size, curve, shard and slot added.

    ``size`` is the text's length in UTF-8 bytes plus 16 (NULL text: 16), ``curve`` the
    index of the row's cell, ``shard`` its run of the curve, ``slot`` its place there,
    gapless from 0. Row counts of shards differ by one at most. Rows of a cell are
    ordered by a hash of doc_id, then doc_id and a checksum of the text; rows equal in all these are
    interchangeable. NULL sources and languages come first. Columns of ``docs`` with one
    of the four names are replaced. Fewer rows than shards leave shards empty.
    """
    new = ("size", "curve", "shard", "slot")
    rest = [c for c in docs.columns if c.lower() not in new]
    s, l, d1, d2, d3, mix, crc, pieces, piece, n, start, total, place = fresh(
        [*rest, *new], *"_s _l _d1 _d2 _d3 _mix _crc _pieces _piece _n _start _total _place".split()
    )
    body = F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")
    rows = docs.select(*[f"`{c}`" for c in rest], (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias(crc))

    sources = stored(_depth_grid(docs, "source"), "shard-sources").toDF(s, d1)
    langs = stored(_depth_grid(docs, "lang"), "shard-langs").toDF(l, d2)
    rows = (
        rows.join(sources, rows["source"].eqNullSafe(sources[s]), "left")
        .join(langs, rows["lang"].eqNullSafe(langs[l]), "left")
        .drop(s, l)
        .withColumn(d3, _log_grid(F.col("size")))
        .withColumn(mix, F.xxhash64("doc_id"))
    )
    cells = stored(rows.groupBy(d1, d2, d3).agg(F.count(F.lit(1)).alias(n)), "shard-cells")
    curve = _curve(d1, d2, d3).alias("curve")
    cells = stored(cells.select(d1, d2, d3, curve, F.ceil(F.col(n) / ROWS_PER_PIECE).alias(pieces)), "shard-curve")
    rows = rows.join(cells, [d1, d2, d3]).withColumn(piece, F.pmod(F.col(mix), F.col(pieces)))
    order = Window.orderBy("curve", piece)
    before = F.coalesce(F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(
        rows.groupBy("curve", piece)
        .agg(F.count(F.lit(1)).alias(n))
        .select("curve", piece, before.alias(start), F.sum(n).over(Window.partitionBy()).alias(total)),
        "shard-starts",
    )
    within = Window.partitionBy("curve", piece).orderBy(mix, "doc_id", crc, "size")
    placed = (
        rows.join(starts, ["curve", piece])
        .withColumn(place, F.col(start) + F.row_number().over(within) - 1)
        .withColumn("shard", F.floor(F.col(place) * shards / F.col(total)).cast("int"))
    )
    first = F.floor((F.col("shard") * F.col(total) + (shards - 1)) / shards)
    return placed.select(*[f"`{c}`" for c in rest], "size", "curve", "shard", (F.col(place) - first).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One sorted file run per shard, so that statistics of the file parts stay narrow."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
