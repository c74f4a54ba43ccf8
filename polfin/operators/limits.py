"""Row caps, top-k and samples that never gather their rows in one task.

A cap or sample is the rows that come first in some order: of positions in files, or of
64-bit draws. The order is never made. Rows are counted in the cells of a first level, then
in those of the one cell in which the cut falls, and so on; what lies before the cut is
kept by a filter where it stands, and only rows of the last cell are put in order. That
holds for any number of rows, so the same rows come out whatever their number is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polfin.functions.columns import c, cols
from polfin.operators.sets import all_present

# Bits of a level: at most 65,536 counts reach the driver, whatever the rows.
LEVEL_BITS = 16
# Copies of one row that a task writes out.
COPIES_AT_ONCE = 100_000
_FILE, _ROW, _DRAW = "__file", "__row", "__draw"


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Best ``k`` rows; add a unique column to the order for a repeatable result."""
    return df.orderBy(*order).limit(k)


def with_positions(df: DataFrame) -> DataFrame:
    """Rows with the file and the place in it that they were read from.

    For frames of Parquet files with filters and projections on them; another operation
    may leave no position, or repeat one.
    """
    return df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))


def _position_levels() -> list[Column]:
    """Files by groups of a hash, so that no level has more cells than the driver can hold, then rows of a file."""
    group = F.pmod(F.xxhash64(_FILE), F.lit(1 << LEVEL_BITS))
    return [group, F.col(_FILE), F.shiftright(_ROW, LEVEL_BITS), F.col(_ROW)]


def _draw_levels() -> list[Column]:
    return [F.shiftright(_DRAW, 64 - LEVEL_BITS), F.shiftright(_DRAW, 64 - 2 * LEVEL_BITS)]


def _find_cut(df: DataFrame, levels: Sequence[Column], n: int) -> tuple[list, int, int] | None:
    """The cell of every level in which the n-th row falls, the rows before the last of them and the rows in it.

    None if there are no more than ``n`` rows.
    """
    cells, before, held = [], 0, 0
    for level in levels:
        inside = df.where(reduce(and_, (a == F.lit(v) for a, v in zip(levels, cells)), F.lit(True)))
        counts = sorted(inside.groupBy(level.alias("cell")).agg(F.count("*").alias("n")).collect())
        if not cells and sum(r["n"] for r in counts) <= n:
            return None
        for cell, held in counts:
            if before + held >= n:
                break
            before += held
        cells.append(cell)
    return cells, before, held


def _some_of(df: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    """Exactly ``n`` of the rows by the order of all columns. Equal rows travel as one row with a count,
    so a row repeated millions of times stays one row until it is written out again."""
    copies = df.groupBy(*cols(names)).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*cols(names)).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.least(F.col("__n"), F.lit(n) - F.coalesce(F.sum("__n").over(before), F.lit(0)))
    block = F.explode(F.expr(f"sequence(0L, (__take - 1) div {COPIES_AT_ONCE})"))
    size = F.least(F.lit(COPIES_AT_ONCE), F.col("__take") - F.col("__block") * COPIES_AT_ONCE)
    return (
        copies.withColumn("__take", taken)
        .where("__take > 0")
        .withColumn("__block", block)
        .repartition(F.col("__block"))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), size.cast("int"))))
        .select(*cols(names))
    )


def _first_rows(df: DataFrame, levels: Sequence[Column], names: Sequence[str], n: int) -> DataFrame:
    """Exactly the ``n`` first rows in the order of the levels, then of all columns; fewer if there are no more."""
    if n <= 0:
        return df.where(F.lit(False)).select(*cols(names))
    cut = _find_cut(df, levels, n)
    if cut is None:
        return df.select(*cols(names))
    cells, before, held = cut
    takes_cell = before + held == n
    same = [a == F.lit(v) for a, v in zip(levels, cells)]
    less = [a < F.lit(v) for a, v in zip(levels, cells)]
    at_cut = reduce(and_, same)
    first = reduce(or_, [reduce(and_, same[:i], less[i]) for i in range(len(cells))])
    # Stated alone, so that whole files are passed over: the levels below do not speak of files only.
    # A CASE, since of two disjunctions the optimizer would take out what they share.
    coarse = F.when(same[0], levels[1] <= F.lit(cells[1])).otherwise(less[0])
    whole = df.where(coarse).where(first | at_cut if takes_cell else first).select(*cols(names))
    return whole if takes_cell else whole.unionByName(_some_of(df.where(at_cut), names, n - before))


def first_rows(df: DataFrame, n: int, positions: bool = False) -> DataFrame:
    """``n`` rows, the same on every run and for every partitioning.

    With ``positions`` (see ``with_positions``) rows are taken file by file, and files
    beyond the cut are not read; otherwise by a hash of the whole row.
    """
    if positions:
        return _first_rows(with_positions(df), _position_levels(), df.columns, n)
    return _first_rows(df.withColumn(_DRAW, F.xxhash64(*cols(df.columns))), _draw_levels(), df.columns, n)


def rows_by_cycle(df: DataFrame) -> dict[int, int]:
    """Rows of each cycle, in one job; cycles are a few dozen."""
    counts = df.where(F.col("cycle").isNotNull()).groupBy("cycle").agg(F.count("*").alias("n")).collect()
    return {r["cycle"]: r["n"] for r in sorted(counts)}


def limit_by_cycle(
    df: DataFrame, limit: int | None, cycles: Sequence[int] | None = None, positions: bool = False
) -> DataFrame:
    """At most ``limit`` rows, used up cycle by cycle in the given order, or from the earliest on.

    One job counts the cycles. Whole cycles are kept by a filter on the cycle; only
    the one in which the cap falls needs a choice, which is that of ``first_rows``.
    """
    if limit is None:
        return df if cycles is None else df.where(F.col("cycle").isin(*cycles))
    counts = rows_by_cycle(df)
    left, complete = limit, []
    partial = None
    for cycle in counts if cycles is None else [x for x in cycles if x in counts]:
        if left <= 0:
            break
        n = counts[cycle]
        if n > left:
            partial = first_rows(df.where(F.col("cycle") == cycle), left, positions)
            break
        complete.append(cycle)
        left -= n
    result = df.where(F.col("cycle").isin(*complete)) if complete else df.where(F.lit(False))
    return result if partial is None else result.unionByName(partial)


def sample_rows(df: DataFrame, n: int, seed: int = 0, positions: bool = False) -> DataFrame:
    """``n`` rows chosen by the seed, so re-runs agree; all if there are no more.

    With ``positions`` (see ``with_positions``) every row is drawn by its place in its file.
    Otherwise draws are hashes of the row, which equal rows share: they are chosen
    together, but for those with which the sample ends.
    """
    if positions:
        drawn = with_positions(df).withColumn(_DRAW, F.xxhash64(F.lit(seed), _FILE, _ROW))
    else:
        drawn = df.withColumn(_DRAW, F.xxhash64(F.lit(seed), *cols(df.columns)))
    return _first_rows(drawn, _draw_levels(), df.columns, n)


def sample_keys(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` distinct keys chosen by the seed, so re-runs agree; all if there are no more.

    The distinct keys are computed for each of the three passes; store them first where that is dear.
    """
    distinct = df.select(*cols(keys)).where(all_present(keys)).distinct()
    return _first_rows(distinct.withColumn(_DRAW, F.xxhash64(F.lit(seed), *cols(keys))), _draw_levels(), keys, n)
