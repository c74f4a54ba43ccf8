"""Records of plain CSV files whose fields may hold line breaks, read by as many tasks as the files have pieces.

Whether a line break ends a record depends on all quotes before it. Each piece of a file
is scanned for its number of quotes alone; a piece that follows an odd number of quotes
starts inside a quoted field. With that known every piece is cut into records by itself.
What it cannot finish, the record that is open at its end and the lines that belong to one
opened in a piece before, are fragments: at most two a piece, put together by their order.

This rests on quotes standing around whole fields, those inside being doubled. Records
with quotes are held against that form, and a record that breaks it is an error, since
nothing behind it can be told apart then.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A row for each piece that starts inside quotes is broadcast: some 60 bytes each, for 128 TB in pieces of 128 MB.
MOST_PIECES = 1_000_000
# File name endings of codecs whose files are read by one task each.
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")

_FIELD = r'(?:[^",]*|"(?:[^"]|"")*")'
_WELL_FORMED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*\r?\z"
_RECORD, _REST, _BEGIN, _HEADER = 0, 1, 2, 3


class StrayQuote(ValueError):
    """A quote that neither surrounds a field nor is doubled inside one."""


def raw_lines(spark: SparkSession, path: str, separator: str | None = "\n") -> DataFrame:
    """(value, file, start): lines as bytes, in the order of the file within each piece."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("value").cast("binary").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )


def opened_before(pieces: DataFrame, flips: str = "flips") -> DataFrame:
    """Adds ``open``: whether a quote is open where a piece starts, from the quotes of the pieces before it."""
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return pieces.withColumn("open", F.coalesce(F.sum(flips).over(before), F.lit(0)) % 2 == 1)


def _states(lines: DataFrame) -> DataFrame:
    """(file, start, open, flips) of every piece, from one scan that counts quotes."""
    quotes = F.octet_length("value") - F.octet_length(F.replace(F.col("value").cast("string"), F.lit('"'), F.lit("")))
    return opened_before(lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("flips")))


class _Cutter:
    """Cuts the lines of one piece into records, batch by batch."""

    def __init__(self, file: str | int, start: int, open_: bool):
        self.file, self.start = file, start
        self.odd = int(open_)
        self.rest = open_  # lines up to the first end belong to a record of a piece before
        self.header = start == 0
        self.held: list[bytes] = []

    def cut(self, lines: pa.Array) -> tuple[pa.Array, list[tuple[int, bytes]]]:
        """Records of one line as they are; records of several lines, and rests that end here, with their kind."""
        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        odd = (self.odd + np.cumsum(quotes)) % 2
        ends = odd == 0
        alone = ends & np.concatenate([[self.odd == 0], ends[:-1]])
        last = np.flatnonzero(ends)
        first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        header = -1
        if self.header:
            filled = pc.greater(pc.binary_length(pc.ascii_rtrim(lines.view(pa.string()), characters="\r")), 0).to_numpy(zero_copy_only=False)
            named = np.flatnonzero(filled[last] | ~alone[last])
            if len(named):
                header = int(last[named[0]])
                self.header = False
        out: list[tuple[int, bytes]] = []
        for b, i in zip(first[~alone[last]].tolist(), last[~alone[last]].tolist()):
            self.held += lines[b : i + 1].to_pylist()
            if i != header:
                out.append((_REST if self.rest else _RECORD, b"\n".join(self.held)))
            self.held, self.rest = [], False
        self.held += lines[last[-1] + 1 if len(last) else 0 :].to_pylist()
        self.odd = int(odd[-1])
        if header >= 0:
            alone[header] = False
        return lines.filter(pa.array(alone)), out

    def close(self) -> list[tuple[int, bytes]]:
        """What is open at the end of the piece."""
        if not self.held:
            return []
        return [(_REST if self.rest else _HEADER if self.header else _BEGIN, b"\n".join(self.held))]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str | int, int, bool, pa.Array]]:
    """Lines of a batch that stand in one piece."""
    for b in batches:
        if not b.num_rows:
            continue
        n = b.num_rows - 1
        other = [pc.not_equal(b.column(i).slice(1), b.column(i).slice(0, n)).to_numpy(zero_copy_only=False) for i in (1, 2)]
        borders = [0, *(np.flatnonzero(other[0] | other[1]) + 1).tolist(), b.num_rows]
        for at, end in zip(borders, borders[1:]):
            yield *(b.column(i)[at].as_py() for i in (1, 2, 3)), b.column(0).slice(at, end - at)


def _checked(records: pa.Array) -> pa.Array:
    """Records without empty ones and carriage returns at the end; quotes and breaks must stand where they may."""
    records = pc.ascii_rtrim(records.view(pa.string()), characters="\r")
    records = records.filter(pc.greater(pc.binary_length(records), 0)).view(pa.binary())
    quoted = records.filter(pc.match_substring(records, '"'))
    bad = quoted.filter(pc.invert(pc.match_substring_regex(quoted, _WELL_FORMED)))
    if len(bad):
        raise StrayQuote(f"a quote stands inside a field or is not closed: {bad[0].as_py()[:200]!r}; read such a file with parallel=False")
    returns = records.filter(pc.match_substring(records, "\r"))
    for r in returns.to_pylist():
        if any(b"\r" in part for part in r.split(b'"')[::2]):
            raise StrayQuote(f"a bare carriage return stands outside quotes: {r[:200]!r}; read such a file with parallel=False")
    return records


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that start and end in one piece."""
    cutter = None
    for file, start, open_, lines in _runs(batches):
        if cutter is None or (cutter.file, cutter.start) != (file, start):
            cutter = _Cutter(file, start, open_)
        alone, several = cutter.cut(lines)
        for part in (alone, pa.array([r for kind, r in several if kind == _RECORD], pa.binary())):
            if len(part):
                yield pa.RecordBatch.from_arrays([_checked(part)], names=["record"])


def _fragments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, kind, part) of records that lie in several pieces."""
    out: list[tuple] = []
    cutter = None
    for file, start, open_, lines in _runs(batches):
        if cutter is None or (cutter.file, cutter.start) != (file, start):
            out += [(cutter.file, cutter.start, *x) for x in cutter.close()] if cutter else []
            cutter = _Cutter(file, start, open_)
        _, several = cutter.cut(lines)
        out += [(file, start, kind, r) for kind, r in several if kind == _REST]
    out += [(cutter.file, cutter.start, *x) for x in cutter.close()] if cutter else []
    types = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
    columns = list(zip(*out)) or [()] * 4
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["file", "start", "kind", "part"])


def _join_checked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([_checked(b.column(0))], names=["record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the bytes of every record but the headers; nothing runs before the frame is used.

    Lines end in a line feed, with or without a carriage return. Empty lines outside
    quotes are no records.
    """
    lines = raw_lines(spark, path)
    size = int(str(lines._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    if size // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > MOST_PIECES:
        raise ValueError(f"{path} has more than {MOST_PIECES} pieces; set spark.sql.files.maxPartitionBytes higher")
    states = _states(lines)
    inside = F.broadcast(states.where("open").select("file", "start", "open"))
    # Neighbouring pieces are told apart by a hash of the file's name, which is shorter than the name.
    told = lines.join(inside, ["file", "start"], "left").select("value", F.xxhash64("file").alias("file"), "start", F.coalesce("open", F.lit(False)).alias("open"))
    done = told.mapInArrow(_whole, "record binary")
    # Pieces that start or end inside quotes are looked at once more, the others leave no fragment.
    cut = F.broadcast(states.where(F.col("open") | (F.col("flips") == 1)).select("file", "start", "open"))
    parts = lines.join(cut, ["file", "start"]).select("value", "file", "start", "open").mapInArrow(_fragments, "file string, start long, kind int, part binary")
    in_order = Window.partitionBy("file").orderBy("start", "kind")
    numbered = parts.withColumn("nth", F.sum(F.when(F.col("kind") > _REST, 1).otherwise(0)).over(in_order))
    ordered = F.array_sort(F.collect_list(F.struct("start", "kind", F.col("part").cast("string").alias("part"))))
    joined = numbered.groupBy("file", "nth").agg(ordered.alias("parts"), F.max("kind").alias("kind")).where(F.col("kind") != _HEADER)
    text = F.array_join(F.transform("parts", lambda p: p["part"]), "\n").cast("binary")
    return done.unionByName(joined.select(text.alias("record")).mapInArrow(_join_checked, "record binary"))
