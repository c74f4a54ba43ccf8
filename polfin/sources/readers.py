"""Readers for raw CSV, nested JSON and cycle-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.functions.columns import c, cols
from polfin.functions.scalars import blank_to_null
from polfin.operators.predicates import Predicate, named_cycles, requested_cycles, where_all
from polfin.sources import pieces, snapshots
from polfin.sources.specs import TERMS_SCHEMA, DatasetSpec


class SchemaMismatch(ValueError):
    """A file's columns are not the declared ones."""


def check_columns(found: Iterable[str], spec: DatasetSpec) -> None:
    """Compare column names as sets; their order is free."""
    found, wanted = set(found), set(spec.columns)
    if found != wanted:
        raise SchemaMismatch(
            f"{spec.name}: missing columns {sorted(wanted - found)}, unexpected {sorted(found - wanted)}"
        )


def _csv_reader(spark: SparkSession, spec: DatasetSpec, multi_line: bool | None = None) -> DataFrameReader:
    """Doubled quotes, no escape character. Records are always parsed whole: with
    column pruning a job that needs few columns, or only a count, would not notice
    a record with the wrong number of fields."""
    return spark.read.options(
        header=True,
        encoding=spec.encoding,
        quote='"',
        escape='"',
        multiLine=spec.multi_line if multi_line is None else multi_line,
        columnPruning=False,
    )


def splits(spark: SparkSession, path: str) -> bool:
    """Whether the files of a path can be read piece by piece."""
    return not any(f.endswith(pieces.COMPRESSED) for f in spark.read.text(path).inputFiles())


def lopsided(spark: SparkSession, path: str) -> bool:
    """Whether one file holds more than the share of a task, of those that can run at once."""
    length = F.col("length")
    most, total = spark.read.format("binaryFile").load(path).agg(F.max(length), F.sum(length)).first()
    return most is not None and most * spark.sparkContext.defaultParallelism > total


def read_csv_text(
    spark: SparkSession, path: str, spec: DatasetSpec, multi_line: bool | None = None, parallel: bool | None = None
) -> DataFrame:
    """Raw CSV with every column as text, in the order of the columns of the file.

    Only the header line is read here. A record with too few or too many fields
    fails the job that reads it. A plain file known to hold no line breaks inside
    fields is split over tasks with ``multi_line=False``; other plain files are cut into
    records piece by piece (``pieces``) unless ``parallel`` is False. Compressed files are
    parsed by one task each.
    """
    reader = _csv_reader(spark, spec, multi_line)
    names = reader.csv(path).columns
    check_columns(names, spec)
    lines_may_break = spec.multi_line if multi_line is None else multi_line
    if lines_may_break and (parallel or (parallel is None and splits(spark, path))):
        record = F.col("record").cast("string") if spec.encoding == "UTF-8" else F.decode("record", spec.encoding)
        schema = ", ".join(f"`{n}` STRING" for n in names)
        options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true"}
        # A generator is kept however few columns are used, so that every record is parsed.
        return pieces.records(spark, path).select(F.inline(F.array(F.from_csv(record, schema, options))))
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader.schema(text).options(mode="FAILFAST", enforceSchema=False).csv(path)


def read_csv_rejects(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """The malformed records of a CSV file: the raw ``record`` beside what could be read of it."""
    reader = _csv_reader(spark, spec)
    text = [T.StructField(n, T.StringType()) for n in reader.csv(path).columns]
    corrupt = T.StructField("record", T.StringType())
    rows = reader.schema(T.StructType([*text, corrupt])).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord="record"
    )
    return rows.csv(path).where("record IS NOT NULL")


def mark_nulls(text: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Turn the null markers of a source, quoted or not, into NULL."""
    return text.select(*[blank_to_null(c(n), spec.null_markers).alias(n) for n in text.columns])


def cast_columns(text: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Cast by name to the declared types, in the order of the input; a value that does not fit is an error."""
    return text.select(*[c(n).cast(spec.schema[n].dataType).alias(n) for n in text.columns])


def read_csv(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """Typed rows of a raw CSV file."""
    return cast_columns(mark_nulls(read_csv_text(spark, path, spec), spec), spec)


def _count_records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per file piece: records if the piece starts outside quotes, or inside, and whether it ends the other way."""
    pieces: dict[tuple[str, int], list[int]] = {}
    for b in batches:
        quotes = pc.count_substring(b.column(0), '"').to_numpy(zero_copy_only=False)
        empty = pc.equal(pc.binary_length(b.column(0)), 0).to_numpy(zero_copy_only=False)
        names, starts = b.column(1).to_pylist(), b.column(2).to_pylist()
        at = 0
        while at < len(names):
            end = at
            while end < len(names) and names[end] == names[at] and starts[end] == starts[at]:
                end += 1
            n = pieces.setdefault((names[at], starts[at]), [0, 0, 0])
            odd = (n[2] + np.cumsum(quotes[at:end])) % 2
            before = np.concatenate([[n[2]], odd[:-1]])
            # A line ends a record if no quote is open behind it; an empty line outside quotes is none.
            n[0] += int(((odd == 0) & ~((before == 0) & empty[at:end])).sum())
            n[1] += int(((odd == 1) & ~((before == 1) & empty[at:end])).sum())
            n[2] = int(odd[-1])
            at = end
    rows = [(f, s, *n) for (f, s), n in pieces.items()]
    columns = list(zip(*rows)) or [()] * 5
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=["file", "start", "outside", "inside", "flips"])


def raw_record_count(spark: SparkSession, path: str) -> int:
    """Records of CSV files counted from their lines and quotes alone, apart from the CSV parser.

    Each piece of a file is counted for both cases, that it starts outside or inside a
    quoted field; which one holds follows from the quotes of the pieces before. Headers do
    not count. One row comes to the driver.
    """
    schema = "file string, start long, outside long, inside long, flips long"
    counted = pieces.raw_lines(spark, path, separator=None).mapInArrow(_count_records, schema)
    n = F.sum(F.when(F.col("open"), F.col("inside")).otherwise(F.col("outside")))
    one = pieces.opened_before(counted).agg(n.alias("n"), F.count_distinct("file").alias("files")).first()
    return (one["n"] or 0) - one["files"]


def read_terms(spark: SparkSession, *paths: str, multi_line: bool = True) -> DataFrame:
    """Legislators with their nested terms, from JSON arrays or JSON lines.

    A file holding one JSON array is read by one task. Large inputs should be
    JSON lines (``multi_line=False``), which split like any text.
    """
    return spark.read.schema(TERMS_SCHEMA).option("multiLine", multi_line).json(list(paths))


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*cols(columns))


def read_cycles(spark: SparkSession, root: str, predicates: Iterable[Predicate] = ()) -> DataFrame:
    """Rows of a cycle-partitioned dataset, in its last version, that satisfy every predicate.

    A predicate on the cycle prunes partitions, the others reach the scan.
    """
    return where_all(all_cycles(spark, root), predicates)


def all_cycles(spark: SparkSession, root: str) -> DataFrame:
    """A cycle-partitioned dataset, whether it keeps versions or not."""
    if snapshots.versions(spark, root):
        return snapshots.read(spark, snapshots.snapshot(spark, root))
    return spark.read.parquet(root)


def existing_cycles(spark: SparkSession, root: str) -> list[int]:
    """Cycles of the last version, or present as partition folders, from the file system alone."""
    return sorted(snapshots.snapshot(spark, root).cycles)


def split_by_presence(wanted: Sequence[int], present: Sequence[int]) -> tuple[list[int], list[int]]:
    """Requested cycles that exist and requested cycles that do not."""
    return [x for x in wanted if x in present], [x for x in wanted if x not in present]


def query_cycles(
    spark: SparkSession, root: str, sql: str, cycles: Sequence[int] | None = None, view: str = "contributions"
) -> DataFrame:
    """Run SQL over the chosen cycles of a dataset, or all that it has, seen as one view."""
    rows = all_cycles(spark, root)
    if cycles is not None:
        rows = rows.where(F.col("cycle").isin(*cycles))
    rows.createOrReplaceTempView(view)
    return spark.sql(sql)


def cycles_to_load(predicates: Iterable[Predicate], present: Sequence[int]) -> tuple[list[int], list[int]]:
    """Cycles that are there and that the predicates leave, and cycles asked for by name that are not there."""
    predicates = list(predicates)
    wanted, named = requested_cycles(predicates), named_cycles(predicates)
    chosen = list(present) if wanted is None else [x for x in present if x in set(wanted)]
    return chosen, [x for x in named or () if x not in present]
