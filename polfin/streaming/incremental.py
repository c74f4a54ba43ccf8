"""Incremental runs over files that keep arriving.

Each run takes in the files no earlier run has seen and stops; the checkpoint
remembers them. Source, output and checkpoint must lie where all executors can
reach them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from polfin.functions.columns import c
from polfin.plans import marts
from polfin.session import read_small_pieces, settings
from polfin.sources import snapshots
from polfin.sources.readers import all_cycles
from polfin.sources.sinks import ZSTD_LEVEL, merge_sums, write_cycles

# State on the executors' disks, of which only changes are saved with each batch.
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
ROW_KEY = "__row_key"
# A task sorts its rows by cycle before it writes them, so what it reads bounds its memory.
PIECE_BYTES = 32 << 20


def stream_parquet(spark: SparkSession, root: str, schema: T.StructType, files_at_once: int | None = None) -> DataFrame:
    """New Parquet files below a folder; ``cycle=`` folders become a column."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_at_once) if files_at_once else reader).parquet(root)


def append_new(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
) -> StreamingQuery:
    """Transform new rows one by one and add them to a cycle-partitioned dataset.

    The file sink commits each batch with a log, so a batch repeated after a
    failure does not appear twice. Files are read in pieces of ``PIECE_BYTES`` at most,
    by a setting of the session.
    """
    read_small_pieces(stream.sparkSession, PIECE_BYTES)
    return (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(ZSTD_LEVEL))
        .partitionBy("cycle")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def row_key(df: DataFrame) -> Column:
    """SHA-256 of a row: the same for rows that DISTINCT takes for equal, and for no others known.

    Each value is written with its length, so neighbours cannot be taken for one another; a
    NULL is unlike any text, 0.0 is like -0.0. Nested columns are refused.
    """

    def written(field: T.StructField) -> Column:
        value, kind = c(field.name), field.dataType
        if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            raise ValueError(f"{field.name}: rows with nested columns have no key")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
        elif isinstance(kind, T.TimestampType):
            value = F.unix_micros(value)
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[written(f) for f in df.schema]).cast("binary"), 256))


def append_distinct(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    partitions: int | None = None,
) -> StreamingQuery:
    """Transform new rows one by one and add those to a cycle-partitioned dataset that no run has added before.

    The dataset is DISTINCT of all rows so far; neither source nor dataset is read again. A
    state store on disk holds 32 bytes for each row of the dataset, over ``partitions``
    parts: all runs keep the number of the first, which should grow with the dataset.
    """
    rows = transform(stream)
    state = dict(_ROCKSDB)
    if partitions:
        state["spark.sql.shuffle.partitions"] = str(partitions)

    def distinct(df: DataFrame) -> DataFrame:
        return df.withColumn(ROW_KEY, row_key(df)).dropDuplicates([ROW_KEY]).drop(ROW_KEY)

    with settings(stream.sparkSession, state):
        return append_new(rows, distinct, output, checkpoint)


def distinct_detail_stream(
    stream: DataFrame, links: DataFrame, output: str, checkpoint: str, partitions: int | None = None
) -> StreamingQuery:
    """Linked organizational contributions of the new files in ten columns, each row once.

    The link table is that of the run; rows added by earlier runs keep the person they had.
    """

    def linked(rows: DataFrame) -> DataFrame:
        return marts.organizational_detail(rows, None, None, distinct=False, links=links)

    return append_distinct(stream, linked, output, checkpoint, partitions)


def organizational_stream(stream: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Organizational contributions of the new files."""
    return append_new(stream, marts.organizational, output, checkpoint)


def refresh_aggregates(
    spark: SparkSession,
    stream: DataFrame,
    source_root: str,
    output: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame] = marts.recipient_aggregates,
) -> StreamingQuery:
    """Rebuild the aggregates of every cycle that new rows belong to.

    A batch only tells which cycles changed; each of them is recomputed from the
    stored source and replaced as a whole, all at once for readers. Repeating a batch
    gives the same result.
    """

    def rebuild(batch: DataFrame, _: int) -> None:
        touched = [r["cycle"] for r in batch.select("cycle").distinct().collect()]
        if touched:
            rows = all_cycles(spark, source_root).where(F.col("cycle").isin(*touched))
            snapshots.publish(spark, build(rows), output, touched, write_cycles)

    return (
        stream.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def merge_aggregates(stream: DataFrame, sums_root: str, checkpoint: str) -> StreamingQuery:
    """Add new rows to the stored sums of the recipient aggregates; files taken in before are not read again.

    For files that are only ever added. Where a cycle's files may be replaced, use
    ``refresh_aggregates``. ``marts.aggregates_of_sums(sinks.read_sums(...))`` gives the aggregates.
    """
    keys = ["cycle", *marts.RECIPIENT_KEY]

    def merge(batch: DataFrame, number: int) -> None:
        merge_sums(marts.recipient_sums(batch), sums_root, keys, number)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
