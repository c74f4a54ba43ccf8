"""Parquet, table and JDBC sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from polfin.functions.columns import c, cols, sanitize
from polfin.session import new_work_path

# Fixed values.
ZSTD_LEVEL = 3
JDBC_BATCH_ROWS = 10_000
BULK_BATCH_ROWS = 100_000
# Columns that subset queries filter on, most selective use first.
READ_PATH_COLUMNS = ("bonica.rid", "bonica.cid", "recipient.state", "contributor.state", "date", "amount")
# Looked up by value; statistics are of no use to them in files sorted by another column.
BLOOM_COLUMNS = ("bonica.cid", "recipient.state", "contributor.state")
BLOOM_VALUES = 100_000


def _zstd(writer):
    return writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(ZSTD_LEVEL))


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a dataset with zstd-compressed Parquet."""
    writer = _zstd(df.write.mode("overwrite"))
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_cycles(
    df: DataFrame, root: str, within: Sequence[str] = (), gather: bool = True, cycles: Sequence[int] = ()
) -> None:
    """Replace the cycles present in ``df``, leaving all other cycles as they are.

    Of the ``cycles`` named, those that turn out to have no rows lose their old ones.

    ``gather`` collects each cycle into files of the advisory size; adaptive
    execution splits a cycle that is larger than that, so a dominant cycle is
    written by many tasks. Input that is already laid out by cycle can do without
    and is then written where it is read. Rows are sorted inside each file by
    ``within``.
    """
    laid_out = df.hint("rebalance", F.col("cycle")) if gather else df
    if within:
        laid_out = laid_out.sortWithinPartitions("cycle", *cols(within))
    observation = Observation()
    if cycles:
        laid_out = laid_out.observe(observation, *[F.count_if(F.col("cycle") == y).alias(str(y)) for y in cycles])
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    _zstd(writer.partitionBy("cycle")).parquet(root)
    for y in [y for y in cycles if not observation.get[str(y)]]:
        remove(df.sparkSession, f"{root}/cycle={y}")


def write_clustered(df: DataFrame, root: str, by: Sequence[str] = READ_PATH_COLUMNS) -> None:
    """Cycle-partitioned layout in which equal leading keys lie together.

    Rows are cut into ranges of (cycle, keys) and sorted by them, so a file of a cycle
    holds one range of the first key, and file and page statistics skip the rest. All keys
    take part, so a dominant first key is cut too. Lookups by the other text columns
    use Bloom filters.
    """
    keys = [n for n in by if n in df.columns]
    order = ["cycle", *cols(keys)]
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    for n in BLOOM_COLUMNS:
        if n in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{n}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{n}", str(BLOOM_VALUES))
    _zstd(writer.partitionBy("cycle")).parquet(root)


def append_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Add rows to a table, creating it if need be; running it twice adds them twice."""
    writer = df.write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def jdbc_options(df: DataFrame, url: str, table: str, batch_rows: int, connections: int) -> dict[str, str]:
    """Options for a batched JDBC write; types follow from the frame itself."""
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(connections),
    }
    if url.startswith("jdbc:postgresql:"):
        options["reWriteBatchedInserts"] = "true"
    return options


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batch_rows: int = JDBC_BATCH_ROWS,
    connections: int = 8,
    mode: str = "append",
) -> None:
    """Insert into a relational table from the executors, dots in names replaced."""
    out = sanitize(df)
    out.write.format("jdbc").options(**jdbc_options(out, url, table, batch_rows, connections)).mode(mode).save()


def bulk_jdbc(df: DataFrame, url: str, table: str, *, connections: int = 16) -> None:
    """``write_jdbc`` with large batches, for whole marts."""
    write_jdbc(df, url, table, batch_rows=BULK_BATCH_ROWS, connections=connections)


@dataclass
class Counted:
    """A frame that counts its rows while it is written."""

    df: DataFrame
    observation: Observation = field(repr=False)

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]


def counted(df: DataFrame) -> Counted:
    observation = Observation()
    return Counted(df.observe(observation, F.count(F.lit(1)).alias("rows")), observation)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of everything below a path, from the file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a dataset this library wrote for its own use."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored_copy(df: DataFrame, label: str) -> DataFrame:
    """The same rows, computed once and kept in the shared folder.

    Later jobs read the copy, so neither several uses nor a lost executor
    computes the rows again.
    """
    spark = df.sparkSession
    path = new_work_path(spark, label)
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def stored_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the ``batch=`` folders below a path whose writing was completed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(root)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path(root))]
    found = [n for n in names if n.startswith("batch=") and fs.exists(path(f"{root}/{n}/_SUCCESS"))]
    return sorted(int(n[6:]) for n in found)


def merge_sums(sums: DataFrame, root: str, keys: Sequence[str], batch: int) -> None:
    """Add a batch of sums per key to those stored below ``root``.

    One version is kept per batch: the last one and the batch give the next, so old input
    is not read again. A batch that is already in is left out, so a repeated run changes
    nothing. The version before is kept until the next batch.
    """
    spark = sums.sparkSession
    done = stored_versions(spark, root)
    if done and batch <= done[-1]:
        return
    if done:
        before = spark.read.schema(sums.schema).parquet(f"{root}/batch={done[-1]}")
        added = [F.sum(c(f.name)).cast(f.dataType).alias(f.name) for f in sums.schema if f.name not in keys]
        sums = before.unionByName(sums).groupBy(*cols(keys)).agg(*added)
    write_parquet(sums, f"{root}/batch={batch}")
    for old in done[:-1]:
        remove(spark, f"{root}/batch={old}")


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """The last version of stored sums."""
    return spark.read.parquet(f"{root}/batch={stored_versions(spark, root)[-1]}")


def drop_copy(copy: DataFrame) -> None:
    """Delete a stored copy nobody reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in copy.inputFiles()}:
        remove(copy.sparkSession, path)


def table_info(spark: SparkSession, path: str) -> dict:
    """Row count, columns with types, and size of a stored dataset."""
    df = spark.read.parquet(path)
    return {
        "row_count": df.count(),
        "columns": df.dtypes,
        "size_mb": round(stored_bytes(spark, path) / 1024**2, 2),
    }


def table_info_frame(spark: SparkSession, path: str) -> DataFrame:
    """The same facts as a frame: one row per column with the dataset's row count."""
    df = spark.read.parquet(path)
    described = [
        F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.lit(i).alias("position"))
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count("*").alias("row_count"), F.lit(0).alias("__one")).select(
        "row_count", F.inline(F.array(*described))
    )
