"""What keeps time, memory and moved bytes in proportion to the tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.plans import pipelines, quality
from polfin.session import COMPILED_METHOD_BYTES
from polfin.sources import readers, sinks
from polfin.sources.specs import RECIPIENTS
from polfin.streaming import deltas, incremental

LIMIT = "spark.sql.codegen.hugeMethodLimit"
PIECES = "spark.sql.files.maxPartitionBytes"


def recipients(spark, n: int):
    rows = spark.range(n)
    cells = [F.concat(F.lit(f"{f.name} "), "id") if isinstance(f.dataType, T.StringType) else F.col("id").cast(f.dataType) for f in RECIPIENTS.schema]
    return rows.select(*[x.alias(f.name) for x, f in zip(cells, RECIPIENTS.schema)])


def test_wide_rows_are_compiled(spark):
    for step in (quality.row_fingerprint, quality.conversion_sums, quality.with_row_hash):
        spark.conf.set(LIMIT, 65535)
        step(recipients(spark, 1), RECIPIENTS)
        assert int(spark.conf.get(LIMIT)) == COMPILED_METHOD_BYTES


def test_differences_in_all_buckets(spark, monkeypatch):
    """Nothing is filtered then, and the result is the same as where a bucket is even."""
    source = recipients(spark, 300)
    output = source.withColumn("name", F.when(F.col("name").endswith("1"), F.lit("other")).otherwise(F.concat(F.lit("\xa0"), "name", F.lit(" "))))
    for buckets in (1, 4096):
        monkeypatch.setattr(quality, "SUM_BUCKETS", buckets)
        found = quality.row_differences(source, output, RECIPIENTS)
        plan = found._jdf.queryExecution().analyzed().toString()
        assert ("Join" in plan) == (buckets > 1)
        assert sorted((r.in_left, r.in_right) for r in found.collect()) == [(0, 1)] * 30 + [(1, 0)] * 30


def test_strip_at_both_ends(spark):
    texts = ["", " ", "a", " a", "a\t", "\x85a", "a\xa0", "\x1c a b\x1f", "\x01a", "é", "\xa0é\x85", "é\x00", "\x00 ", "!", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", quality.strip(F.col("t")))
    blanks = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
    assert [r[1] for r in got.orderBy("i").collect()] == [t if t is None else t.strip(blanks) for t in texts]


def test_even_compressed_files_stay_where_they_are(spark, tmp_path, monkeypatch):
    asked = []
    write = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda df, path, **more: (asked.append(df._jdf.queryExecution().analyzed().toString()), write(df, path, **more)))
    options = {"header": True, "encoding": "ISO-8859-1", "quote": '"', "escape": '"', "nullValue": "\\N", "compression": "gzip"}
    for files, spread in ((1, True), (24, False)):
        path = f"{tmp_path}/csv-{files}"
        recipients(spark, 480).repartition(files).write.options(**options).csv(path)
        assert readers.lopsided(spark, path) == spread
        assert pipelines.ingest(spark, RECIPIENTS, path, f"{tmp_path}/out-{files}", validate=False).rows == 480
        assert ("rebalance" in asked[-1].lower()) == spread


def test_streams_read_small_pieces(spark, tmp_path, monkeypatch):
    """One file is written by as many tasks as it has pieces."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    rows = spark.range(0, 60_000, 1, 1).select(F.col("id").cast("string").alias("name"), F.lit(2000).alias("cycle"))
    rows.write.option("parquet.block.size", 1 << 16).parquet(source)
    before = spark.conf.get(PIECES)
    monkeypatch.setattr(incremental, "PIECE_BYTES", 1 << 16)
    try:
        stream = incremental.stream_parquet(spark, source, rows.schema)
        incremental.append_new(stream, lambda df: df, out, f"{tmp_path}/state").awaitTermination()
        assert int(spark.conf.get(PIECES)) == 1 << 16
    finally:
        spark.conf.set(PIECES, before)
    stored = spark.read.parquet(out)
    assert stored.count() == 60_000 and len(stored.inputFiles()) > 1


def test_changes_are_made_once(spark, tmp_path, monkeypatch):
    """Both sums read stored rows, in small pieces; the summary follows what came and went."""
    seen = []
    run = deltas._apply
    monkeypatch.setattr(deltas, "_apply", lambda s, root, rows, *rest: (seen.append((len(rows.inputFiles()) > 0, int(s.conf.get(PIECES)))), run(s, root, rows, *rest))[1])
    kind = "recipient_id string, industry string, donor_id string, amount int, __weight int"
    gifts = [("p", "A", "d", 1, 1), ("p", "A", "d", 2, 1), ("p", None, None, None, 1), (None, "A", "e", 4, 1)]
    for batch, rows in enumerate((gifts, [("p", "A", "d", 2, -1)])):
        for _again in range(2):
            deltas.change_summary(spark, str(tmp_path), spark.createDataFrame(rows, kind).withColumn("amount", F.col("amount").cast("decimal(14,2)")), batch)
    assert seen == [(True, deltas.PIECE_BYTES)] * 4
    found = deltas.changed_summary(spark, str(tmp_path))
    assert {(r[0], r[1], r[2], r[3] and float(r[3]), r[5]) for r in found.collect()} == {("p", "A", 1, 1.0, 1), ("p", None, 1, None, 0), (None, "A", 1, 4.0, 1)}
