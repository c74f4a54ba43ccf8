from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from polfin.catalog import q_jobs
from polfin.functions.columns import cols
from polfin.operators.linking import link_table
from polfin.operators.predicates import AmountBetween, CycleBetween, CycleIn, federal_races
from polfin.plans import marts, pipelines, quality
from polfin.sources import readers, sinks
from polfin.streaming import incremental
from tests.test_marts import CONTRIBUTIONS, PEOPLE, RECIPIENTS, ROWS, with_recipient_columns


@pytest.fixture
def facts(spark):
    base = with_recipient_columns(spark.createDataFrame(ROWS, CONTRIBUTIONS)).withColumn("seat", F.lit("federal:house"))
    later = base.withColumn("cycle", F.lit(2022)).withColumn("amount", F.col("amount") * 2)
    return base.unionByName(later)


@pytest.fixture
def root(facts, tmp_path):
    path = str(tmp_path / "contributions")
    sinks.write_cycles(facts, path)
    return path


def counts(spark, path):
    return {r["cycle"]: r["rows"] for r in pipelines.rows_per_cycle(readers.read_cycles(spark, path)).collect()}


def test_layout_and_info(spark, root):
    assert readers.existing_cycles(spark, root) == [2020, 2022]
    assert readers.existing_cycles(spark, root + "-none") == []
    info = sinks.table_info(spark, root)
    assert info["row_count"] == 8 and ("amount", "double") in info["columns"] and info["size_mb"] >= 0
    assert sinks.stored_bytes(spark, root) > 0
    assert sinks.table_info_frame(spark, root).where("column = 'amount' AND row_count = 8").count() == 1
    assert ".zstd.parquet" in spark.read.parquet(root).inputFiles()[0]


def test_rewriting_a_cycle_leaves_the_others(spark, root, facts):
    sinks.write_cycles(facts.where("cycle = 2020 AND amount > 400"), root)
    assert counts(spark, root) == {2020: 3, 2022: 4}


def test_clustered_files_are_sorted(spark, facts, tmp_path):
    path = str(tmp_path / "clustered")
    sinks.write_clustered(facts, path)
    assert spark.read.parquet(path).where("`bonica.rid` = 'birch'").count() == 4


def test_clustered_files_hold_ranges(spark, tmp_path):
    path = str(tmp_path / "ranges")
    rows = spark.range(4000).select(
        F.lit(2020).alias("cycle"), F.format_string("r%04d", F.col("id") % 1000).alias("bonica.rid"), F.col("id").cast("string").alias("bonica.cid")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or so few rows are one file
    try:
        sinks.write_clustered(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("`bonica.rid`").alias("low"), F.max("`bonica.rid`").alias("high"))
    spans = sorted((r["low"], r["high"]) for r in files.collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert spark.read.parquet(path).where("`bonica.cid` = '77'").count() == 1


def test_marts_for_all_cycles(spark, root, tmp_path):
    people = spark.createDataFrame(PEOPLE, "bioguide_id string, fec_ids array<string>, last_name string, first_name string")
    recipients = spark.createDataFrame(RECIPIENTS, "`bonica.rid` string, `recipient.name` string, ICPSR string")
    out = str(tmp_path / "marts")
    done = pipelines.build_marts(spark, root, out, [2018, 2020, 2022], recipients=recipients, legislators=people)
    assert set(done) == set(pipelines.MART_KINDS)
    for kind, result in done.items():
        assert (result.written, result.missing, result.skipped) == ([2020, 2022], [2018], [])
        assert counts(spark, f"{out}/{kind}") == {2020: 3, 2022: 3}
        assert result.report.where("NOT passed").count() == 0
    plain = pipelines.build_marts(spark, root, str(tmp_path / "plain"), [2020])
    assert set(plain) == {"organizational", "recipient_aggregates"}
    with pytest.raises(ValueError):
        pipelines.build_mart(spark, "organizational", root, out, [2019])
    with pytest.raises(ValueError):
        pipelines.mart("raw_organizational", spark.read.parquet(root))
    with pytest.raises(ValueError):
        pipelines.mart("other", spark.read.parquet(root))


def test_resume_skips_stored_cycles(spark, root, tmp_path):
    out = str(tmp_path / "resumed")
    pipelines.build_mart(spark, "organizational", root, out, [2020])
    before = readers.read_cycles(spark, out).inputFiles()
    second = pipelines.build_mart(spark, "organizational", root, out, [2020, 2022], skip_existing=True)
    assert (second.written, second.skipped) == ([2022], [2020])
    assert set(before) <= set(readers.read_cycles(spark, out).inputFiles())
    third = pipelines.build_mart(spark, "organizational", root, out, [2020, 2022], skip_existing=True)
    assert (third.written, third.skipped) == ([], [2020, 2022])
    # Without the option a second run replaces, and changes nothing.
    pipelines.build_mart(spark, "organizational", root, out, [2020, 2022])
    assert counts(spark, out) == {2020: 3, 2022: 3}


def test_subset_load(spark, root, tmp_path):
    path = str(tmp_path / "table")

    def append(df):
        sinks.append_table(df, "loaded_part", path)

    columns = ["cycle", "bonica.rid", "amount", "seat"]
    tests = [CycleIn([2016, 2020, 2022]), AmountBetween(low=500), federal_races()]
    done = pipelines.load_subset(spark, root, append, predicates=tests, columns=columns)
    assert (done.rows, done.cycles, done.missing_cycles) == (6, [2020, 2022], [2016])
    assert spark.table("loaded_part").columns == columns
    pipelines.load_subset(spark, root, append, predicates=tests, columns=columns)
    assert spark.table("loaded_part").count() == 12
    capped = []
    pipelines.load_subset(spark, root, lambda df: capped.append({r["cycle"]: r["count"] for r in df.groupBy("cycle").count().collect()}),
                          columns=columns, limit=5)
    assert capped == [{2020: 4, 2022: 1}]
    none = pipelines.load_subset(spark, root, append, predicates=[CycleIn([1999])], columns=columns)
    assert (none.rows, none.cycles, none.missing_cycles) == (0, [], [1999])


def test_cycles_are_those_on_disk(spark, facts, tmp_path):
    """A future cycle and an odd one count like any other."""
    path = str(tmp_path / "odd")
    odd = facts.withColumn("cycle", F.when(F.col("cycle") == 2020, 2026).otherwise(2023))
    sinks.write_cycles(odd, path)
    assert readers.query_cycles(spark, path, "SELECT * FROM contributions").count() == 8
    done = pipelines.load_subset(spark, path, lambda df: df.collect(), columns=["amount"])
    assert (done.rows, done.cycles, done.missing_cycles) == (8, [2023, 2026], [])
    done = pipelines.load_subset(spark, path, lambda df: df.collect(), predicates=[CycleBetween(2024, 2030)], columns=["amount"])
    assert (done.rows, done.cycles) == (4, [2026])
    sent = pipelines.publish({"organizational": marts.organizational(odd)}, lambda df, name: df.collect(), datasets="organizational")
    assert sent == {"organizational": 6}
    with pytest.warns(UserWarning, match="2020"):
        pipelines.publish({"organizational": odd}, lambda df, name: df.collect(), datasets="organizational", cycles=[2020, 2023])
    built = pipelines.build_mart(spark, "organizational", path, str(tmp_path / "mart"))
    assert built.written == [2023, 2026]


def test_failed_cycle_is_built_again(spark, root, tmp_path, monkeypatch):
    out = str(tmp_path / "failing")
    monkeypatch.setattr(pipelines, "mart", lambda kind, rows, *_: rows)  # individuals stay in
    with pytest.raises(quality.QualityError):
        pipelines.build_mart(spark, "organizational", root, out, [2020])
    monkeypatch.undo()
    assert readers.existing_cycles(spark, out) == []
    again = pipelines.build_mart(spark, "organizational", root, out, [2020], skip_existing=True)
    assert (again.written, again.skipped) == ([2020], []) and counts(spark, out) == {2020: 3}
    assert len([p for p in (tmp_path / "failing" / "_data").iterdir() if not p.name.startswith(".")]) == 1


def test_emptied_cycle_is_gone(spark, facts, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    sinks.write_cycles(facts, source)
    pipelines.build_mart(spark, "organizational", source, out)
    assert counts(spark, out) == {2020: 3, 2022: 3}
    sinks.write_cycles(facts.where("cycle = 2020").withColumn("contributor.type", F.lit("I")), source)
    pipelines.build_mart(spark, "organizational", source, out)
    assert counts(spark, out) == {2022: 3}
    sinks.write_cycles(facts.where("cycle = 2020 AND amount < 0"), source, cycles=[2020, 2022])
    assert readers.existing_cycles(spark, source) == []


def test_linked_mart_with_double_pairs_passes(spark, root, tmp_path):
    schema = "bioguide_id string, fec_ids array<string>, last_name string, first_name string"
    shared = spark.createDataFrame([*PEOPLE, ("ZZ", [i for p in PEOPLE for i in p[1] or []], "Twin", "Toni")], schema)
    recipients = spark.createDataFrame(RECIPIENTS, "`bonica.rid` string, `recipient.name` string, ICPSR string")
    out = str(tmp_path / "double")
    done = pipelines.build_mart(spark, "organizational", root, out, [2020], recipients=recipients, legislators=shared)
    assert counts(spark, out)[2020] > 4 and done.report.where("NOT passed").count() == 0 and done.warnings == []


def test_source_without_individuals_passes_with_a_warning(spark, facts, tmp_path):
    source = str(tmp_path / "corporate")
    sinks.write_cycles(marts.organizational(facts), source)
    done = pipelines.build_mart(spark, "organizational", source, str(tmp_path / "out"))
    assert done.written == [2020, 2022] and len(done.warnings) == 1


def test_subset_without_the_cycle_column(spark, root):
    rows = pipelines.subset(spark.read.parquet(root), columns=["amount"], limit=5)
    assert rows.columns == ["amount"] and rows.count() == 5


def test_query_over_cycles(spark, root):
    sql = 'SELECT cycle, COUNT(*) AS n FROM contributions GROUP BY cycle'
    assert [tuple(r) for r in readers.query_cycles(spark, root, sql, [2022]).collect()] == [(2022, 4)]
    assert readers.query_cycles(spark, root, sql).count() == 2


def test_publish(spark, facts):
    sent = {}

    def sink(df, table):
        sent[table] = df.collect()

    frames = {
        "organizational": marts.organizational(facts),
        "recipient_aggregates": marts.recipient_aggregates(facts),
        "crosswalk": spark.range(7),
        "legislators": spark.range(3),
    }
    done = pipelines.publish(frames, sink, datasets=["all"], cycles=[2020, 2022], limit=4)
    assert done == {"legislators": 3, "crosswalk": 7, "organizational": 4, "recipient_aggregates": 4}
    assert {r["cycle"] for r in sent["organizational"]} == {2020, 2022}
    assert sent["recipient_aggregates"][0].__fields__[:2] == ["cycle", "bonica_rid"]
    done = pipelines.publish(frames, sink, datasets="organizational", cycles=[2022], tables={"organizational": "org"})
    assert done == {"organizational": 3} and len(sent["org"]) == 3
    assert pipelines.dataset_names("all") == list(pipelines.PUBLISHED_BY_DEFAULT)
    assert pipelines.dataset_names(["all", "legislators_unified"])[-1] == "legislators_unified"
    with pytest.raises(ValueError):
        pipelines.dataset_names(["everything"])


def test_publish_query_sends_all_rows(spark, tmp_path):
    """More rows than the cap that the query had; a cycle may be NULL."""
    n, day = 12_000, F.lit("1996-05-10").cast("timestamp")
    tables = {
        "nation": spark.range(1).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")),
        "customer": spark.range(1).selectExpr("id AS c_custkey", "'C' AS c_name", "0 AS c_nationkey", "1.0D AS c_acctbal", "'MACHINERY' AS c_mktsegment"),
        "supplier": spark.range(6_000).selectExpr("id AS s_suppkey", "'S' || id AS s_name", "0 AS s_nationkey", "1.0D AS s_acctbal"),
        "orders": spark.range(n).select(
            F.col("id").alias("o_orderkey"), F.lit(0).cast("bigint").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
            F.when(F.col("id") % 10 > 0, day).alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(n).select(
            F.col("id").alias("l_orderkey"), F.lit(0).cast("bigint").alias("l_partkey"), (F.col("id") % 6_000).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
            F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
            F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
        "events": spark.range(20).select(
            F.col("id").alias("event_id"), day.alias("ts"), F.col("id").alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit("{}").alias("props")
        ),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    sent = {}
    found = q_jobs._publish(spark, str(tmp_path), lambda df, name: sent.update({name: df.count()}))
    assert {r["dataset"]: r["rows"] for r in found.collect()} == sent
    assert sent["organizational"] == n and sent["recipient_aggregates"] == 6_000


def test_jdbc_options(facts):
    options = sinks.jdbc_options(facts, "jdbc:postgresql://host/db", "t", 100_000, 16)
    assert options["batchsize"] == "100000" and options["numPartitions"] == "16"
    assert options["reWriteBatchedInserts"] == "true"
    assert "reWriteBatchedInserts" not in sinks.jdbc_options(facts, "jdbc:other:x", "t", 1, 1)


def test_incremental_runs(spark, root, facts, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.read.parquet(root).schema

    def run():
        incremental.organizational_stream(incremental.stream_parquet(spark, root, schema), out, state).awaitTermination()
        return counts(spark, out)

    assert run() == {2020: 3, 2022: 3}
    assert run() == {2020: 3, 2022: 3}
    sinks.write_cycles(facts.where("cycle = 2020").withColumn("cycle", F.lit(2024)), root)
    assert run() == {2020: 3, 2022: 3, 2024: 3}


def test_refreshed_aggregates(spark, root, facts, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    schema = spark.read.parquet(root).schema

    def run():
        stream = incremental.stream_parquet(spark, root, schema)
        incremental.refresh_aggregates(spark, stream, root, out, state).awaitTermination()
        rows = readers.read_cycles(spark, out).groupBy("cycle").agg(F.sum("total_amount").alias("t")).collect()
        return {r["cycle"]: r["t"] for r in rows}

    assert run() == {2020: 4640.0, 2022: 9280.0}
    more = facts.where("cycle = 2022").limit(1)
    amount = more.first()["amount"]
    more.write.mode("append").partitionBy("cycle").parquet(root)
    assert run() == {2020: 4640.0, 2022: 9280.0 + amount}


def test_distinct_rows_over_several_runs(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("source", "out", "state"))
    schema = "a string, b string, x double, t timestamp, cycle int"
    at = "2020-01-01 00:00:00."
    rows = [
        ("a", "bc", 0.0, at + "000001", 2020),
        ("ab", "c", -0.0, at + "000001", 2020),
        ("ab", "c", 0.0, at + "000001", 2020),  # equal to the row before
        ("ab", "c", 0.0, at + "000002", 2020),
        (None, "c", None, None, 2020),
        ("-", "c", None, None, 2020),
        ("", "c", float("nan"), None, 2022),
        ("", "c", float("nan"), None, 2022),
        ("1:a", "", 1.5, None, 2022),
    ]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    everything = None
    for part in (rows[:3], rows[1:6], [], rows[4:]):
        df = spark.createDataFrame(part, schema.replace("timestamp", "string")).withColumn("t", F.col("t").cast("timestamp"))
        everything = df if everything is None else everything.unionByName(df)
        df.write.mode("append").partitionBy("cycle").parquet(source)
        stream = incremental.stream_parquet(spark, source, df.schema)
        incremental.append_distinct(stream, lambda x: x, out, state, partitions=3).awaitTermination()
    found = spark.read.parquet(out).select(*everything.columns)
    assert found.count() == everything.distinct().count() == 7
    assert found.exceptAll(everything.distinct()).count() == 0
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")
    nested = spark.createDataFrame([([1],)], "x array<int>")
    with pytest.raises(ValueError, match="nested"):
        incremental.row_key(nested)


def test_linked_detail_over_several_runs(spark, facts, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("source", "out", "state"))
    people = spark.createDataFrame(PEOPLE, "bioguide_id string, fec_ids array<string>, last_name string, first_name string")
    recipients = spark.createDataFrame(RECIPIENTS, "`bonica.rid` string, `recipient.name` string, ICPSR string")
    for part in ("cycle = 2020", "true"):  # 2020 arrives twice
        facts.where(part).write.mode("append").partitionBy("cycle").parquet(source)
        stream = incremental.stream_parquet(spark, source, facts.schema)
        incremental.distinct_detail_stream(stream, link_table(recipients, people), out, state, partitions=2).awaitTermination()
    whole = marts.organizational_detail(facts, recipients, people)
    found = spark.read.parquet(out).select(*cols(whole.columns))
    assert found.count() == whole.count() > 0
    assert found.withColumn("cycle", F.col("cycle").cast("bigint")).exceptAll(whole).count() == 0
