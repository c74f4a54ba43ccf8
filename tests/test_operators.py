from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from polfin.functions.columns import asc, c
from polfin.operators import joins, limits, sets
from polfin.plans import analytics, quality


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key, and a third of those are copies of one row."""
    rows = []
    for i in range(9000):
        key = "hot" if i % 3 == 0 else f"k{i % 200}"
        rows.append((key, 0 if i % 9 == 0 else i))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "`the.key` string, v int").repartition(16).cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_join_routes_agree(spark, skewed, how):
    lookup = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("k1", "c"), ("zzz", "d")], "`the.key` string, w string")
    small = joins.lookup_join(skewed, lookup, ["the.key"], how)
    large = joins.lookup_join(skewed, lookup, ["the.key"], how, max_bytes=-1)
    assert small.columns == large.columns
    assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_a_large_lookup_is_computed_once_and_not_multiplied(spark, skewed):
    lookup = spark.range(50).select(F.concat(F.lit("k"), "id").alias("the.key"), F.col("id").alias("number"))
    joined = joins.lookup_join(skewed, lookup, ["the.key"], "inner", max_bytes=-1)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parquet") == 1 and "Range (" not in plan and "explode" not in plan
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    keys = {f"k{i}" for i in range(50)}
    assert joined.count() == sum(r["the.key"] in keys for r in skewed.collect())


def test_distinct_rows_moves_only_repeated_ones(spark, skewed):
    wide = skewed.withColumn("w", F.concat("v", F.lit("-text"))).withColumn("z", F.when(F.col("v") % 2 == 0, 0.0).otherwise(-0.0))
    wide = wide.withColumn("n", F.when(F.col("v") == 0, F.lit(None).cast("string")).otherwise("x"))
    out = sets.distinct_rows(wide)
    plain = wide.distinct()
    assert out.count() == plain.count() == out.distinct().count()
    assert out.exceptAll(plain).count() == 0
    left = out._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "Aggregate" not in left


def test_measured_bytes(spark):
    df = spark.createDataFrame([("ab", None), (None, "c")], "x string, y string")
    assert joins.measured_bytes(df) == 2 * joins.ROW_OVERHEAD_BYTES + 3
    assert joins.measured_bytes(df.where("false")) == 0


def test_ranking_keeps_one_row_per_task_before_the_shuffle(spark, skewed):
    first = sets.first_per_key(skewed, ["the.key"], [asc("v")])
    found = {r["the.key"]: r["v"] for r in first.collect()}
    expected = {r["the.key"]: r["m"] for r in skewed.groupBy(c("the.key")).agg(F.min("v").alias("m")).collect()}
    assert found == expected
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("a", 3, "y"), ("b", None, "z")], "k string, n int, v string")
    rows = {r["k"]: (r["n"], r["v"]) for r in sets.latest_per_key(df, ["k"], "n").collect()}
    assert rows == {"a": (3, "y"), "b": (None, "z")}


def test_key_sets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "`a.k` string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "`a.k` string")
    counts = {r["a.k"]: (r["in_left"], r["in_right"]) for r in sets.key_counts(a, b, ["a.k"]).collect()}
    assert counts == {"x": (2, 0), "y": (1, 1), "z": (0, 1), None: (1, 1)}
    # A NULL key is not missing, and one on the right does not empty the result.
    assert [r[0] for r in sets.missing_keys(a, b, ["a.k"]).collect()] == ["x"]
    assert [tuple(r) for r in sets.duplicate_keys(a, ["a.k"]).collect()] == [("x", 2)]
    assert [r[0] for r in sets.difference(a, b).collect()] == ["x"]


@pytest.mark.parametrize("limit", [0, 1, 2999, 3000, 3001, 7500, 9000, 99_999])
def test_limit_fills_cycle_by_cycle(spark, skewed, limit):
    df = skewed.withColumn("cycle", F.when(F.col("v") % 2 == 0, 2020).otherwise(2022))
    sizes = {r["cycle"]: r["count"] for r in df.groupBy("cycle").count().collect()}
    out = limits.limit_by_cycle(df, limit, [2020, 2022, 2024]).cache()
    found = {r["cycle"]: r["count"] for r in out.groupBy("cycle").count().collect()}
    first = min(limit, sizes[2020])
    second = min(limit - first, sizes[2022])
    assert found == {k: v for k, v in {2020: first, 2022: second}.items() if v}
    assert out.exceptAll(df).count() == 0


@pytest.mark.parametrize("bits", [2, 16])
def test_limit_of_copies_is_exact_and_repeatable(spark, monkeypatch, bits):
    monkeypatch.setattr(limits, "LEVEL_BITS", bits)
    monkeypatch.setattr(limits, "COPIES_AT_ONCE", 100)
    rows = spark.range(5000).select(
        F.lit(2020).alias("cycle"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("v")
    )
    for limit in (1, 3333):
        out = limits.limit_by_cycle(rows, limit, [2020]).cache()
        assert out.count() == limit and out.exceptAll(rows).count() == 0
        again = limits.limit_by_cycle(rows.repartition(7), limit, [2020])
        assert again.count() == limit and again.exceptAll(out).count() == 0
        out.unpersist()


@pytest.mark.parametrize("bits", [2, 16])
def test_first_rows_of_files(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(limits, "LEVEL_BITS", bits)
    path = str(tmp_path / "facts")
    spark.range(900).select("id", F.lit("same").alias("x.y")).repartition(6).write.parquet(path)
    rows = spark.read.parquet(path).where("id % 3 < 2")
    last = set()
    for n in (0, 1, 99, 350, 600, 601):
        out = limits.first_rows(rows, n, positions=True)
        assert out.columns == rows.columns
        ids = {r["id"] for r in out.collect()}
        assert len(ids) == min(n, 600) and last <= ids and not any(i % 3 == 2 for i in ids)
        last = ids


def test_files_beyond_the_cut_are_not_read(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(800).repartition(8).write.parquet(path)
    out = limits.first_rows(spark.read.parquet(path), 100, positions=True)
    assert out.count() == 100
    plan = out._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
    out._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    read = [leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size())]
    assert read and max(read) < 8


def test_later_cycles_are_not_read(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).select((2020 + F.col("id") % 2 * 2).alias("cycle"), "id").write.partitionBy("cycle").parquet(path)
    out = limits.limit_by_cycle(spark.read.parquet(path), 50, [2020, 2022])
    assert {f.split("cycle=")[1][:4] for f in out.inputFiles()} == {"2020", "2022"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "2020" in plan and "2022" not in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("bits", [2, 16])
def test_samples_are_exact_at_every_size(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(limits, "LEVEL_BITS", bits)
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    on_disk = spark.read.parquet(path)
    for n in (0, 1, 4000, 20_000):
        for draw in (
            lambda: limits.sample_rows(rows, n, seed=1),
            lambda: limits.sample_keys(rows.unionByName(rows), ["k"], n, seed=1),
            lambda: limits.sample_rows(on_disk, n, seed=1, positions=True),
        ):
            drawn = draw()
            assert "TakeOrdered" not in drawn._jdf.queryExecution().executedPlan().toString()
            keys = {r["k"] for r in drawn.collect()}
            assert len(keys) == min(n, 20_000)
            if n == 4000:
                assert keys == {r["k"] for r in draw().collect()}
                # Uniform: the lower half holds about half of the sample.
                assert 1800 < sum(k < 10_000 for k in keys) < 2200


def test_copies_are_drawn_one_by_one_from_files(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(10_000).select((F.col("id") % 2).alias("k")).write.parquet(path)
    out = limits.sample_rows(spark.read.parquet(path), 1000, seed=5, positions=True)
    found = {r["k"]: r["count"] for r in out.groupBy("k").count().collect()}
    assert sum(found.values()) == 1000 and 400 < found[0] < 600


def test_samples(spark, skewed):
    assert limits.sample_rows(skewed, 50, seed=3).count() == 50
    keys = limits.sample_keys(skewed, ["the.key"], 10, seed=3)
    assert keys.count() == 10 and keys.distinct().count() == 10
    again = limits.sample_keys(skewed.repartition(5), ["the.key"], 10, seed=3)
    assert {r[0] for r in again.collect()} == {r[0] for r in keys.collect()}
    other = limits.sample_keys(skewed, ["the.key"], 10, seed=4)
    assert {r[0] for r in other.collect()} != {r[0] for r in keys.collect()}


def test_orphans_and_living_parents(spark):
    children = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id int, p string")
    parents = spark.createDataFrame([("b",), ("c",)], "pid string")
    assert [tuple(r) for r in quality.orphans(children, "p", parents, "pid").collect()] == [("a", 2)]
    assert [r["id"] for r in analytics.with_living_parents(children, "p", parents, "pid").collect()] == [3]


def test_constraints(spark):
    df = spark.createDataFrame([("1", "Yea", "b"), ("1", "Maybe", "x"), (None, None, None)], "id string, v string, p string")
    parents = spark.createDataFrame([("b",)], "pid string")
    rules = quality.Constraints(
        not_null=["id"], unique=[["id"]], allowed={"v": ["Yea", "Nay"]}, references={"p": (parents, "pid")}
    )
    found = {r["check"]: (r["passed"], r["actual"]) for r in quality.check_constraints(df, rules).collect()}
    assert found == {
        "null id": (False, 1.0), "allowed v": (False, 1.0), "unique id": (False, 1.0), "reference p": (False, 1.0),
    }


def test_link_check(spark):
    def report(linked, known):
        out = spark.createDataFrame([(x, 1.0) for x in linked], "bioguide_id string, amount double")
        people = spark.createDataFrame([(x,) for x in known], "bioguide_id string")
        return {r["check"]: (r["passed"], r["actual"]) for r in quality.check_links(out, people).collect()}

    good = report(["A", "B", None], ["A", "B", "C"])
    assert good["unknown persons"] == (True, 0.0) and good["matched rows"] == (True, 2.0)
    assert good["coverage"][1] == pytest.approx(66.67, abs=0.01)
    assert report(["A", "X", "Y"], ["A"])["unknown persons"] == (False, 2.0)
    assert report([None, None], ["A"])["coverage"][1] == 0.0
    assert report(["A"] + [None] * 9, ["A"])["coverage"][1] == pytest.approx(10.0)


def test_donor_totals(spark):
    donors = spark.createDataFrame([("a",), ("b",)], "donor_id string")
    gifts = spark.sql("SELECT 'a' AS donor_id, CAST(1.10 AS DECIMAL(14,2)) AS amount FROM range(3)")
    rows = {r["donor_id"]: (r["total_contributions_count"], str(r["total_amount"])) for r in analytics.donor_totals(donors, gifts).collect()}
    assert rows == {"a": (3, "3.30"), "b": (0, "0.00")}


def test_report_roll_up(spark):
    def rolled(**passed):
        rows = [(k, v, 0.0, 0.0) for k, v in passed.items()]
        checks = spark.createDataFrame(rows, "check string, passed boolean, expected double, actual double")
        return quality.mart_valid(checks).first()[0], quality.all_valid(checks).first()[0]

    assert rolled(row_count=True, filter=True) == (True, True)
    assert rolled(row_count=True, filter=False, aggregation=True) == (True, False)
    assert rolled(row_count=True) == (False, True)
    assert rolled(row_count=False, filter=True) == (False, False)
