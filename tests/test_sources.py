from __future__ import annotations

import gzip
import math

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from polfin.functions.columns import c
from polfin.plans import pipelines
from polfin.plans.quality import QualityError, check_checksums, check_row_count, check_rows, raise_for_status
from polfin.sources import readers, specs


def csv_line(values):
    return ",".join(values) + "\n"


def contribution(**given):
    """One raw line; names use ``_`` for dots and missing cells get the null marker."""
    cells = {n: "\\N" for n in specs.CONTRIBUTIONS.columns}
    cells.update({"cycle": "2020", "excluded.from.scaling": "0"})
    cells.update({k.replace("__", "."): v for k, v in given.items()})
    return csv_line(cells[n] for n in specs.CONTRIBUTIONS.columns)


@pytest.fixture
def messy(tmp_path):
    path = tmp_path / "contribDB_2020.csv.gz"
    lines = [
        csv_line(specs.CONTRIBUTIONS.columns),
        contribution(transaction__id="1", amount="10.5", contributor__name='"O""Neil, Tip"', contributor__zipcode="01234"),
        contribution(transaction__id="2", amount="-3", contributor__name='"two\nlines"', contributor__city="caf\xe9"),
        contribution(transaction__id="3", amount="nan", contributor__name='""', contributor__employer="Nan"),
        contribution(transaction__id="4", amount='""', contributor__name="", contributor__employer='"\\N"'),
        contribution(transaction__id="5", amount='"1e3"', contributor__cfscore="0.1234567", cycle='"2020"'),
    ]
    with gzip.open(path, "wt", encoding="latin-1", newline="") as f:
        f.writelines(lines)
    return str(path)


def test_counts_of_declared_columns():
    sizes = {n: len(s.columns) for n, s in specs.SPECS.items()}
    assert sizes == {
        "contributions": 45, "recipients": 65, "contributors": 43, "members": 22, "rollcalls": 18, "votes": 6,
        "legislators": 36,
    }
    assert len(specs.DEFAULT_CONTRIBUTION_COLUMNS) == 21
    assert set(specs.DEFAULT_CONTRIBUTION_COLUMNS) <= set(specs.CONTRIBUTIONS.columns)
    for spec in specs.SPECS.values():
        assert set(spec.key_columns) <= set(spec.columns)
        assert spec.sum_column is None or spec.sum_column in spec.columns


def test_messy_csv(spark, messy):
    rows = {r["transaction.id"]: r for r in readers.read_csv(spark, messy, specs.CONTRIBUTIONS).collect()}
    assert len(rows) == 5
    assert rows["1"]["contributor.name"] == 'O"Neil, Tip' and rows["1"]["contributor.zipcode"] == "01234"
    assert rows["2"]["contributor.name"] == "two\nlines" and rows["2"]["contributor.city"] == "caf\xe9"
    assert rows["2"]["amount"] == -3.0
    assert math.isnan(rows["3"]["amount"]) and rows["3"]["contributor.name"] is None
    assert rows["3"]["contributor.employer"] == "Nan"
    assert rows["4"]["amount"] is None and rows["4"]["contributor.name"] is None
    assert rows["4"]["contributor.employer"] is None
    assert rows["5"]["amount"] == 1000.0 and rows["5"]["cycle"] == 2020
    assert rows["1"]["recipient.name"] is None


def test_ingest_proves_its_output(spark, messy, tmp_path):
    out = str(tmp_path / "out")
    result = pipelines.ingest(spark, specs.CONTRIBUTIONS, messy, out)
    assert result.rows == 5
    checks = {r["check"]: r for r in result.report.collect()}
    assert all(r["passed"] for r in checks.values())
    assert checks["sum amount"]["actual"] == pytest.approx(1007.5)
    assert checks["nan amount"]["actual"] == 1.0
    assert checks["filled contributor.name"]["actual"] == 2.0
    stored = spark.read.parquet(out)
    assert stored.schema.names == specs.CONTRIBUTIONS.columns
    assert stored.count() == 5


@pytest.mark.parametrize(
    ("fault", "caught"),
    [
        (lambda df: df.where("`transaction.id` <> '2'"), {"row_count", "rows lost"}),
        (lambda df: df.withColumn("amount", F.col("amount") + 0.5), {"sum amount", "rows lost", "rows gained"}),
        (lambda df: df.withColumn("contributor.city", F.lit("x")), {"rows lost", "rows gained"}),
        (lambda df: df.withColumn("contributor.zipcode", F.ltrim(c("contributor.zipcode"), F.lit("0"))), {"rows lost"}),
        (
            lambda df: df.withColumn("contributor.state", c("contributor.city")).withColumn(
                "contributor.city", F.lit(None).cast("string")
            ),
            {"rows lost", "rows gained"},
        ),
    ],
)
def test_injected_faults_are_caught(spark, messy, fault, caught):
    raw = readers.read_csv_text(spark, messy, specs.CONTRIBUTIONS)
    good = readers.read_csv(spark, messy, specs.CONTRIBUTIONS)
    bad = fault(good)
    report = pipelines.conversion_report(raw, bad, specs.CONTRIBUTIONS)
    assert caught <= {r["check"] for r in report.where("NOT passed").collect()}
    with pytest.raises(QualityError):
        raise_for_status(report)


def test_values_equal_after_normalisation_pass(spark, messy):
    raw = readers.read_csv_text(spark, messy, specs.CONTRIBUTIONS)
    good = readers.read_csv(spark, messy, specs.CONTRIBUTIONS)
    touched = good.withColumn("amount", F.col("amount") + 1e-9).withColumn(
        "contributor.city", F.concat(c("contributor.city"), F.lit("  "))
    )
    assert check_rows(raw, touched, specs.CONTRIBUTIONS).where("NOT passed").count() == 0
    # A sampled comparison sees no more than the full one.
    assert check_rows(raw, touched, specs.CONTRIBUTIONS, keep_one_in=3).where("NOT passed").count() == 0


def test_swapped_neighbours_differ(spark):
    spec = specs.VOTES
    a = spark.createDataFrame([(1, 2.0, None, 1.0, None, "House")], spec.schema)
    b = spark.createDataFrame([(1, None, 2.0, 1.0, None, "House")], spec.schema)
    assert check_rows(a, b, spec).where("NOT passed").count() == 2


def test_wrong_columns_are_refused(spark, tmp_path):
    path = tmp_path / "votes.csv"
    path.write_text("congress,chamber,rollnumber,icpsr,cast_code\n1,House,1,1,1\n")
    with pytest.raises(readers.SchemaMismatch, match="prob"):
        readers.read_csv(spark, str(path), specs.VOTES)


def test_column_order_is_free(spark, tmp_path):
    path = tmp_path / "votes.csv"
    path.write_text("prob,cast_code,icpsr,rollnumber,chamber,congress\n,6,10713.0,4,House,117\nN/A,9,1,5,Senate,117\n")
    rows = readers.read_csv(spark, str(path), specs.VOTES).orderBy("rollnumber").collect()
    assert rows[0]["icpsr"] == 10713.0 and rows[0]["prob"] is None and rows[0]["congress"] == 117
    assert rows[1]["prob"] is None


@pytest.mark.parametrize("row", ["1,House,1,1", "1,House,1,1,1,0.5,7"])
def test_malformed_record_fails_even_a_count(spark, tmp_path, row):
    path = tmp_path / "votes.csv"
    path.write_text("congress,chamber,rollnumber,icpsr,cast_code,prob\n1,House,1,1,1,0.5\n" + row + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv_text(spark, str(path), specs.VOTES).count()
    rejects = readers.read_csv_rejects(spark, str(path), specs.VOTES).select("congress", "record").collect()
    assert [r["record"] for r in rejects] == [row]


def test_value_of_wrong_type_fails(spark, tmp_path):
    path = tmp_path / "votes.csv"
    path.write_text("congress,chamber,rollnumber,icpsr,cast_code,prob\nfirst,House,1,1,1,0.5\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        readers.read_csv(spark, str(path), specs.VOTES).collect()


def test_nan_does_not_hide_a_wrong_sum(spark):
    a = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "x double")
    b = spark.createDataFrame([(1.0,), (float("nan"),), (9.0,)], "x double")
    assert {r["check"] for r in check_checksums(a, b, "x", ["x"]).where("NOT passed").collect()} == {"sum x"}
    c_ = spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double")
    assert {r["check"] for r in check_checksums(a, c_, "x", ["x"]).where("NOT passed").collect()} == {"nan x", "filled x"}
    assert check_row_count(a, c_).first()["passed"]
