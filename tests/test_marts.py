from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from polfin.functions.columns import c
from polfin.operators.linking import link, link_table, recipients_with_person
from polfin.plans import marts

CONTRIBUTIONS = (
    "cycle int, `bonica.rid` string, `recipient.name` string, `contributor.name` string, `contributor.type` string, "
    "`bonica.cid` string, amount double, date string, `contributor.state` string"
)
ROWS = [
    (2020, "alder", "Alder for Mayor", "Dockworkers Local 7", "U", "g1", 750.0, "2020-02-03", "OR"),
    (2020, "birch", "Birch Committee", "Quarry Fund", "P", "g2", 1200.0, "2020-05-30", "UT"),
    (2020, "birch", "Birch Committee", "Ines Okafor", "I", "g3", 90.0, "2019-11-09", "ME"),
    (2020, "cedar", "Cedar Now", "Brickworks Inc", "C", "g4", 2600.0, "2020-08-17", "OR"),
]
PEOPLE = [("M100", ["H9OR07001"], "Moss", "Ada"), ("M200", ["S1UT00450"], "Nunez", "Leo"), ("M300", None, "Orr", "Kim"),
          ("M400", [], "Pell", "Uma")]
RECIPIENTS = [
    ("alder", "Alder for Mayor", "H9OR070012020"),
    ("birch", "Birch Committee", "S1UT004502020"),
    ("cedar", "Cedar Now", "town777"),
]


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(ROWS, CONTRIBUTIONS)


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "bioguide_id string, fec_ids array<string>, last_name string, first_name string")


@pytest.fixture(scope="module")
def recipients(spark):
    return spark.createDataFrame(RECIPIENTS, "`bonica.rid` string, `recipient.name` string, ICPSR string")


def persons(df):
    return {r["bonica.rid"]: r["bioguide_id"] for r in df.collect()}


def test_detail_mart_links_people(facts, recipients, people):
    out = marts.organizational_detail(facts, recipients, people)
    assert out.columns == ["bioguide_id", *marts.DETAIL_COLUMNS]
    assert dict(out.dtypes)["cycle"] == "bigint"
    assert persons(out) == {"alder": "M100", "birch": "M200", "cedar": None}
    assert out.count() == 3 and out.where("contributor_type = 'I'").count() == 0


def test_plain_organizational_mart_moves_nothing(facts):
    out = marts.organizational(facts)
    assert out.count() == 3 and out.columns == facts.columns
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_unknown_type_counts_as_neither(spark):
    rows = [(2020, "r", None, "x", t, "c", a, "", "") for t, a in [("I", 1.0), ("C", 2.0), (None, 4.0), ("I", None)]]
    df = with_recipient_columns(spark.createDataFrame(rows, CONTRIBUTIONS))
    r = marts.recipient_aggregates(df).first()
    assert (r["total_amount"], r["contribution_count"]) == (7.0, 4)
    assert r["avg_amount"] == pytest.approx(7 / 3)
    assert (r["individual_total"], r["individual_count"]) == (1.0, 2)
    assert (r["organizational_total"], r["organizational_count"]) == (2.0, 1)
    assert marts.organizational(df).count() == 1


def with_recipient_columns(df):
    for n in marts.RECIPIENT_KEY:
        if n not in df.columns:
            kind = "double" if n == "candidate.cfscore" else "string"
            df = df.withColumn(n, F.lit(None).cast(kind))
    return df


def test_group_of_null_amounts(spark):
    rows = [(2020, "r", "n", "x", "P", "c", None, "", "")] * 2
    r = marts.recipient_aggregates(with_recipient_columns(spark.createDataFrame(rows, CONTRIBUTIONS))).first()
    assert r["total_amount"] is None and r["avg_amount"] is None and r["contribution_count"] == 2
    assert r["individual_total"] == 0.0 and r["individual_count"] == 0
    assert r["organizational_total"] == 0.0 or r["organizational_total"] is None
    assert r["organizational_count"] == 2


def test_cycles_are_kept_apart_and_null_recipients_dropped(spark):
    rows = [(y, rid, "n", "x", "P", "c", 1.0, "", "") for y, rid in [(2020, "r"), (2022, "r"), (2020, None)]]
    df = with_recipient_columns(spark.createDataFrame(rows, CONTRIBUTIONS))
    assert marts.recipient_aggregates(df).count() == 2
    assert marts.recipient_aggregates(df, by_cycle=False).first()["contribution_count"] == 2


@pytest.fixture(scope="module")
def shared(spark):
    """One recipient linked in some years only, and shared by two people."""
    return spark.createDataFrame(
        [("alder", "n", x) for x in ("H9OR070012020", "H9OR070012014", "S1UT004502010", "town1992")]
        + [("dogwood", "n", "town1992"), ("elm", "n", None), ("fir", "n", "2020")],
        "`bonica.rid` string, `recipient.name` string, ICPSR string",
    )


def test_fan_out(facts, shared, people):
    pairs = {tuple(r) for r in recipients_with_person(shared, people).collect()}
    assert pairs == {("alder", "M100"), ("alder", "M200"), ("alder", None), ("dogwood", None)}
    assert {r["bonica.rid"] for r in link_table(shared, people).collect()} == {"alder"}
    assert link(facts, shared, people).where(c("bonica.rid") == "alder").count() == 3
    best = link(facts, shared, people, "best")
    assert best.count() == 4
    assert persons(best)["alder"] == "M100" and persons(best)["birch"] is None
    with pytest.raises(ValueError):
        link_table(shared, people, "first")


def test_distinct_before_link_equals_distinct_after(spark, facts, shared, people):
    doubled = facts.unionByName(facts)
    mart = marts.organizational(doubled, shared, people)
    naive = (
        doubled.where(c("contributor.type") != "I")
        .join(recipients_with_person(shared, people), ["bonica.rid"], "left")
        .distinct()
        .select(*[c(n) for n in mart.columns])
    )
    assert mart.exceptAll(naive).count() == 0 and naive.exceptAll(mart).count() == 0
    assert marts.organizational(doubled, shared, people, distinct=False).count() == 2 * mart.count()


def test_single_cycle_frame(facts):
    out = marts.with_cycle(marts.recipient_aggregates(with_recipient_columns(facts), by_cycle=False), 2020)
    assert out.columns[0] == "cycle" and {r["cycle"] for r in out.collect()} == {2020}
