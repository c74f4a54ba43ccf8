from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from polfin.plans import dimensions as d
from polfin.plans import quality as q
from polfin.sources.readers import read_terms

PEOPLE = (
    "bioguide_id string, last_name string, first_name string, full_name string, birthday string, gender string, "
    "type string, state string, party string, icpsr_id string, fec_ids string, opensecrets_id string"
)
CURRENT = [
    ("K000110", "Kowal", "Mina", "Mina Kowal", "1961-08-09", "F", "rep", "OR", "D", "20411", "H2OR03077,S8OR00051", "N00910"),
    ("L000220", "Lund", "Per", "Per Lund", "1974-12-01", "M", "sen", "MN", "R", "20988", "", "N00911"),
    ("P000330", "Pike", "Rosa", "Rosa Pike", "1983-02-17", "F", "rep", "NV", "I", None, "H0NV01044", None),
]
HISTORICAL = [
    ("Q000440", "Quist", "Ole", "Ole Quist", "1931-06-30", "M", "rep", "ND", "D", "15077", "H6ND00021", "N00913"),
    ("K000110", "Kowal", "Mina", "M. Kowal", "1961-08-09", "F", "sen", "OR", "D", "20411", "H2OR03077", None),
    ("R000550", "Rowe", "Ada", "Ada Rowe", "1927-04-04", "F", "sen", "DE", "R", "15210", "", None),
]


def failures(report):
    return {r["check"] for r in report.where("NOT passed").collect()}


@pytest.fixture(scope="module")
def sources(spark):
    return spark.createDataFrame(CURRENT, PEOPLE), spark.createDataFrame(HISTORICAL, PEOPLE)


@pytest.fixture(scope="module")
def unified(sources):
    return d.unified_legislators(*sources).cache()


def test_unified(unified):
    assert unified.columns == list(d.UNIFIED_COLUMNS)
    assert dict(unified.dtypes)["icpsr"] == "bigint" and dict(unified.dtypes)["fec_ids"] == "array<string>"
    people = {r["bioguide_id"]: r for r in unified.collect()}
    assert sorted(people) == ["K000110", "L000220", "P000330", "Q000440", "R000550"]
    both = people["K000110"]
    assert (both["full_name"], both["type"], both["is_current"]) == ("Mina Kowal", "rep", True)
    assert both["fec_ids"] == ["H2OR03077", "S8OR00051"] and both["icpsr"] == 20411
    assert people["L000220"]["fec_ids"] == [] and people["P000330"]["icpsr"] is None
    assert {k for k, v in people.items() if not v["is_current"]} == {"Q000440", "R000550"}


def test_unified_ignores_blank_ids(spark, sources):
    blank = spark.createDataFrame([(None, *CURRENT[0][1:]), ("", *CURRENT[0][1:])], PEOPLE)
    assert d.unified_legislators(sources[0].unionByName(blank), sources[1]).count() == 5


TERMS = {
    "current": [
        {"id": {"bioguide": "K000110"}, "terms": [{"type": "rep", "start": "1999-01-06", "end": "2001-01-03"},
                                                   {"type": "rep", "start": "2001-01-03", "end": "2003-01-03"}]},
        {"id": {"bioguide": "L000220"}, "terms": [{"type": "sen", "start": "2013-01-03", "end": "2019-01-03"}]},
    ],
    "historical": [
        {"id": {"bioguide": "S000001"}, "terms": []},
        {"id": {"bioguide": "P000330"}, "terms": [{"type": "rep", "start": "1983-01-03", "end": "1989-01-03"}]},
        {"id": {"bioguide": "S000002"}},
        {"id": {"bioguide": "S000003"}, "terms": [{"start": "2009-01-06", "end": "someday"}]},
        {"id": {"bioguide": "Q000440"}, "terms": [{"type": "rep", "start": "1967-01-10", "end": "1973-01-03"}]},
        {"terms": [{"start": "2009-01-06"}]},
        {"id": {"bioguide": "K000110"}, "terms": [{"type": "sen", "start": "1995-01-04", "end": "1997-01-03"}]},
        {"id": {}, "terms": [{"start": "2009-01-06", "end": "2011-01-03"}]},
        {"id": {"bioguide": ""}, "terms": [{"start": "2009-01-06"}]},
        {"id": {"bioguide": "S000004"}, "terms": [{}, {"start": "2009-01-06", "end": ""}]},
    ],
}


@pytest.fixture(scope="module")
def terms(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("terms")
    for name, content in TERMS.items():
        (folder / f"{name}.json").write_text(json.dumps(content, indent=1))
    return read_terms(spark, *[str(folder / f"{n}.json") for n in TERMS])


def test_terms(terms):
    assert terms.count() == 12
    found = {r["bioguide_id"]: r["max_congress"] for r in d.max_congress(terms).collect()}
    assert found == {"K000110": 108, "L000220": 116, "P000330": 101, "Q000440": 93, "S000004": 111}
    assert {r[0] for r in d.eligible_people(d.max_congress(terms), 96).collect()} == set(found) - {"Q000440"}
    assert tuple(d.congress_stats(d.max_congress(terms)).first()) == (5, 93, 116)


def test_no_terms_give_empty_stats(terms):
    assert tuple(d.congress_stats(d.max_congress(terms.where("false"))).first()) == (0, None, None)


def test_unified_with_terms(sources, terms):
    kept = {r["bioguide_id"] for r in d.unified_legislators(*sources, terms, 96).collect()}
    assert kept == {"K000110", "L000220", "P000330"}


def test_unified_checks(spark, sources, unified):
    assert failures(q.check_unified_completeness(unified, (5, 5))) == set()
    assert failures(q.check_unified_completeness(unified)) == {"enough rows"}
    assert failures(q.check_unified_completeness(unified, (1, 4))) == {"not too many rows"}
    blank = unified.withColumn("bioguide_id", F.expr("IF(bioguide_id = 'R000550', NULL, bioguide_id)"))
    assert "blank key" in failures(q.check_unified_completeness(blank, (1, 9)))
    empty = unified.withColumn("bioguide_id", F.expr("IF(bioguide_id = 'R000550', '', bioguide_id)"))
    assert failures(q.check_unified_completeness(empty, (1, 9))) == {"blank key"}
    twice = unified.unionByName(unified.where("bioguide_id = 'R000550'"))
    assert failures(q.check_unified_completeness(twice, (1, 9))) == {"unique key"}
    assert failures(q.check_unified_coverage(unified)) == set()
    assert failures(q.check_unified_coverage(unified.where("false"))) >= {"not empty"}
    no_ids = unified.withColumn("fec_ids", F.array().cast("array<string>"))
    assert failures(q.check_unified_coverage(no_ids)) == {"fec_ids filled"}
    no_icpsr = unified.withColumn("icpsr", F.lit(None).cast("bigint"))
    assert failures(q.check_unified_coverage(no_icpsr)) == {"icpsr filled"}
    assert failures(q.check_unified_names(unified, *sources)) == set()
    assert failures(q.check_unified_names(unified, *sources, sample=3, seed=1)) == set()
    renamed = unified.withColumn("last_name", F.expr("IF(bioguide_id = 'Q000440', 'Other', last_name)"))
    assert failures(q.check_unified_names(renamed, *sources)) == {"same name"}
    stranger = unified.withColumn("bioguide_id", F.expr("IF(bioguide_id = 'Q000440', 'Z', bioguide_id)"))
    assert failures(q.check_unified_names(stranger, *sources)) == {"found in source"}


MEMBERS = (
    "bioguide_id string, congress smallint, chamber string, icpsr int, bioname string, state_abbrev string, "
    "party_code double, nominate_dim1 double, nominate_dim2 double"
)


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame(
        [
            ("A", 97, "House", 1, "OLD", "MA", 100.0, 0.5, 0.1),
            ("A", 99, "House", 2, "NEW", "NY", 200.0, None, 0.2),
            ("A", 99, "Senate", 3, "NEWER", "NJ", 328.0, None, 0.3),
            ("A", 90, "House", 1, "ANCIENT", "MA", 100.0, 0.9, 0.9),
            ("B", 96, "House", 4, "BEE", "CA", 100.0, 0.7, 0.4),
            (None, 100, "President", 5, "NOBODY", "USA", 100.0, 0.0, 0.0),
        ],
        MEMBERS,
    )


def test_distinct_legislators(members):
    people = {r["bioguide_id"]: r for r in d.distinct_legislators(members).collect()}
    assert sorted(people) == ["A", "B"]
    a = people["A"]
    # Both chambers in one Congress: all values come from the same row, and a NULL
    # score of the latest row is not replaced by an older one.
    assert (a["icpsr"], a["bioname"], a["state_abbrev"], a["party_code"]) == (3, "NEWER", "NJ", 328.0)
    assert a["nominate_dim1"] is None and a["nominate_dim2"] == 0.3
    assert a["congresses_served"] == [97, 99, 99]
    assert (a["first_congress"], a["last_congress"]) == (97, 99)
    types = dict(d.distinct_legislators(members).dtypes)
    assert types["congresses_served"] == "array<smallint>" and types["first_congress"] == "smallint"
    assert types["icpsr"] == "int"


def test_distinct_checks(spark, members):
    from polfin.plans.pipelines import distinct_report

    out = d.distinct_legislators(members).cache()
    assert failures(distinct_report(members, out, 96)) == set()
    assert failures(q.check_distinct_completeness(members, out.where("bioguide_id = 'A'"), 96)) == {"row_count", "missing"}
    twice = out.unionByName(out.where("bioguide_id = 'A'"))
    assert failures(q.check_distinct_completeness(members, twice, 96)) == {"row_count", "duplicates"}
    stranger = out.withColumn("bioguide_id", F.expr("IF(bioguide_id = 'A', 'Z', bioguide_id)"))
    assert failures(q.check_distinct_completeness(members, stranger, 96)) == {"missing", "extra"}
    late = out.withColumn("first_congress", F.lit(98).cast("smallint"))
    assert failures(q.check_distinct_aggregates(members, late, 96)) == {"first_congress"}
    short = out.withColumn("congresses_served", F.slice("congresses_served", 1, 1))
    assert failures(q.check_distinct_aggregates(members, short, 96)) == {"congresses_served length"}
    assert failures(q.check_distinct_lists(members, short, 96)) == {"list contents"}
    backwards = out.withColumn("congresses_served", F.reverse("congresses_served"))
    assert failures(q.check_distinct_lists(members, backwards, 96)) == {"list order"}
    renamed = out.withColumn("bioname", F.lit("OLD"))
    assert failures(q.check_distinct_latest(members, renamed, 96)) == {"latest bioname"}


RECIPIENTS = "ICPSR string, `bonica.rid` string, name string, party string, state string, seat string, `FEC.ID` string"
RECIPIENT_ROWS = [
    ("50332008", "east", "Tom Reed", "D", "HI", "federal:senate", "C79"),
    ("50332012", "west", "Tom Reed", "D", "HI", "federal:senate", "C80"),
    ("50332014", "gulf", "T. Reed", "I", "HI", "state:governor", None),
    ("411121996", "north", "Vera Stone", "I", "AK", "state:lower", "C77"),
    ("411121998", "north", "Vera Stone", "I", "AK", "state:lower", "C77"),
    ("411122002", "south", "Vera Stone", "R", "AK", "federal:house", "C78"),
    ("2008", "bay", "Year alone", None, None, None, None),
    (None, "cape", "No id", None, None, None, None),
    ("", "cove", "Empty id", None, None, None, None),
    ("70012000", "", "Blank key", None, None, None, None),
    ("70012000", None, "No key", None, None, None, None),
]


@pytest.fixture(scope="module")
def recipients(spark):
    return spark.createDataFrame(RECIPIENT_ROWS, RECIPIENTS)


def test_crosswalk(recipients):
    rows = d.crosswalk(recipients).collect()
    assert {(r["icpsr"], r["bonica_rid"]) for r in rows} == {
        ("5033", "east"), ("5033", "west"), ("5033", "gulf"), ("41112", "north"), ("41112", "south"),
    }
    assert len(rows) == 5
    assert d.crosswalk_ratio(d.crosswalk(recipients)).first()[0] == 2.5
    assert d.crosswalk_ratio(d.crosswalk(recipients.where("false"))).first()[0] is None


def test_crosswalk_checks(recipients):
    out = d.crosswalk(recipients)
    assert failures(q.check_crosswalk_counts(recipients, out)) == set()
    assert "not empty" in failures(q.check_crosswalk_counts(recipients, out.where("false")))
    no_icpsr = out.withColumn("icpsr", F.expr("IF(bonica_rid = 'north', NULL, icpsr)"))
    assert failures(q.check_crosswalk_counts(recipients, no_icpsr)) == {"icpsr filled"}
    no_rid = out.withColumn("bonica_rid", F.expr("IF(bonica_rid = 'north', '', bonica_rid)"))
    assert failures(q.check_crosswalk_counts(recipients, no_rid)) == {"bonica_rid filled"}
    twice = out.unionByName(out.where("bonica_rid = 'north'"))
    assert failures(q.check_crosswalk_counts(recipients, twice)) == {"row_count"}
    assert failures(q.check_crosswalk_unique(twice)) == {"unique pairs"}
    assert failures(q.check_crosswalk_unique(out)) == set()
    made_up = out.withColumn("bonica_rid", F.expr("IF(bonica_rid = 'north', 'nowhere', bonica_rid)"))
    assert failures(q.check_crosswalk_pairs(recipients, made_up)) == {"pairs in source"}
    assert failures(q.check_crosswalk_pairs(recipients, out, sample=2)) == set()
