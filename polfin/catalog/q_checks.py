"""Queries over the checks, most of them with faults put in on purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.q_joins import people, recipients
from polfin.catalog.registry import money, money_sql, query
from polfin.catalog.standins import load, select
from polfin.catalog.stored import contributions_root
from polfin.functions.columns import c
from polfin.plans import dimensions, marts, pipelines, quality
from polfin.sources.specs import CONTRIBUTIONS


def check_sql(*checks: tuple[str, str, str, str], source: str) -> str:
    """Report rows over one row of facts: (name, passed, expected, actual)."""
    rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", {passed} AS passed, CAST({expected} AS DOUBLE) AS expected,
            CAST({actual} AS DOUBLE) AS actual FROM facts"""
        for name, passed, expected, actual in checks
    )
    return f"WITH facts AS ({source}) {rows}"


def zero_sql(name: str, fact: str) -> tuple[str, str, str, str]:
    return name, f"{fact} = 0", "0", fact


def settled(report: DataFrame) -> DataFrame:
    """Report with its sums rounded to cents."""
    return report.select("check", "passed", money("expected").alias("expected"), money("actual").alias("actual"))


@query(
    "v01_row_count",
    check_sql(
        ("row_count", "a = b", "a", "b"),
        source="""SELECT COUNT(*) AS a, COUNT(*) FILTER ("contributor.type" <> 'I') AS b FROM contributions""",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["contributor.type"])
    return quality.check_row_count(rows, marts.organizational(rows))


@query(
    "v02_checksums",
    check_sql(
        ("sum amount", "a = b", "a", "b"),
        ("nan amount", "TRUE", "0", "0"),
        ("filled transaction.id", "n = m", "n", "m"),
        ("filled date", "n = m", "n", "m"),
        source=f"""SELECT {money_sql("SUM(amount)")} AS a, {money_sql("SUM(amount) FILTER (cycle <> 1996)")} AS b,
                   COUNT(*) AS n, COUNT(*) FILTER (cycle <> 1996) AS m FROM contributions""",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["cycle", "amount", "transaction.id", "date"])
    return settled(quality.check_checksums(rows, rows.where("cycle <> 1996"), "amount", ["transaction.id", "date"]))


def _as_text(df: DataFrame) -> DataFrame:
    return df.select(*[c(n).cast("string").alias(n) for n in df.columns])


@query(
    "v03_row_reconcile",
    check_sql(
        zero_sql("rows lost", "lost"),
        zero_sql("rows gained", "changed"),
        source="""SELECT COUNT(*) FILTER (cycle = 1996 OR ("transaction.type" = 'R' AND amount IS NOT NULL)) AS lost,
                  COUNT(*) FILTER (cycle <> 1996 AND "transaction.type" = 'R' AND amount IS NOT NULL) AS changed
                  FROM contributions""",
    ),
)
def _(spark, sf):
    rows = spark.read.parquet(contributions_root(spark, sf))
    changed = F.when(c("transaction.type") == "R", F.col("amount") + 1).otherwise(F.col("amount"))
    output = rows.where("cycle <> 1996").withColumn("amount", changed)
    return quality.check_rows(_as_text(rows), output, CONTRIBUTIONS)


@query(
    "v03_rows_equal",
    check_sql(zero_sql("rows lost", "n"), zero_sql("rows gained", "n"), source="SELECT 0 AS n"),
)
def _(spark, sf):
    rows = spark.read.parquet(contributions_root(spark, sf))
    return quality.check_rows(_as_text(rows), rows, CONTRIBUTIONS)


@query(
    "v04_organizational",
    check_sql(
        ("row_count", "n < total", "total", "n"),
        zero_sql("filter", "persons"),
        source="""SELECT COUNT(*) AS total, COUNT(*) FILTER (amount >= 10000) AS n,
                  COUNT(*) FILTER (amount >= 10000 AND "contributor.type" = 'I') AS persons FROM contributions""",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["amount", "contributor.type"])
    return quality.check_organizational(rows, rows.where("amount >= 10000"))


_RECIPIENT_CYCLES = 'SELECT COUNT(DISTINCT (cycle, "bonica.rid")) AS n FROM contributions'


@query(
    "v05_aggregates",
    check_sql(("row_count", "n > 0", "1", "n"), ("aggregation", "TRUE", "0", "0"), source=_RECIPIENT_CYCLES),
)
def _(spark, sf):
    rows = load(spark, sf, "contributions")
    return quality.check_aggregates(rows, marts.recipient_aggregates(rows))


@query(
    "v05_aggregates_faulty",
    check_sql(
        ("row_count", "n > 0", "1", "n"),
        zero_sql("aggregation", "off"),
        source="""SELECT COUNT(DISTINCT (cycle, "bonica.rid")) AS n,
                  COUNT(DISTINCT (cycle, "bonica.rid")) FILTER ("bonica.rid" IN ('3', '5')) AS off FROM contributions""",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "contributions")
    faulty = marts.recipient_aggregates(rows).withColumns(
        {
            "contribution_count": F.col("contribution_count") + F.when(c("bonica.rid") == "3", 1).otherwise(0),
            "total_amount": F.col("total_amount") + F.when(c("bonica.rid") == "5", 100.0).otherwise(0.001),
        }
    )
    return quality.check_aggregates(rows, faulty)


@query(
    "v06_links",
    check_sql(
        zero_sql("unknown persons", "unknown"),
        ("matched rows", "TRUE", "total", "matched"),
        ("coverage", "TRUE", "NULL", money_sql("100.0 * matched / total")),
        source=f"""{sql.LINKED} SELECT COUNT(*) AS total, COUNT(bioguide_id) AS matched,
                   COUNT(DISTINCT bioguide_id) FILTER (NOT is_current) AS unknown
                   FROM (SELECT p.bioguide_id, q.is_current FROM contributions k
                         LEFT JOIN pairs p ON p.rid = k."bonica.rid"
                         LEFT JOIN people q ON q.bioguide_id = p.bioguide_id)""",
    ),
)
def _(spark, sf):
    from polfin.operators.linking import link

    known = people(spark, sf)
    rows = link(load(spark, sf, "contributions", ["bonica.rid"]), recipients(spark, sf), known)
    return settled(quality.check_links(rows, known.where("is_current")))


@query(
    "v07_unified_completeness",
    check_sql(
        zero_sql("blank key", "blank"),
        zero_sql("unique key", "repeated"),
        ("enough rows", "n >= 10", "10", "n"),
        ("not too many rows", "n <= 5000", "5000", "n"),
        source="""SELECT COUNT(*) AS n, COUNT(*) FILTER (coalesce(bioguide_id, '') = '') AS blank,
                  COUNT(*) - COUNT(DISTINCT bioguide_id) AS repeated FROM legislators_current""",
    ),
)
def _(spark, sf):
    return quality.check_unified_completeness(load(spark, sf, "legislators_current"), (10, 5000))


@query(
    "v08_unified_coverage",
    check_sql(
        ("not empty", "n > 0", "1", "n"),
        ("fec_ids filled", "fec > 0", "1", "fec"),
        ("icpsr filled", "icpsr > 0", "1", "icpsr"),
        source=f"""SELECT COUNT(*) AS n, COUNT(*) FILTER (len(fec_ids) > 0) AS fec, COUNT(icpsr) AS icpsr
                   FROM ({sql.PEOPLE})""",
    ),
)
def _(spark, sf):
    return quality.check_unified_coverage(people(spark, sf))


@query(
    "v09_unified_names",
    check_sql(
        ("rows compared", "n > 0", "1", "n"),
        zero_sql("found in source", "absent"),
        zero_sql("same name", "renamed"),
        source=f"""SELECT COUNT(*) AS n,
                   COUNT(*) FILTER (NOT is_current AND CAST(right(bioguide_id, 6) AS INT) % 3 <> 1) AS absent,
                   COUNT(*) FILTER (first_name = 'F7' AND (is_current OR CAST(right(bioguide_id, 6) AS INT) % 3 = 1))
                     AS renamed FROM ({sql.PEOPLE})""",
    ),
)
def _(spark, sf):
    current, historical = (load(spark, sf, f"legislators_{n}") for n in ("current", "historical"))
    renamed = F.when(F.col("first_name") == "F7", "Other").otherwise(F.col("first_name"))
    output = people(spark, sf).withColumn("first_name", renamed)
    fewer = historical.where("try_cast(right(bioguide_id, 6) AS INT) % 3 = 1")
    return quality.check_unified_names(output, current, fewer)


@query(
    "v10_distinct_completeness",
    check_sql(
        ("row_count", "n = m", "n", "m"),
        ("duplicates", "TRUE", "0", "0"),
        zero_sql("missing", "n - m"),
        ("extra", "TRUE", "0", "0"),
        source=f"""SELECT COUNT(DISTINCT bioguide_id) AS n,
                   COUNT(DISTINCT bioguide_id) FILTER (right(bioguide_id, 1) <> '4') AS m FROM ({sql.SERVED})""",
    ),
)
def _(spark, sf):
    members = load(spark, sf, "members")
    output = dimensions.distinct_legislators(members).where("right(bioguide_id, 1) <> '4'")
    return quality.check_distinct_completeness(members, output, 96)


@query(
    "v11_distinct_aggregates",
    check_sql(
        ("first_congress", "TRUE", "0", "0"),
        zero_sql("last_congress", "off"),
        ("congresses_served length", "TRUE", "0", "0"),
        source=f"""SELECT COUNT(DISTINCT bioguide_id) FILTER (right(bioguide_id, 1) = '4') AS off
                   FROM ({sql.SERVED})""",
    ),
)
def _(spark, sf):
    members = load(spark, sf, "members")
    output = dimensions.distinct_legislators(members).withColumn(
        "last_congress", F.expr("last_congress + IF(right(bioguide_id, 1) = '4', 1, 0)")
    )
    return quality.check_distinct_aggregates(members, output, 96)


@query(
    "v12_distinct_lists",
    check_sql(
        zero_sql("list contents", "n"),
        zero_sql("list order", "n"),
        zero_sql("latest bioname", "n"),
        zero_sql("latest state_abbrev", "n"),
        source="SELECT 0 AS n",
    ),
)
def _(spark, sf):
    members = load(spark, sf, "members")
    output = dimensions.distinct_legislators(members)
    return quality.check_distinct_lists(members, output, 96).unionByName(
        quality.check_distinct_latest(members, output, 96)
    )


@query(
    "v13_crosswalk_counts",
    check_sql(
        ("not empty", "m > 0", "1", "m"),
        ("icpsr filled", "TRUE", "0", "0"),
        ("bonica_rid filled", "TRUE", "0", "0"),
        ("row_count", "n = m", "n", "m"),
        source=f"SELECT COUNT(*) AS n, COUNT(*) FILTER (state <> 'NATION_4') AS m FROM ({sql.CROSSWALK})",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "recipients")
    return quality.check_crosswalk_counts(rows, dimensions.crosswalk(rows).where("state <> 'NATION_4'"))


@query(
    "v14_crosswalk_unique",
    check_sql(
        zero_sql("unique pairs", "n"),
        source="""SELECT COUNT(*) AS n FROM (SELECT left("ICPSR", -4) AS i, "bonica.rid" FROM recipients
                  WHERE length("ICPSR") > 4 GROUP BY ALL HAVING COUNT(*) > 1)""",
    ),
)
def _(spark, sf):
    return quality.check_crosswalk_unique(dimensions.crosswalk_pairs(load(spark, sf, "recipients")))


@query(
    "v15_crosswalk_pairs",
    check_sql(
        zero_sql("pairs in source", "n"),
        source=f"""SELECT COUNT(*) AS n FROM ({sql.CROSSWALK}) x WHERE NOT EXISTS (SELECT 1 FROM recipients r
                   WHERE r.cycle < 1998 AND r."bonica.rid" = x.bonica_rid AND left(r."ICPSR", -4) = x.icpsr)""",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "recipients")
    return quality.check_crosswalk_pairs(rows.where("cycle < 1998"), dimensions.crosswalk(rows))


@query(
    "v16_constraints",
    check_sql(
        zero_sql("null transaction_id", "null_id"),
        zero_sql("null industry", "null_industry"),
        zero_sql("unique transaction_id", "repeated"),
        zero_sql("reference recipient_id", "lost"),
        zero_sql("reference donor_id", "0"),
        source="""SELECT COUNT(*) FILTER (transaction_id IS NULL) AS null_id,
                  COUNT(*) FILTER (industry IS NULL) AS null_industry,
                  (SELECT COUNT(*) FROM (SELECT transaction_id FROM gifts GROUP BY 1 HAVING COUNT(*) > 1)) AS repeated,
                  COUNT(*) FILTER (recipient_id NOT IN (SELECT politician_id FROM politicians)) AS lost FROM gifts""",
    ),
)
def _(spark, sf):
    rules = quality.Constraints(
        not_null=["transaction_id", "industry"],
        unique=[["transaction_id"]],
        references={
            "recipient_id": (load(spark, sf, "politicians"), "politician_id"),
            "donor_id": (load(spark, sf, "donors"), "donor_id"),
        },
    )
    return quality.check_constraints(load(spark, sf, "gifts"), rules)


@query(
    "v16_vote_values",
    check_sql(
        zero_sql("null politician_id", "0"),
        zero_sql("allowed vote_value", "bad"),
        source="SELECT COUNT(*) FILTER (vote_value = 'Absent') AS bad FROM rollcall_votes",
    ),
)
def _(spark, sf):
    rules = quality.Constraints(
        not_null=["politician_id"], allowed={"vote_value": ["Yea", "Nay", "Present", "Not Voting"]}
    )
    return quality.check_constraints(load(spark, sf, "rollcall_votes"), rules)


@query(
    "v17_all_valid",
    """SELECT 'good' AS report, COUNT(*) > 0 AS all_valid FROM contributions
       UNION ALL SELECT 'bad', COUNT(*) FILTER (amount >= 10000 AND "contributor.type" = 'I') = 0 FROM contributions""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["amount", "contributor.type"])
    good = quality.check_organizational(rows, marts.organizational(rows))
    bad = quality.check_organizational(rows, rows.where("amount >= 10000"))
    return (
        quality.mart_valid(good)
        .select(F.lit("good").alias("report"), "all_valid")
        .unionByName(quality.all_valid(bad).select(F.lit("bad").alias("report"), "all_valid"))
    )


@query(
    "o06_first_violations",
    """SELECT "transaction.id", COUNT(*) AS copies FROM contributions GROUP BY "transaction.id"
       HAVING COUNT(*) > 1 ORDER BY "transaction.id" LIMIT 10""",
)
def _(spark, sf):
    from polfin.operators.sets import duplicate_keys

    repeated = duplicate_keys(load(spark, sf, "contributions", ["transaction.id"]), ["transaction.id"])
    return quality.diagnostics(repeated, ["transaction.id"])


@query(
    "v05_sampled",
    """SELECT 'row_count' AS "check", COUNT(*) > 0 AS passed FROM contributions UNION ALL SELECT 'aggregation', TRUE""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions")
    return quality.check_aggregates(rows, marts.recipient_aggregates(rows), sample=5, seed=5).select("check", "passed")


@query(
    "v05_sampled_fault",
    """SELECT 'row_count' AS "check", COUNT(*) > 0 AS passed FROM contributions UNION ALL SELECT 'aggregation', FALSE""",
)
def _(spark, sf):
    """Aggregates that are all one short are caught in any sample."""
    rows = load(spark, sf, "contributions")
    short = marts.recipient_aggregates(rows).withColumn("contribution_count", F.col("contribution_count") - 1)
    return quality.check_aggregates(rows, short, sample=5, seed=5).select("check", "passed")


@query(
    "m06_crosswalk_report",
    check_sql(
        ("not empty", "n > 0", "1", "n"),
        ("icpsr filled", "TRUE", "0", "0"),
        ("bonica_rid filled", "TRUE", "0", "0"),
        ("row_count", "TRUE", "n", "n"),
        ("unique pairs", "TRUE", "0", "0"),
        ("pairs in source", "TRUE", "0", "0"),
        source=f"SELECT COUNT(*) AS n FROM ({sql.CROSSWALK})",
    ),
)
def _(spark, sf):
    rows = load(spark, sf, "recipients")
    return pipelines.crosswalk_report(rows, dimensions.crosswalk(rows))


@query(
    "m09_detail_report",
    check_sql(
        ("row_count", "n < total", "total", "n"),
        zero_sql("filter", "0"),
        source="""SELECT (SELECT COUNT(*) FROM contributions) AS total, COUNT(*) AS n FROM (
                  SELECT DISTINCT cycle, "bonica.rid", "recipient.name", "contributor.name", "contributor.type",
                  "bonica.cid", amount, date, "contributor.state" FROM contributions
                  WHERE "contributor.type" <> 'I')""",
    ),
)
def _(spark, sf):
    rows = spark.read.parquet(contributions_root(spark, sf))  # read four times
    detail = marts.organizational_detail(rows, recipients(spark, sf), people(spark, sf), mode="best")
    return quality.check_organizational(rows, select(detail, "contributor_type"))
