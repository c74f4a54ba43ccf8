"""Queries over aggregations and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.q_joins import people, recipients
from polfin.catalog.registry import money_sql, query, rounded
from polfin.catalog.standins import STANDINS, load, select, terms
from polfin.catalog.stored import contributions_root
from polfin.functions.columns import asc, c, cols
from polfin.operators.sets import duplicate_keys, first_per_key, latest_per_key
from polfin.plans import analytics, dimensions, marts, pipelines, quality


def contributions(spark, sf, *names):
    return load(spark, sf, "contributions", list(names) or None)


@query("a01_recipient_totals", f'SELECT cycle, "bonica.rid", total_amount, avg_amount, contribution_count FROM ({sql.AGGREGATES})')
def _(spark, sf):
    rows = marts.recipient_aggregates(contributions(spark, sf))
    chosen = select(rows, "cycle", "bonica.rid", "total_amount", "avg_amount", "contribution_count")
    return rounded(chosen, "total_amount", "avg_amount")


@query(
    "a02_breakdown",
    f"""SELECT cycle, "bonica.rid", individual_total, individual_count, organizational_total, organizational_count
        FROM ({sql.AGGREGATES})""",
)
def _(spark, sf):
    names = ["individual_total", "individual_count", "organizational_total", "organizational_count"]
    rows = select(marts.recipient_aggregates(contributions(spark, sf)), "cycle", "bonica.rid", *names)
    return rounded(rows, "individual_total", "organizational_total")


@query("a03_latest_values", f"SELECT bioguide_id, bioname, state_abbrev, party_code, nominate_dim1 FROM ({sql.LATEST})")
def _(spark, sf):
    rows = dimensions.distinct_legislators(load(spark, sf, "members"))
    return rows.select("bioguide_id", "bioname", "state_abbrev", "party_code", "nominate_dim1")


@query(
    "a04_congress_list",
    f"""SELECT bioguide_id, array_to_string(congresses_served, ',') AS congresses FROM ({sql.DISTINCT_PEOPLE})""",
)
def _(spark, sf):
    rows = dimensions.distinct_legislators(load(spark, sf, "members"))
    text = F.array_join(F.col("congresses_served").cast("array<string>"), ",")
    return rows.select("bioguide_id", text.alias("congresses"))


@query("a05_first_last", f"SELECT bioguide_id, first_congress, last_congress FROM ({sql.DISTINCT_PEOPLE})")
def _(spark, sf):
    rows = dimensions.distinct_legislators(load(spark, sf, "members"))
    return rows.select("bioguide_id", "first_congress", "last_congress")


@query("a06_crosswalk", sql.CROSSWALK)
def _(spark, sf):
    return dimensions.crosswalk(load(spark, sf, "recipients"))


@query(
    "a08_distinct_counts",
    """SELECT COUNT(DISTINCT "bonica.rid") AS recipients, COUNT(DISTINCT "bonica.cid") AS contributors
       FROM contributions""",
)
def _(spark, sf):
    rows = contributions(spark, sf, "bonica.rid", "bonica.cid")
    return rows.agg(
        F.count_distinct(c("bonica.rid")).alias("recipients"), F.count_distinct(c("bonica.cid")).alias("contributors")
    )


@query(
    "a09_distinct_pairs",
    """SELECT COUNT(*) AS pairs FROM (SELECT DISTINCT "bonica.rid", "bonica.cid" FROM recipients)""",
)
def _(spark, sf):
    rows = load(spark, sf, "recipients", ["bonica.rid", "bonica.cid"])
    return rows.agg(F.count_distinct(F.struct(*cols(rows.columns))).alias("pairs"))


@query(
    "a10_checksum",
    f"""SELECT {money_sql("SUM(amount)")} AS total, CAST(0 AS BIGINT) AS nans, COUNT("transaction.id") AS "filled transaction.id",
               COUNT("bonica.cid") AS "filled bonica.cid", COUNT("contributor.name") AS "filled contributor.name",
               COUNT(amount) AS "filled amount" FROM contributions""",
)
def _(spark, sf):
    keys = ["transaction.id", "bonica.cid", "contributor.name", "amount"]
    return rounded(contributions(spark, sf, *keys).agg(*quality.checksum_columns("amount", keys)), "total")


@query(
    "a12_coverage",
    f"""{sql.LINKED} SELECT COUNT(p.bioguide_id) AS matched, COUNT(*) AS total,
               {money_sql("100.0 * COUNT(p.bioguide_id) / COUNT(*)")} AS coverage_pct
        FROM (SELECT DISTINCT cycle, "bonica.rid" FROM contributions) k LEFT JOIN pairs p ON p.rid = k."bonica.rid" """,
)
def _(spark, sf):
    rows = marts.recipient_aggregates(contributions(spark, sf), recipients(spark, sf), people(spark, sf))
    return rounded(quality.coverage(rows, F.col("bioguide_id").isNotNull()), "coverage_pct")


_INDUSTRY = f"""
    SELECT politician_id, industry, COUNT(*) AS contribution_count, CAST(SUM(amount) AS DECIMAL(24,2)) AS total_amount,
           {money_sql("CAST(SUM(amount) AS DOUBLE) / COUNT(*)")} AS avg_amount
    FROM gifts JOIN politicians ON politician_id = recipient_id GROUP BY politician_id, industry"""


def _industry(spark, sf):
    rows = analytics.politician_industry_summary(load(spark, sf, "gifts"), load(spark, sf, "politicians"))
    return rounded(rows.withColumn("avg_amount", F.col("avg_amount").cast("double")), "avg_amount")


query("a13_industry_summary", _INDUSTRY)(_industry)


@query("a14_max_congress", sql.MAX_CONGRESS)
def _(spark, sf):
    return dimensions.max_congress(terms(spark, sf))


@query(
    "a15_congress_stats",
    f"""SELECT COUNT(*) AS "count", min(max_congress) AS min_congress, max(max_congress) AS max_congress
        FROM ({sql.MAX_CONGRESS})""",
)
def _(spark, sf):
    return dimensions.congress_stats(dimensions.max_congress(terms(spark, sf)))


@query(
    "a16_duplicates",
    'SELECT "transaction.id", COUNT(*) AS copies FROM contributions GROUP BY "transaction.id" HAVING COUNT(*) > 1',
)
def _(spark, sf):
    return duplicate_keys(contributions(spark, sf, "transaction.id"), ["transaction.id"])


@query(
    "a17_repeated_rows",
    'SELECT COUNT(*) - COUNT(DISTINCT "transaction.id") AS repeated FROM contributions',
)
def _(spark, sf):
    rows = contributions(spark, sf, "transaction.id")
    return rows.agg((F.count("*") - F.count_distinct(c("transaction.id"))).alias("repeated"))


@query(
    "a18_top_recipients",
    f"""SELECT "recipient.name", "recipient.party", COUNT(*) AS num_contributions, {money_sql("SUM(amount)")} AS total_amount
        FROM contributions WHERE "recipient.name" IS NOT NULL GROUP BY ALL
        ORDER BY total_amount DESC, "recipient.name", "recipient.party" LIMIT 10""",
)
def _(spark, sf):
    rows = contributions(spark, sf, "recipient.name", "recipient.party", "amount")
    return rounded(analytics.top_recipients(rows), "total_amount")


@query(
    "a19_totals_by_cycle",
    f"""SELECT cycle, COUNT(*) AS num_contributions, {money_sql("SUM(amount)")} AS total_amount,
               {money_sql("AVG(amount)")} AS avg_amount FROM contributions GROUP BY cycle""",
)
def _(spark, sf):
    rows = analytics.totals_by_cycle(contributions(spark, sf, "cycle", "amount"))
    return rounded(rows, "total_amount", "avg_amount").orderBy("cycle")


@query(
    "a20_totals_by_state",
    f"""SELECT "contributor.state" AS state, COUNT(*) AS n, {money_sql("SUM(amount)")} AS total,
               {money_sql("AVG(amount)")} AS avg
        FROM contributions WHERE "contributor.state" IS NOT NULL GROUP BY "contributor.state" """,
)
def _(spark, sf):
    rows = analytics.totals_by_state(contributions(spark, sf, "contributor.state", "amount"))
    return rounded(rows, "total", "avg")


@query(
    "a21_party_by_cycle",
    f"""SELECT cycle, "recipient.party" AS party, {money_sql("SUM(amount)")} AS total FROM contributions
        WHERE "recipient.party" IN ('D', 'R') GROUP BY cycle, "recipient.party" """,
)
def _(spark, sf):
    rows = analytics.party_totals_by_cycle(contributions(spark, sf, "cycle", "recipient.party", "amount"))
    return rounded(rows, "total")


@query(
    "a22_large_donors",
    f"""SELECT "contributor.name", "contributor.employer", COUNT(*) AS contributions, {money_sql("SUM(amount)")} AS total
        FROM contributions WHERE amount >= 10000 GROUP BY "contributor.name", "contributor.employer"
        ORDER BY total DESC, "contributor.name" LIMIT 50""",
)
def _(spark, sf):
    rows = contributions(spark, sf, "contributor.name", "contributor.employer", "amount")
    return rounded(analytics.large_donor_totals(rows), "total")


@query(
    "a24_donor_totals",
    """SELECT d.donor_id, d.name, COUNT(g.donor_id) AS total_contributions_count,
              CAST(coalesce(SUM(g.amount), 0) AS DECIMAL(24,2)) AS total_amount
       FROM donors d LEFT JOIN gifts g ON g.donor_id = d.donor_id GROUP BY d.donor_id, d.name""",
)
def _(spark, sf):
    totals = analytics.donor_totals(load(spark, sf, "donors"), load(spark, sf, "gifts"))
    return totals.select("donor_id", "name", "total_contributions_count", "total_amount")


@query("a25_rows_per_cycle", "SELECT cycle, COUNT(*) AS rows FROM contributions GROUP BY cycle")
def _(spark, sf):
    return pipelines.rows_per_cycle(contributions(spark, sf, "cycle"))


@query(
    "a26_recipients_per_person",
    f"""SELECT COUNT(DISTINCT bonica_rid) / nullif(COUNT(DISTINCT icpsr), 0) AS recipients_per_legislator
        FROM ({sql.CROSSWALK})""",
)
def _(spark, sf):
    return dimensions.crosswalk_ratio(dimensions.crosswalk(load(spark, sf, "recipients")))


@query(
    "a27_filtered_out",
    f"""SELECT kept AS output_count, people - kept AS filtered_out, {money_sql("100.0 * fec / kept")} AS fec_pct,
               {money_sql("100.0 * with_icpsr / kept")} AS icpsr_pct
        FROM (SELECT COUNT(*) AS kept, COUNT(*) FILTER (len(fec_ids) > 0) AS fec, COUNT(icpsr) AS with_icpsr
              FROM ({sql.PEOPLE})),
             (SELECT COUNT(bioguide_id) AS people FROM (SELECT bioguide_id FROM legislators_current
              UNION SELECT bioguide_id FROM legislators_historical))""",
)
def _(spark, sf):
    current, historical = (load(spark, sf, f"legislators_{n}") for n in ("current", "historical"))
    return rounded(pipelines.unified_summary(current, historical, people(spark, sf)), "fec_pct", "icpsr_pct")


@query("w01_dedup_priority", f"SELECT bioguide_id, full_name, is_current FROM ({sql.PEOPLE})")
def _(spark, sf):
    both = dimensions.combined_legislators(
        load(spark, sf, "legislators_current"), load(spark, sf, "legislators_historical")
    )
    first = first_per_key(both, ["bioguide_id"], [asc("source_priority")])
    return first.select("bioguide_id", "full_name", "is_current")


@query("w02_latest_row", f"SELECT bioguide_id, congress, bioname, state_abbrev FROM ({sql.LATEST})")
def _(spark, sf):
    rows = dimensions.served(load(spark, sf, "members")).select("bioguide_id", "congress", *dimensions.LATEST_TIES)
    latest = latest_per_key(rows, ["bioguide_id"], "congress", dimensions.LATEST_TIES)
    return latest.select("bioguide_id", "congress", "bioname", "state_abbrev")


# ------------------------------------------------------------------------ marts


@query("m04_unified", f"SELECT * EXCLUDE (fec_ids), array_to_string(fec_ids, ',') AS fec_ids FROM ({sql.PEOPLE})")
def _(spark, sf):
    return people(spark, sf).withColumn("fec_ids", F.array_join("fec_ids", ","))


@query(
    "m04_unified_eligible",
    f"""SELECT bioguide_id, full_name, icpsr, is_current FROM ({sql.PEOPLE})
        WHERE bioguide_id IN (SELECT 'P' || right(bioguide_id, 6) FROM ({sql.MAX_CONGRESS}) WHERE max_congress >= 98)""",
)
def _(spark, sf):
    # Users of the event log stand for the customers of the same number.
    served = terms(spark, sf).withColumn(
        "id", F.struct(F.regexp_replace(F.col("id.bioguide"), "^U", "P").alias("bioguide"))
    )
    rows = dimensions.unified_legislators(
        load(spark, sf, "legislators_current"), load(spark, sf, "legislators_historical"), served, 98
    )
    return rows.select("bioguide_id", "full_name", "icpsr", "is_current")


@query(
    "m05_distinct_legislators",
    f"""SELECT * REPLACE (array_to_string(congresses_served, ',') AS congresses_served) FROM ({sql.DISTINCT_PEOPLE})""",
)
def _(spark, sf):
    rows = dimensions.distinct_legislators(load(spark, sf, "members"))
    text = F.array_join(F.col("congresses_served").cast("array<string>"), ",")
    return rows.withColumn("congresses_served", text)


@query("m06_crosswalk", sql.CROSSWALK)
def _(spark, sf):
    return dimensions.crosswalk(load(spark, sf, "recipients")).orderBy(asc("icpsr"), asc("bonica_rid"))


@query("m07_organizational", "SELECT * FROM contributions WHERE \"contributor.type\" <> 'I'")
def _(spark, sf):
    return marts.organizational(contributions(spark, sf))


@query(
    "m07_organizational_linked",
    f"""{sql.LINKED} SELECT p.bioguide_id, k.* FROM
        (SELECT DISTINCT * FROM contributions WHERE "contributor.type" <> 'I') k
        LEFT JOIN pairs p ON p.rid = k."bonica.rid" """,
)
def _(spark, sf):
    # Read three times, so from files.
    rows = select(spark.read.parquet(contributions_root(spark, sf)), *STANDINS["contributions"].expressions)
    return marts.organizational(rows, recipients(spark, sf), people(spark, sf))


_MONEY = ("total_amount", "avg_amount", "individual_total", "organizational_total")


@query("m08_recipient_aggregates", sql.AGGREGATES)
def _(spark, sf):
    return rounded(marts.recipient_aggregates(contributions(spark, sf)), *_MONEY)


@query(
    "m08_recipient_aggregates_linked",
    f"""{sql.LINKED} SELECT p.bioguide_id, a.* FROM ({sql.AGGREGATES}) a LEFT JOIN pairs p ON p.rid = a."bonica.rid" """,
)
def _(spark, sf):
    rows = marts.recipient_aggregates(contributions(spark, sf), recipients(spark, sf), people(spark, sf))
    return rounded(rows, *_MONEY)


@query(
    "m09_raw_organizational",
    f"""{sql.LINKED} SELECT DISTINCT p.bioguide_id, CAST(k.cycle AS BIGINT) AS cycle, k."bonica.rid", k."recipient.name",
               k."contributor.name" AS contributor_name, k."contributor.type" AS contributor_type,
               k."bonica.cid" AS contributor_id, k.amount, k.date, k."contributor.state" AS contributor_state
        FROM contributions k LEFT JOIN pairs p ON p.rid = k."bonica.rid" WHERE k."contributor.type" <> 'I'""",
)
def _(spark, sf):
    rows = spark.read.parquet(contributions_root(spark, sf))  # read three times
    return marts.organizational_detail(rows, recipients(spark, sf), people(spark, sf))


query("m14_industry_summary", _INDUSTRY)(_industry)
