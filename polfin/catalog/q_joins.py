"""Queries over joins and linking."""

from __future__ import annotations

from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.registry import money_sql, query, rounded
from polfin.catalog.standins import load, select, terms
from polfin.functions.columns import asc, desc
from polfin.operators.joins import lookup_join
from polfin.operators.limits import sample_keys, top_k
from polfin.operators.linking import ambiguous_recipients, link, link_table, recipients_with_person
from polfin.operators.sets import missing_keys
from polfin.plans import analytics, dimensions, marts, quality

RID_PERSON = 'SELECT rid AS "bonica.rid", bioguide_id FROM'


def people(spark, sf):
    """Unified legislators of all times."""
    return dimensions.unified_legislators(
        load(spark, sf, "legislators_current"), load(spark, sf, "legislators_historical")
    )


def recipients(spark, sf):
    return load(spark, sf, "recipients", ["bonica.rid", "ICPSR"])


@query("j01_recipients_with_person", f"{sql.LINKED} {RID_PERSON} pairs")
def _(spark, sf):
    return recipients_with_person(recipients(spark, sf), people(spark, sf))


@query(
    "j01_link_table",
    f"{sql.LINKED} {RID_PERSON} pairs WHERE rid IN (SELECT rid FROM pairs WHERE bioguide_id IS NOT NULL)",
)
def _(spark, sf):
    return link_table(recipients(spark, sf), people(spark, sf))


@query(
    "j01_ambiguous_recipients",
    f"""{sql.LINKED} SELECT rid AS "bonica.rid", COUNT(bioguide_id) AS persons FROM pairs
        GROUP BY rid HAVING COUNT(bioguide_id) > 1""",
)
def _(spark, sf):
    return ambiguous_recipients(recipients(spark, sf), people(spark, sf))


@query(
    "j02_link_contributions",
    f"""{sql.LINKED} SELECT p.bioguide_id, k."transaction.id", k."bonica.rid", k.amount
        FROM contributions k LEFT JOIN pairs p ON p.rid = k."bonica.rid" """,
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "bonica.rid", "amount"])
    return link(rows, recipients(spark, sf), people(spark, sf))


@query(
    "j02_link_best",
    f"""{sql.LINKED} SELECT p.bioguide_id, k."transaction.id", k."bonica.rid", k.amount FROM contributions k
        LEFT JOIN (SELECT rid, min(bioguide_id) AS bioguide_id FROM pairs GROUP BY rid) p ON p.rid = k."bonica.rid" """,
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "bonica.rid", "amount"])
    return link(rows, recipients(spark, sf), people(spark, sf), mode="best")


@query(
    "j02_link_salted",
    f"""{sql.LINKED} SELECT k."bonica.rid", p.bioguide_id, k."transaction.id"
        FROM contributions k LEFT JOIN pairs p ON p.rid = k."bonica.rid" """,
)
def _(spark, sf):
    """The same link by the route taken when the link table is too big to broadcast."""
    rows = load(spark, sf, "contributions", ["transaction.id", "bonica.rid"])
    table = link_table(recipients(spark, sf), people(spark, sf))
    return select(lookup_join(rows, table, ["bonica.rid"], max_bytes=-1), "bonica.rid", "bioguide_id", "transaction.id")


@query(
    "j03_link_aggregates",
    f"""{sql.LINKED} SELECT p.bioguide_id, a.cycle, a."bonica.rid", a.contribution_count, a.total_amount
        FROM ({sql.AGGREGATES}) a LEFT JOIN pairs p ON p.rid = a."bonica.rid" """,
)
def _(spark, sf):
    rows = marts.recipient_aggregates(load(spark, sf, "contributions"), recipients(spark, sf), people(spark, sf))
    chosen = select(rows, "bioguide_id", "cycle", "bonica.rid", "contribution_count", "total_amount")
    return rounded(chosen, "total_amount")


@query(
    "j04_inner_foreign_key",
    """SELECT g.transaction_id, p.politician_id, p.full_name, g.amount FROM gifts g
       JOIN politicians p ON p.politician_id = g.recipient_id""",
)
def _(spark, sf):
    politicians = load(spark, sf, "politicians").select(F.col("politician_id").alias("recipient_id"), "full_name")
    rows = lookup_join(load(spark, sf, "gifts"), politicians, ["recipient_id"], "inner")
    return rows.select("transaction_id", F.col("recipient_id").alias("politician_id"), "full_name", "amount")


_CHAIN = f"""FROM ({sql.DISTINCT_PEOPLE}) l JOIN ({sql.CROSSWALK}) x ON CAST(l.icpsr AS VARCHAR) = x.icpsr"""


def _chain(spark, sf):
    legislators = dimensions.distinct_legislators(load(spark, sf, "members"))
    return legislators, dimensions.crosswalk(load(spark, sf, "recipients"))


@query(
    "j05_legislator_contributions",
    f"""SELECT l.bioguide_id, l.bioname, k."contributor.name" AS contributor_name, k.amount, k.cycle
        {_CHAIN} JOIN contributions k ON k."bonica.rid" = x.bonica_rid""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["bonica.rid", "contributor.name", "amount", "cycle"])
    return analytics.legislator_contributions(*_chain(spark, sf), rows)


@query(
    "j06_legislator_aggregates",
    f"""SELECT l.bioguide_id, l.bioname, x.bonica_rid, a.total_amount, a.organizational_count
        {_CHAIN} JOIN ({sql.AGGREGATES}) a ON a."bonica.rid" = x.bonica_rid WHERE a.cycle = 1998""",
)
def _(spark, sf):
    totals = marts.recipient_aggregates(load(spark, sf, "contributions").where("cycle = 1998"))
    return rounded(analytics.aggregates_per_legislator(*_chain(spark, sf), totals, 1998), "total_amount")


@query(
    "j07_semi_eligible",
    f"""SELECT bioguide_id, congress FROM members WHERE bioguide_id IN
        (SELECT bioguide_id FROM ({sql.MAX_CONGRESS}) WHERE max_congress >= 98)""",
)
def _(spark, sf):
    eligible = dimensions.eligible_people(dimensions.max_congress(terms(spark, sf)), 98)
    members = load(spark, sf, "members", ["bioguide_id", "congress"])
    return lookup_join(members, eligible, ["bioguide_id"], "left_semi")


@query(
    "j08_anti_missing",
    """SELECT DISTINCT bioguide_id FROM legislators_historical h WHERE bioguide_id IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM legislators_current k WHERE k.bioguide_id = h.bioguide_id)""",
)
def _(spark, sf):
    a, b = (load(spark, sf, f"legislators_{n}", ["bioguide_id"]) for n in ("historical", "current"))
    return missing_keys(a, b, ["bioguide_id"])


@query(
    "j09_orphan_keys",
    """SELECT DISTINCT icpsr FROM rollcall_casts WHERE icpsr NOT IN
       (SELECT icpsr FROM members WHERE bioguide_id IS NOT NULL)""",
)
def _(spark, sf):
    casts = load(spark, sf, "rollcall_casts", ["icpsr"])
    members = load(spark, sf, "members").where("bioguide_id IS NOT NULL")
    return missing_keys(casts, members.select(F.col("icpsr").cast("double").alias("icpsr")), ["icpsr"])


@query(
    "j10_foreign_keys",
    """SELECT recipient_id AS "key", COUNT(*) AS rows FROM gifts
       WHERE recipient_id NOT IN (SELECT politician_id FROM politicians) GROUP BY recipient_id""",
)
def _(spark, sf):
    gifts, politicians = load(spark, sf, "gifts"), load(spark, sf, "politicians")
    return quality.orphans(gifts, "recipient_id", politicians, "politician_id")


@query(
    "j11_living_parents",
    """SELECT transaction_id, recipient_id FROM gifts
       WHERE recipient_id IN (SELECT politician_id FROM politicians)""",
)
def _(spark, sf):
    gifts = load(spark, sf, "gifts", ["transaction_id", "recipient_id"])
    return analytics.with_living_parents(gifts, "recipient_id", load(spark, sf, "politicians"), "politician_id")


@query(
    "j12_all_legislators",
    f"""SELECT l.bioguide_id, l.bioname, l.state_abbrev, COUNT(k.cycle) AS contribution_count,
               {money_sql("SUM(k.amount)")} AS total_amount
        FROM ({sql.DISTINCT_PEOPLE}) l LEFT JOIN ({sql.CROSSWALK}) x ON CAST(l.icpsr AS VARCHAR) = x.icpsr
        LEFT JOIN contributions k ON k."bonica.rid" = x.bonica_rid GROUP BY ALL""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["bonica.rid", "amount"])
    totals = analytics.contributions_per_legislator(*_chain(spark, sf), rows, keep_all=True)
    return rounded(totals, "total_amount").orderBy(desc("total_amount"), asc("bioguide_id"))


@query(
    "j13_sampled_lookup",
    'SELECT least(30, COUNT(DISTINCT "bonica.rid")) AS recipients, 0 AS disagreeing FROM contributions',
)
def _(spark, sf):
    rows = load(spark, sf, "contributions")
    compared = quality.aggregate_differences(rows, marts.recipient_aggregates(rows), sample=30, seed=3)
    ok = F.col("count_ok") & F.col("sum_ok")
    return compared.agg(
        F.count_distinct("`bonica.rid`").alias("recipients"), F.count_if(~ok).cast("int").alias("disagreeing")
    )


@query(
    "a23_per_legislator",
    f"""SELECT l.bioguide_id, l.bioname, l.state_abbrev, COUNT(*) AS contribution_count,
               {money_sql("SUM(k.amount)")} AS total_amount
        {_CHAIN} JOIN contributions k ON k."bonica.rid" = x.bonica_rid WHERE k."contributor.type" <> 'I'
        GROUP BY ALL ORDER BY total_amount DESC, l.bioguide_id LIMIT 10""",
)
def _(spark, sf):
    given = marts.organizational(load(spark, sf, "contributions"))
    totals = analytics.contributions_per_legislator(*_chain(spark, sf), given)
    return top_k(rounded(totals, "total_amount"), [desc("total_amount"), asc("bioguide_id")], 10)


@query(
    "o08_sample_pairs",
    f"SELECT least(40, COUNT(*)) AS drawn FROM ({sql.CROSSWALK})",
)
def _(spark, sf):
    pairs = dimensions.crosswalk(load(spark, sf, "recipients"))
    return sample_keys(pairs, ["icpsr", "bonica_rid"], 40, seed=1).agg(F.count("*").alias("drawn"))
