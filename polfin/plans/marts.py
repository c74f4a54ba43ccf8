"""Fact marts derived from contributions.

The functions accept contributions of any number of cycles at once and keep the
cycles apart, so one job serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polfin.functions.columns import asc, c, cols, desc
from polfin.operators.linking import link
from polfin.operators.predicates import INDIVIDUAL, Organizational
from polfin.operators.sets import distinct_rows

RECIPIENT_KEY = (
    "bonica.rid",
    "recipient.name",
    "recipient.party",
    "recipient.type",
    "recipient.state",
    "candidate.cfscore",
)
RECIPIENT_TOTALS = (
    "total_amount",
    "avg_amount",
    "contribution_count",
    "individual_total",
    "individual_count",
    "organizational_total",
    "organizational_count",
)
# Output name -> input name.
DETAIL_COLUMNS = {
    "cycle": "cycle",
    "bonica.rid": "bonica.rid",
    "recipient.name": "recipient.name",
    "contributor_name": "contributor.name",
    "contributor_type": "contributor.type",
    "contributor_id": "bonica.cid",
    "amount": "amount",
    "date": "date",
    "contributor_state": "contributor.state",
}


def organizational(
    contributions: DataFrame,
    recipients: DataFrame | None = None,
    legislators: DataFrame | None = None,
    *,
    mode: str = "all",
    distinct: bool = True,
    links: DataFrame | None = None,
) -> DataFrame:
    """Contributions not made by individuals, all columns.

    Without legislators this is a filter and nothing is shuffled. With them each
    row gains ``bioguide_id`` and, as long as ``distinct`` holds, equal rows
    collapse into one. Rows are made distinct before the link is added: the
    person depends on the recipient only, so the outcome is the same and rows
    that link to several people are compared once.
    """
    rows = contributions.where(Organizational().to_column())
    if legislators is None and links is None:
        return rows
    if distinct:
        rows = distinct_rows(rows)
    return link(rows, recipients, legislators, mode, links)


def organizational_detail(
    contributions: DataFrame,
    recipients: DataFrame | None,
    legislators: DataFrame | None,
    *,
    mode: str = "all",
    distinct: bool = True,
    links: DataFrame | None = None,
) -> DataFrame:
    """Ten-column form of the linked organizational contributions."""
    rows = contributions.where(Organizational().to_column()).select(
        *[c(source).alias(name) for name, source in DETAIL_COLUMNS.items()]
    )
    rows = rows.withColumn("cycle", F.col("cycle").cast("bigint"))
    if distinct:
        rows = distinct_rows(rows)
    return link(rows, recipients, legislators, mode, links)


def _sum_if(condition: Column, value: Column, nothing: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(nothing))


def recipient_sums(contributions: DataFrame, by_cycle: bool = True) -> DataFrame:
    """What of the recipient aggregates can be added up later: all but the average."""
    amount = F.col("amount")
    from_person = c("contributor.type") == INDIVIDUAL
    from_organization = Organizational().to_column()
    keys = (["cycle"] if by_cycle else []) + list(RECIPIENT_KEY)
    return (
        contributions.where(c("bonica.rid").isNotNull())
        .groupBy(*cols(keys))
        .agg(
            F.sum(amount).alias("total_amount"),
            F.count(amount).alias("amount_count"),
            F.count("*").alias("contribution_count"),
            _sum_if(from_person, amount, F.lit(0.0)).alias("individual_total"),
            _sum_if(from_person, F.lit(1), F.lit(0)).alias("individual_count"),
            _sum_if(from_organization, amount, F.lit(0.0)).alias("organizational_total"),
            _sum_if(from_organization, F.lit(1), F.lit(0)).alias("organizational_count"),
        )
    )


def aggregates_of_sums(sums: DataFrame) -> DataFrame:
    """Recipient aggregates from their sums."""
    average = F.when(F.col("amount_count") > 0, F.col("total_amount") / F.col("amount_count")).alias("avg_amount")
    keys = [c(n) for n in sums.columns if n in ("cycle", *RECIPIENT_KEY)]
    return sums.select(*keys, *[average if n == "avg_amount" else c(n) for n in RECIPIENT_TOTALS])


def recipient_aggregates(
    contributions: DataFrame,
    recipients: DataFrame | None = None,
    legislators: DataFrame | None = None,
    *,
    mode: str = "all",
    by_cycle: bool = True,
    links: DataFrame | None = None,
) -> DataFrame:
    """Totals per recipient, split into individual and organizational money.

    Partial sums are formed in each task before the only large shuffle, so a
    recipient holding a third of all rows costs one row per task. The link is
    added to the grouped rows. Those are already unique, as are the link pairs,
    so no further DISTINCT is needed.
    """
    grouped = aggregates_of_sums(recipient_sums(contributions, by_cycle))
    if legislators is None and links is None:
        return grouped
    return link(grouped, recipients, legislators, mode, links)


def by_total(df: DataFrame) -> DataFrame:
    """Largest totals first, the published order; ties go by recipient."""
    return df.orderBy(desc("total_amount"), asc("bonica.rid"))


def with_cycle(df: DataFrame, cycle: int) -> DataFrame:
    """Put the cycle in front of a single-cycle frame."""
    rest = [c(n) for n in df.columns if n != "cycle"]
    return df.select(F.lit(cycle).cast("int").alias("cycle"), *rest)
