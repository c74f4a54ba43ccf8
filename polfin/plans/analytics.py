"""Summary queries over contributions and the serving tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polfin.functions.columns import asc, c, desc
from polfin.operators.joins import lookup_join
from polfin.operators.limits import top_k
from polfin.sources.sinks import merge_sums, read_sums


def top_recipients(contributions: DataFrame, k: int = 10) -> DataFrame:
    totals = (
        contributions.where(c("recipient.name").isNotNull())
        .groupBy(c("recipient.name"), c("recipient.party"))
        .agg(F.count("*").alias("num_contributions"), F.sum("amount").alias("total_amount"))
    )
    return top_k(totals, [desc("total_amount"), asc("recipient.name"), asc("recipient.party")], k)


def totals_by_cycle(contributions: DataFrame) -> DataFrame:
    return contributions.groupBy("cycle").agg(
        F.count("*").alias("num_contributions"),
        F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("avg_amount"),
    )


def totals_by_state(contributions: DataFrame) -> DataFrame:
    return (
        contributions.where(c("contributor.state").isNotNull())
        .groupBy(c("contributor.state").alias("state"))
        .agg(F.count("*").alias("n"), F.sum("amount").alias("total"), F.avg("amount").alias("avg"))
    )


def party_totals_by_cycle(contributions: DataFrame, parties: Sequence[str] = ("D", "R")) -> DataFrame:
    return (
        contributions.where(c("recipient.party").isin(*parties))
        .groupBy("cycle", c("recipient.party").alias("party"))
        .agg(F.sum("amount").alias("total"))
    )


def large_donor_totals(contributions: DataFrame, minimum: float = 10_000, k: int = 50) -> DataFrame:
    totals = (
        contributions.where(F.col("amount") >= minimum)
        .groupBy(c("contributor.name"), c("contributor.employer"))
        .agg(F.count("*").alias("contributions"), F.sum("amount").alias("total"))
    )
    return top_k(totals, [desc("total"), asc("contributor.name"), asc("contributor.employer")], k)


def _recipient_sums(contributions: DataFrame) -> DataFrame:
    """Money per recipient; later joins then see one row per recipient."""
    return contributions.groupBy(c("bonica.rid").alias("bonica_rid")).agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )


def _person_rids(legislators: DataFrame, xwalk: DataFrame) -> DataFrame:
    """Crosswalk keyed the way legislators are: by the ICPSR number as text."""
    people = legislators.withColumn("icpsr", F.col("icpsr").cast("string"))
    return people.join(xwalk.select("icpsr", "bonica_rid"), "icpsr", "left")


def contributions_per_legislator(
    legislators: DataFrame, xwalk: DataFrame, contributions: DataFrame, keep_all: bool = False
) -> DataFrame:
    """Count and sum of contributions per legislator, through the crosswalk.

    Contributions are summed per recipient before the joins. ``keep_all`` keeps
    legislators without any, with a NULL total.
    """
    linked = _person_rids(legislators, xwalk).join(
        _recipient_sums(contributions), "bonica_rid", "left" if keep_all else "inner"
    )
    return linked.groupBy("bioguide_id", "bioname", "state_abbrev").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("contribution_count"), F.sum("amount").alias("total_amount")
    )


def legislator_contributions(legislators: DataFrame, xwalk: DataFrame, contributions: DataFrame) -> DataFrame:
    """The single contributions behind the totals."""
    keyed = _person_rids(legislators, xwalk).where(F.col("bonica_rid").isNotNull())
    lookup = keyed.select("bioguide_id", "bioname", c("bonica_rid").alias("bonica.rid"))
    return lookup_join(contributions, lookup, ["bonica.rid"], "inner").select(
        "bioguide_id", "bioname", c("contributor.name").alias("contributor_name"), "amount", "cycle"
    )


def aggregates_per_legislator(
    legislators: DataFrame, xwalk: DataFrame, aggregates: DataFrame, cycle: int
) -> DataFrame:
    """Prepared recipient aggregates of one cycle, per legislator."""
    chosen = aggregates.where(F.col("cycle") == cycle).withColumnRenamed("bonica.rid", "bonica_rid")
    return (
        _person_rids(legislators, xwalk)
        .join(chosen, "bonica_rid")
        .select("bioguide_id", "bioname", "bonica_rid", "total_amount", "organizational_count")
    )


def politician_industry_summary(contributions: DataFrame, politicians: DataFrame) -> DataFrame:
    """Count, sum and average per politician and industry; no industry is a group of its own.

    Sums are formed per recipient first and joined to politicians afterwards.
    """
    amount = F.col("amount")
    grouped = contributions.groupBy(F.col("recipient_id").alias("politician_id"), "industry").agg(
        F.count("*").alias("contribution_count"),
        F.sum(amount).alias("total_amount"),
        F.avg(amount).alias("avg_amount"),
    )
    return grouped.join(politicians.select("politician_id"), "politician_id")


_SUMMARY_KEY = ("politician_id", "industry")


def _summary_sums(contributions: DataFrame) -> DataFrame:
    """What of the industry summary can be added up later."""
    return contributions.groupBy(F.col("recipient_id").alias("politician_id"), "industry").agg(
        F.count("*").alias("n"), F.count("amount").alias("n_amount"), F.sum("amount").alias("total")
    )


def refresh_summary(contributions: DataFrame, root: str, batch: int) -> None:
    """Add a batch of contributions to the stored industry summary below ``root``; batch 0 begins it."""
    merge_sums(_summary_sums(contributions), root, _SUMMARY_KEY, batch)


def stored_summary(spark: SparkSession, root: str, politicians: DataFrame) -> DataFrame:
    """The stored summary as ``politician_industry_summary`` gives it."""
    return (
        read_sums(spark, root)
        .select(
            *_SUMMARY_KEY,
            F.col("n").alias("contribution_count"),
            F.col("total").alias("total_amount"),
            F.when(F.col("n_amount") > 0, F.col("total") / F.col("n_amount")).alias("avg_amount"),
        )
        .join(politicians.select("politician_id"), "politician_id")
    )


def donor_totals(donors: DataFrame, contributions: DataFrame) -> DataFrame:
    """Donors with the number and sum of their contributions, 0 without any."""
    sums = contributions.groupBy("donor_id").agg(
        F.count("*").alias("total_contributions_count"), F.sum("amount").alias("total_amount")
    )
    zero = F.lit(0).cast("decimal(14,2)")
    return donors.join(sums, "donor_id", "left").withColumns(
        {
            "total_contributions_count": F.coalesce("total_contributions_count", F.lit(0)),
            "total_amount": F.coalesce("total_amount", zero),
        }
    )


def with_living_parents(children: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Children whose parent still exists: the outcome of a cascading delete."""
    lookup = parents.select(c(key).alias(column)).distinct()
    return lookup_join(children, lookup, [column], "left_semi").select(*[c(n) for n in children.columns])
