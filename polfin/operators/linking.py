"""Linking recipients, and through them contributions, to legislators.

A recipient's ``ICPSR`` is an id followed by a four-digit year. Where the id was
issued by the election commission it starts with H or S and appears in some
legislator's ``fec_ids``; other ids never link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.functions.columns import c
from polfin.functions.scalars import has_year_suffix, is_fec_style, non_empty_array, strip_year
from polfin.operators.joins import lookup_join
from polfin.sources.sinks import stored_copy

LINK_MODES = ("all", "best")


def fec_lookup(legislators: DataFrame) -> DataFrame:
    """One row per legislator and candidate id."""
    return legislators.where(non_empty_array(F.col("fec_ids"))).select(
        "bioguide_id", F.explode("fec_ids").alias("fec_id")
    )


def recipients_with_person(recipients: DataFrame, legislators: DataFrame) -> DataFrame:
    """Distinct (bonica.rid, bioguide_id) pairs; unlinked recipients keep a NULL person.

    A recipient's ids of several years become one before the join. The prefix
    test stays inside the join condition: as a filter it would drop the recipients
    that cannot link.
    """
    icpsr = c("ICPSR").cast("string")
    usable = icpsr.isNotNull() & has_year_suffix(icpsr)
    left = recipients.where(usable).select(c("bonica.rid"), strip_year(icpsr).alias("id")).distinct()
    right = fec_lookup(legislators)
    matches = (F.col("id") == F.col("fec_id")) & is_fec_style(F.col("id"))
    return left.join(right, matches, "left").select(c("bonica.rid"), "bioguide_id").distinct()


def link_table(recipients: DataFrame, legislators: DataFrame, mode: str = "all") -> DataFrame:
    """The pairs a left join needs, and no others.

    A recipient with only a NULL person joins to the same result as a recipient
    that is absent, so it is left out; about nine in ten are, which keeps the
    table small enough to broadcast.

    ``all`` keeps every pair, also the NULL one beside a match, and so repeats a
    contribution once per pair. ``best`` keeps the matches only, the smallest
    person id if several people share a recipient, and repeats nothing.
    """
    if mode not in LINK_MODES:
        raise ValueError(f"link mode must be one of {LINK_MODES}")
    pairs = recipients_with_person(recipients, legislators)
    found = F.col("bioguide_id").isNotNull()
    if mode == "best":
        return pairs.where(found).groupBy(c("bonica.rid")).agg(F.min("bioguide_id").alias("bioguide_id"))
    linked = pairs.where(found).select(c("bonica.rid")).distinct()
    return pairs.join(linked, ["bonica.rid"], "left_semi")


def ambiguous_recipients(recipients: DataFrame, legislators: DataFrame) -> DataFrame:
    """Recipients that belong to more than one person."""
    pairs = recipients_with_person(recipients, legislators).where("bioguide_id IS NOT NULL")
    return pairs.groupBy(c("bonica.rid")).agg(F.count("*").alias("persons")).where("persons > 1")


def link(
    df: DataFrame,
    recipients: DataFrame | None,
    legislators: DataFrame | None,
    mode: str = "all",
    links: DataFrame | None = None,
) -> DataFrame:
    """Add ``bioguide_id`` in front; rows without a person keep NULL.

    ``links`` is a stored link table to be used; without one it is computed here,
    once, and stored.
    """
    table = stored_copy(link_table(recipients, legislators, mode), "links") if links is None else links
    names = df.columns
    return lookup_join(df, table, ["bonica.rid"], "left", is_stored=True).select("bioguide_id", *[c(n) for n in names])
