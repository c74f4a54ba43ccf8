"""Legislator dimensions and the crosswalk to contribution recipients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.functions.columns import asc, c
from polfin.functions.congress import DEFAULT_MIN_CONGRESS, congress_of
from polfin.functions.scalars import (
    filled,
    first_filled,
    has_year_suffix,
    split_ids,
    strip_year,
    to_bigint,
    whole_iso_date,
)
from polfin.operators.sets import first_per_key

UNIFIED_TEXT_COLUMNS = (
    "last_name",
    "first_name",
    "full_name",
    "birthday",
    "gender",
    "type",
    "state",
    "party",
)
UNIFIED_COLUMNS = (
    "bioguide_id",
    *UNIFIED_TEXT_COLUMNS,
    "icpsr",
    "fec_ids",
    "opensecrets_id",
    "is_current",
)
# Values taken from a legislator's latest row, and what decides between several
# rows of the same Congress (both chambers, say).
LATEST_COLUMNS = ("icpsr", "bioname", "state_abbrev", "party_code", "nominate_dim1", "nominate_dim2")
LATEST_TIES = ("chamber", *LATEST_COLUMNS)


def served(members: DataFrame, min_congress: int = DEFAULT_MIN_CONGRESS) -> DataFrame:
    """Member rows that count: an identified person in a recent enough Congress."""
    return members.where((F.col("congress") >= min_congress) & F.col("bioguide_id").isNotNull())


def distinct_legislators(members: DataFrame, min_congress: int = DEFAULT_MIN_CONGRESS) -> DataFrame:
    """One row per person: latest values, and every Congress in which they sat.

    Rows are first reduced to one per person and Congress. That bounds what is
    gathered per person by the number of Congresses, however many rows there are,
    and the row count brings repeated Congresses back into the list.
    """
    per_congress = (
        served(members, min_congress)
        .groupBy("bioguide_id", "congress")
        .agg(F.count("*").alias("rows"), F.max(F.struct(*LATEST_TIES)).alias("latest"))
    )
    sittings = F.array_sort(F.collect_list(F.struct("congress", F.col("rows").cast("int").alias("rows"))))
    repeated = F.flatten(F.transform("sittings", lambda s: F.array_repeat(s["congress"], s["rows"])))
    people = per_congress.groupBy("bioguide_id").agg(
        F.max(F.struct("congress", "latest")).alias("last"),
        sittings.alias("sittings"),
        F.min("congress").alias("first_congress"),
        F.max("congress").alias("last_congress"),
    )
    latest = {n: F.col(f"last.latest.{n}") for n in LATEST_COLUMNS}
    return people.select(
        "bioguide_id",
        latest["icpsr"].cast("int").alias("icpsr"),
        latest["bioname"].alias("bioname"),
        latest["state_abbrev"].alias("state_abbrev"),
        latest["party_code"].alias("party_code"),
        repeated.cast("array<smallint>").alias("congresses_served"),
        F.col("first_congress").cast("smallint").alias("first_congress"),
        F.col("last_congress").cast("smallint").alias("last_congress"),
        latest["nominate_dim1"].alias("nominate_dim1"),
        latest["nominate_dim2"].alias("nominate_dim2"),
    )


def _one_source(df: DataFrame, is_current: bool) -> DataFrame:
    return df.where(filled(F.col("bioguide_id"))).select(
        "bioguide_id",
        *UNIFIED_TEXT_COLUMNS,
        to_bigint(F.col("icpsr_id")).alias("icpsr"),
        split_ids(F.col("fec_ids")).alias("fec_ids"),
        "opensecrets_id",
        F.lit(is_current).alias("is_current"),
        F.lit(1 if is_current else 2).alias("source_priority"),
    )


def combined_legislators(current: DataFrame, historical: DataFrame) -> DataFrame:
    """Current and historical legislators in one frame, marked by source."""
    return _one_source(current, True).unionByName(_one_source(historical, False))


def unified_legislators(
    current: DataFrame,
    historical: DataFrame,
    terms: DataFrame | None = None,
    min_congress: int | None = DEFAULT_MIN_CONGRESS,
) -> DataFrame:
    """One row per legislator; the current file wins over the historical one.

    With ``terms`` only people who served in ``min_congress`` or later stay. The
    semi join comes after the ranking: by then there is one row per person, and
    both sides are already partitioned by person.
    """
    combined = combined_legislators(current, historical)
    best = first_per_key(combined, ["bioguide_id"], [asc("source_priority")]).select(*UNIFIED_COLUMNS)
    if terms is None or min_congress is None:
        return best
    return best.join(eligible_people(max_congress(terms), min_congress), "bioguide_id", "left_semi")


def term_congresses(terms: DataFrame) -> DataFrame:
    """One row per person and term: the Congress of its end, else of its start."""
    bioguide = F.col("id.bioguide")
    days = (
        terms.where(filled(bioguide))
        .select(bioguide.alias("bioguide_id"), F.explode("terms").alias("term"))
        .select("bioguide_id", whole_iso_date(first_filled(F.col("term.end"), F.col("term.start"))).alias("day"))
        .where("day IS NOT NULL")
    )
    return days.select("bioguide_id", congress_of(F.col("day")).alias("congress"))


def max_congress(terms: DataFrame) -> DataFrame:
    """Last Congress of every person over all terms."""
    return (
        term_congresses(terms)
        .groupBy("bioguide_id")
        .agg(F.max("congress").alias("max_congress"))
        .where("max_congress > 0")
    )


def eligible_people(max_congresses: DataFrame, min_congress: int) -> DataFrame:
    return max_congresses.where(F.col("max_congress") >= min_congress).select("bioguide_id")


def congress_stats(max_congresses: DataFrame) -> DataFrame:
    """Number of people and the range of their last Congress, in one row."""
    return max_congresses.agg(
        F.count("*").alias("count"),
        F.min("max_congress").alias("min_congress"),
        F.max("max_congress").alias("max_congress"),
    )


def crosswalk_pairs(recipients: DataFrame) -> DataFrame:
    """Recipient rows that carry an id and a year, with the year cut off."""
    icpsr = c("ICPSR").cast("string")
    return recipients.where(filled(icpsr) & has_year_suffix(icpsr) & filled(c("bonica.rid"))).select(
        strip_year(icpsr).alias("icpsr"),
        c("bonica.rid").alias("bonica_rid"),
        c("name").alias("recipient_name"),
        "party",
        "state",
        "seat",
        c("FEC.ID").alias("fec_id"),
    )


def crosswalk(recipients: DataFrame) -> DataFrame:
    """One row per legislator id and recipient id, with a representative description."""
    described = ("recipient_name", "party", "state", "seat", "fec_id")
    return crosswalk_pairs(recipients).groupBy("icpsr", "bonica_rid").agg(*[F.max(n).alias(n) for n in described])


def crosswalk_ratio(xwalk: DataFrame) -> DataFrame:
    """Average number of recipients per legislator, NULL for an empty crosswalk."""
    people = F.nullif(F.count_distinct("icpsr"), F.lit(0))
    return xwalk.agg((F.count_distinct("bonica_rid") / people).alias("recipients_per_legislator"))
