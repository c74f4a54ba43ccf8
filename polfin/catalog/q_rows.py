"""Queries over predicates, row caps, scalar functions and set operations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.registry import money_sql, query, rounded
from polfin.catalog.standins import load, select, table, terms
from polfin.catalog.stored import contributions_root
from polfin.functions import congress as congresses
from polfin.functions import scalars
from polfin.functions.columns import asc, c, desc
from polfin.operators import predicates as p
from polfin.operators.limits import first_rows, limit_by_cycle, sample_keys, sample_rows, top_k
from polfin.operators.linking import fec_lookup
from polfin.operators.sets import difference, key_counts, union_tagged
from polfin.plans import dimensions, marts

ALL = 'SELECT "transaction.id", {columns} FROM contributions WHERE {where}'


def _filtered(name: str, predicate: p.Predicate, columns: Sequence[str], where: str) -> None:
    """Register a filter query that returns the transaction and the tested columns."""
    quoted = ", ".join(f'"{n}"' for n in columns)

    @query(name, ALL.format(columns=quoted, where=where))
    def _(spark, sf):
        rows = load(spark, sf, "contributions", ["transaction.id", *columns])
        return p.where_all(rows, [predicate])


_filtered("f01_cycle", p.CycleIn([1996, 2000]), ["cycle"], "cycle IN (1996, 2000)")
_filtered(
    "f02_state",
    p.StateIn(["NATION_1", "NATION_7"]),
    ["contributor.state"],
    "\"contributor.state\" IN ('NATION_1', 'NATION_7')",
)
_filtered(
    "f02_recipient_state",
    p.StateIn(["NATION_3"], "recipient.state"),
    ["recipient.state"],
    "\"recipient.state\" = 'NATION_3'",
)
_filtered("f03_amount_range", p.AmountBetween(5000, 20000), ["amount"], "amount BETWEEN 5000 AND 20000")
_filtered("f03_amount_known", p.AmountBetween(), ["amount"], "amount IS NOT NULL")
_filtered(
    "f04_date_range",
    p.DateBetween(dt.date(1997, 3, 1), dt.date(1998, 6, 30)),
    ["date"],
    "TRY_CAST(date AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1998-06-30'",
)
_filtered(
    "f04_date_from", p.DateBetween(start=dt.date(2000, 1, 1)), ["date"], "TRY_CAST(date AS DATE) >= DATE '2000-01-01'"
)
_filtered("f04_date_known", p.DateBetween(), ["date"], "TRY_CAST(date AS DATE) IS NOT NULL")
_filtered(
    "f05_all_of",
    p.AllOf([p.CycleIn([1998]), p.AmountBetween(low=10000), p.StateIn(["NATION_2"])]),
    ["cycle", "amount", "contributor.state"],
    "cycle = 1998 AND amount >= 10000 AND \"contributor.state\" = 'NATION_2'",
)
_filtered("f06_recent_cycles", p.recent_cycles(2, latest=2000), ["cycle"], "cycle IN (1998, 2000)")
_filtered("f07_large_donors", p.large_donors(), ["amount"], "amount >= 1000")
_filtered("f08_federal", p.federal_races(), ["seat"], "regexp_matches(seat, '^(federal:|president|senate|house)')")
_filtered(
    "f09_single_state_or",
    p.single_state("nation_5"),
    ["contributor.state", "recipient.state"],
    "'NATION_5' IN (\"contributor.state\", \"recipient.state\")",
)
_filtered(
    "f09_single_state_contributor",
    p.single_state("nation_5", include_recipients=False),
    ["contributor.state"],
    "\"contributor.state\" = 'NATION_5'",
)
_filtered("f13_cycle_range", p.CycleBetween(1998, 2000), ["cycle"], "cycle BETWEEN 1998 AND 2000")
_filtered("f14_organizational", p.Organizational(), ["contributor.type"], "\"contributor.type\" <> 'I'")
_filtered("f15_filled_keys", p.Filled(["seat", "date"]), ["seat", "date"], "seat <> '' AND date <> ''")


@query(
    "f10_where_all",
    """SELECT "transaction.id", cycle, amount, seat FROM contributions
       WHERE cycle IN (1996, 1998) AND amount <= 30000 AND seat LIKE 'federal:%'""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "cycle", "amount", "seat"])
    # Two cycle predicates agree on 1996 and 1998.
    tests = [p.CycleIn([1996, 1998, 2000]), p.CycleIn([1996, 1998]), p.AmountBetween(high=30_000), p.federal_races()]
    return p.where_all(rows, tests)


@query(
    "f12_valid_cycle",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS cycle FROM orders WHERE year(o_orderdate) % 2 = 0""",
)
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("cycle"))
    return rows.where(p.valid_cycle_column())


@query("f16_min_congress", f"SELECT bioguide_id, congress FROM ({sql.SERVED})")
def _(spark, sf):
    return dimensions.served(load(spark, sf, "members")).select("bioguide_id", "congress")


@query("f17_length_guard", 'SELECT "bonica.rid", "ICPSR" FROM recipients WHERE length("ICPSR") > 4')
def _(spark, sf):
    rows = load(spark, sf, "recipients", ["bonica.rid", "ICPSR"])
    return rows.where(scalars.has_year_suffix(c("ICPSR")))


def _people(spark, sf):
    return dimensions.unified_legislators(
        load(spark, sf, "legislators_current"), load(spark, sf, "legislators_historical")
    )


@query("f18_non_empty_array", f"SELECT bioguide_id FROM ({sql.PEOPLE}) WHERE len(fec_ids) > 0")
def _(spark, sf):
    return _people(spark, sf).where(scalars.non_empty_array(F.col("fec_ids"))).select("bioguide_id")


@query("f19_eligible_people", f"SELECT bioguide_id FROM ({sql.MAX_CONGRESS}) WHERE max_congress >= 98")
def _(spark, sf):
    return dimensions.eligible_people(dimensions.max_congress(terms(spark, sf)), 98)


@query(
    "f20_vocabulary",
    """SELECT "transaction.id", "recipient.party" FROM contributions WHERE "recipient.party" IN ('D', 'R')""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "recipient.party"])
    return rows.where(c("recipient.party").isin("D", "R"))


# ---------------------------------------------------------- order, caps, samples


@query("o01_by_total", f"SELECT cycle, \"bonica.rid\", total_amount FROM ({sql.AGGREGATES})")
def _(spark, sf):
    totals = marts.by_total(marts.recipient_aggregates(load(spark, sf, "contributions")))
    return rounded(select(totals, "cycle", "bonica.rid", "total_amount"), "total_amount")


@query("o02_by_key", f"SELECT icpsr, bonica_rid FROM ({sql.CROSSWALK})")
def _(spark, sf):
    pairs = dimensions.crosswalk(load(spark, sf, "recipients"))
    return pairs.orderBy(asc("icpsr"), asc("bonica_rid")).select("icpsr", "bonica_rid")


@query(
    "o03_top_k",
    f"""SELECT "bonica.cid", {money_sql("SUM(amount)")} AS total FROM contributions GROUP BY "bonica.cid"
        ORDER BY total DESC NULLS LAST, "bonica.cid" LIMIT 20""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["bonica.cid", "amount"])
    totals = rows.groupBy(c("bonica.cid")).agg(F.sum("amount").alias("total"))
    return top_k(rounded(totals, "total"), [desc("total"), asc("bonica.cid")], 20)


_CAPPED = """
    WITH sizes AS (SELECT cycle, COUNT(*) AS n FROM contributions GROUP BY cycle),
         caps AS (SELECT cycle, n, SUM(n) OVER (ORDER BY cycle) AS upto, (SELECT SUM(n) * 2 // 5 FROM sizes) AS cap
                  FROM sizes)
    SELECT cycle, CAST(least(n, cap - (upto - n)) AS BIGINT) AS rows FROM caps WHERE cap > upto - n"""


@query("o04_limit_by_cycle", _CAPPED)
def _(spark, sf):
    rows = select(spark.read.parquet(contributions_root(spark, sf)), "cycle", "transaction.id", "amount")
    limit = rows.count() * 2 // 5
    return limit_by_cycle(rows, limit, p.ALL_CYCLES, positions=True).groupBy("cycle").agg(F.count("*").alias("rows"))


@query(
    "o04_capped_rows",
    """WITH n AS (SELECT COUNT(*) * 2 // 5 AS cap FROM contributions) SELECT cap AS rows, cap AS found FROM n""",
)
def _(spark, sf):
    """Each capped row is one of the table, and comes no more often than there."""
    rows = select(spark.read.parquet(contributions_root(spark, sf)), "cycle", "transaction.id", "amount")
    counts = key_counts(limit_by_cycle(rows, rows.count() * 2 // 5), rows, rows.columns)
    return counts.agg(F.sum("in_left").alias("rows"), F.sum(F.least("in_left", "in_right")).alias("found"))


@query(
    "o04_first_rows",
    """SELECT o_orderkey, half FROM (
         (SELECT o_orderkey, FALSE AS half FROM orders LIMIT 100)
         UNION ALL (SELECT o_orderkey, TRUE FROM orders LIMIT (SELECT COUNT(*) // 2 FROM orders)))""",
)
def _(spark, sf):
    """Which rows come out of a small and of a large cap on a file: those that stand first."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    caps = {False: 100, True: orders.count() // 2}
    small, large = (first_rows(orders, n, positions=True).withColumn("half", F.lit(k)) for k, n in caps.items())
    return small.unionByName(large)


@query(
    "o04_same_rows",
    """SELECT least(50, COUNT(*)) AS small, COUNT(*) // 3 AS large, small AS small_again, large AS large_again
       FROM lineitem""",
)
def _(spark, sf):
    """A cap by content, of rows as read and dealt anew: the same rows, with their copies."""
    rows = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    anew = rows.repartition(5, "l_quantity")
    out = None
    for name, n in (("small", 50), ("large", rows.count() // 3)):
        counts = key_counts(first_rows(rows, n), first_rows(anew, n), rows.columns)
        both = counts.agg(F.sum("in_left").alias(name), F.sum(F.least("in_left", "in_right")).alias(f"{name}_again"))
        out = both if out is None else out.crossJoin(both)  # one row each
    return out


_SAMPLES = """SELECT least(100, COUNT(*)) AS small, COUNT(*) // 2 AS large, small AS small_found, large AS large_found,
                     small AS small_again, large AS large_again FROM """


@query("o07_row_sample", _SAMPLES + "orders")
def _(spark, sf):
    """Rows drawn, how many of them are different rows of the table, and how many a second run draws too."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    return _sampled(orders, "o_orderkey", lambda df, n: sample_rows(df, n, seed=7, positions=True), orders)


@query("o08_key_sample", _SAMPLES + """(SELECT DISTINCT "bonica.rid" FROM contributions WHERE "bonica.rid" IS NOT NULL)""")
def _(spark, sf):
    """Keys drawn, as for rows; the second run draws from rows dealt anew."""
    rows = load(spark, sf, "contributions", ["bonica.rid"])
    return _sampled(rows, "bonica.rid", lambda df, n: sample_keys(df, ["bonica.rid"], n, seed=7), rows.repartition(5))


def _sampled(rows, key, draw, anew):
    known = rows.where(c(key).isNotNull()).distinct()
    large, out = known.count() // 2, None
    for name, n in (("small", 100), ("large", large)):
        first = draw(rows, n).withColumn("drawn", F.lit(1))
        second = draw(anew, n).withColumn("again", F.lit(1))
        met = known.join(first, [key], "left").join(second, [key], "left")
        counts = met.agg(
            F.count("drawn").alias(f"{name}_found"), F.sum(F.col("drawn") * F.col("again")).alias(f"{name}_again")
        ).crossJoin(first.agg(F.count("*").alias(name)))  # one row each
        out = counts if out is None else out.crossJoin(counts)
    return out


# ---------------------------------------------------------------- set operations


@query(
    "u01_union_all_tagged",
    """SELECT bioguide_id, 'current' AS source FROM legislators_current
       UNION ALL SELECT bioguide_id, 'historical' FROM legislators_historical""",
)
def _(spark, sf):
    frames = {n: load(spark, sf, f"legislators_{n}", ["bioguide_id"]) for n in ("current", "historical")}
    return union_tagged(frames, "source")


@query(
    "u02_union_distinct",
    """SELECT COUNT(bioguide_id) AS people FROM (SELECT bioguide_id FROM legislators_current
       UNION SELECT bioguide_id FROM legislators_historical)""",
)
def _(spark, sf):
    ids = [load(spark, sf, f"legislators_{n}", ["bioguide_id"]) for n in ("current", "historical")]
    return ids[0].union(ids[1]).distinct().agg(F.count("bioguide_id").alias("people"))


@query(
    "u03_distinct_rows",
    'SELECT DISTINCT "contributor.name", "bonica.rid", "transaction.type", "election.type" FROM contributions',
)
def _(spark, sf):
    names = ["contributor.name", "bonica.rid", "transaction.type", "election.type"]
    return load(spark, sf, "contributions", names).distinct()


@query(
    "u05_many_cycles",
    "SELECT cycle, COUNT(*) AS rows FROM contributions WHERE cycle IN (1996, 1998, 2000) GROUP BY cycle",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["cycle"]).where(F.col("cycle").isin(1996, 1998, 2000))
    return rows.groupBy("cycle").agg(F.count("*").alias("rows"))


@query(
    "u06_except",
    """SELECT bioguide_id, state FROM legislators_historical EXCEPT SELECT bioguide_id, state
       FROM legislators_current""",
)
def _(spark, sf):
    a, b = (load(spark, sf, f"legislators_{n}", ["bioguide_id", "state"]) for n in ("historical", "current"))
    return difference(a, b)


# -------------------------------------------------------------- scalar functions


@query(
    "d01_strip_year",
    """SELECT "bonica.rid", CASE WHEN length("ICPSR") <= 4 THEN '' ELSE left("ICPSR", -4) END AS id FROM recipients""",
)
def _(spark, sf):
    return load(spark, sf, "recipients").select(c("bonica.rid"), scalars.strip_year(c("ICPSR")).alias("id"))


@query("d02_prefix", """SELECT "bonica.rid", regexp_matches("ICPSR", '^[HS]') AS fec FROM recipients""")
def _(spark, sf):
    return load(spark, sf, "recipients").select(c("bonica.rid"), scalars.is_fec_style(c("ICPSR")).alias("fec"))


@query(
    "d03_tolerant_cast",
    r"""SELECT full_name, CASE WHEN regexp_matches(t, '^[0-9]+([.][0-9]+)?$') THEN CAST(round(CAST(t AS DECIMAL(28,10))) AS BIGINT) END AS icpsr
       FROM (SELECT full_name, CASE length(full_name) % 3 WHEN 0 THEN icpsr_id || '.7' WHEN 1 THEN icpsr_id || '.2' ELSE icpsr_id END AS t
             FROM (SELECT full_name, icpsr_id FROM legislators_current UNION ALL SELECT full_name, icpsr_id FROM legislators_historical))""",
)
def _(spark, sf):
    rows = load(spark, sf, "legislators_current", ["full_name", "icpsr_id"]).unionByName(
        load(spark, sf, "legislators_historical", ["full_name", "icpsr_id"])
    )
    text = F.expr("CASE length(full_name) % 3 WHEN 0 THEN icpsr_id || '.7' WHEN 1 THEN icpsr_id || '.2' ELSE icpsr_id END")
    return rows.select("full_name", scalars.to_bigint(text).alias("icpsr"))


@query("d04_congress_number", f"SELECT bioguide_id, day, {sql.congress('day')} AS congress FROM ({sql.TERM_DAYS})")
def _(spark, sf):
    rows = load(spark, sf, "term_rows")
    days = rows.where(scalars.filled(F.col("bioguide"))).select(
        F.col("bioguide").alias("bioguide_id"),
        F.explode(
            F.array(
                scalars.first_filled(F.col("end1"), F.col("start1")),
                scalars.first_filled(F.col("end2"), F.col("start2")),
            )
        ).alias("text"),
    )
    parsed = days.select("bioguide_id", scalars.whole_iso_date(F.col("text")).alias("day")).where("day IS NOT NULL")
    return parsed.withColumn("congress", congresses.congress_of(F.col("day")))


@query(
    "d05_congress_years",
    """SELECT DISTINCT congress, CAST(1787 + 2 * congress AS INT) AS starts, CAST(1789 + 2 * congress AS INT) AS ends,
              CAST(1787 + 2 * congress AS INT) AS first_year, CAST(1788 + 2 * congress AS INT) AS second_year
       FROM members""",
)
def _(spark, sf):
    congress = F.col("congress")
    years = congresses.congress_years(congress)
    return (
        load(spark, sf, "members", ["congress"])
        .distinct()
        .select(
            "congress",
            congresses.congress_start_year(congress).alias("starts"),
            congresses.congress_end_year(congress).alias("ends"),
            years["start_year"].alias("first_year"),
            years["end_year"].alias("second_year"),
        )
    )


@query("d07_iso_date", 'SELECT "transaction.id", TRY_CAST(date AS DATE) AS day FROM contributions')
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "date"])
    return rows.select(c("transaction.id"), scalars.iso_date(F.col("date")).alias("day"))


@query(
    "d08_first_filled",
    """SELECT bioguide, CASE WHEN end1 <> '' THEN end1 WHEN start1 <> '' THEN start1 END AS chosen,
              CASE WHEN end2 <> '' THEN end2 WHEN start2 <> '' THEN start2 END AS chosen2 FROM term_rows""",
)
def _(spark, sf):
    return load(spark, sf, "term_rows").select(
        "bioguide",
        scalars.first_filled(F.col("end1"), F.col("start1")).alias("chosen"),
        scalars.first_filled(F.col("end2"), F.col("start2")).alias("chosen2"),
    )


@query(
    "d09_split_ids",
    """SELECT full_name, len(ids) AS n, ids[1] AS first_id, ids[2] AS second_id FROM (
         SELECT full_name, CASE WHEN fec_ids <> '' THEN string_split(fec_ids, ',') ELSE [] END AS ids
         FROM (SELECT full_name, fec_ids FROM legislators_current UNION ALL SELECT full_name, fec_ids FROM legislators_historical))""",
)
def _(spark, sf):
    ids = scalars.split_ids(F.col("fec_ids"))
    both = [load(spark, sf, f"legislators_{n}", ["full_name", "fec_ids"]) for n in ("current", "historical")]
    return both[0].unionByName(both[1]).select(
        "full_name",
        F.size(ids).cast("bigint").alias("n"),
        F.get(ids, 0).alias("first_id"),
        F.get(ids, 1).alias("second_id"),
    )


@query("d11_unnest", f"SELECT bioguide_id, unnest(fec_ids) AS fec_id FROM ({sql.PEOPLE})")
def _(spark, sf):
    return fec_lookup(_people(spark, sf))


@query(
    "d12_array_equality",
    f"""SELECT bioguide_id, fec_ids = list_sort(fec_ids) AS in_order FROM ({sql.PEOPLE})""",
)
def _(spark, sf):
    in_order = (F.col("fec_ids") == F.array_sort("fec_ids")).alias("in_order")
    return _people(spark, sf).select("bioguide_id", in_order)


@query("d13_nested_field", "SELECT bioguide AS bioguide_id FROM term_rows WHERE bioguide > ''")
def _(spark, sf):
    bioguide = F.col("id.bioguide")
    return terms(spark, sf).where(scalars.filled(bioguide)).select(bioguide.alias("bioguide_id"))


@query(
    "d14_normal_values",
    r"""SELECT doc_id, CASE WHEN lower(regexp_replace(t, '^\s+|\s+$', '', 'g')) IN ('nan', 'n/a', 'na', 'null')
                             OR t = '' THEN NULL
                       ELSE regexp_replace(t, '^\s+|\s+$', '', 'g') END AS value,
               CASE WHEN doc_id % 4 = 0 THEN NULL ELSE ROUND(n_chars / 7 + 1e-9, 6) END AS number
        FROM (SELECT doc_id, n_chars, CASE WHEN doc_id % 6 = 0 THEN ' NaN ' WHEN doc_id % 7 = 0 THEN ''
                     WHEN doc_id % 5 = 0 THEN 'N/A' ELSE '  ' || text || E'\n' END AS t FROM documents)""",
)
def _(spark, sf):
    text = F.expr(
        """CASE WHEN doc_id % 6 = 0 THEN ' NaN ' WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 5 = 0 THEN 'N/A'
           ELSE '  ' || text || '\n' END"""
    )
    number = F.when(F.col("doc_id") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("n_chars") / 7 + 1e-9)
    return table(spark, sf, "documents").select(
        "doc_id", scalars.normal_text(text).alias("value"), scalars.normal_number(number).alias("number")
    )


@query(
    "d15_same_value",
    """SELECT l_orderkey, l_linenumber, l_quantity = 7 OR l_linenumber % 3 <> 0 AS same,
              l_suppkey % 2 = 0 AS same_text FROM lineitem""",
)
def _(spark, sf):
    a, shift = F.col("l_quantity"), F.when(F.col("l_linenumber") % 3 == 0, 0.5).otherwise(1e-8)
    b = F.when(a == 7, a).otherwise(a + shift)
    name = F.when(F.col("l_suppkey") % 2 == 0, "Nan").otherwise("nan")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        scalars.same_value(a, b.cast("string")).alias("same"),
        scalars.same_value(F.lit("Nan"), name).alias("same_text"),
    )


@query(
    "d16_relative_tolerance",
    """SELECT l_orderkey, l_linenumber, TRUE AS close, l_extendedprice * 5e-7 <= 0.009 AS cent FROM lineitem""",
)
def _(spark, sf):
    price = F.col("l_extendedprice")
    moved = price * (1 + 5e-7)
    exact = F.when(price * 5e-7 <= 0.009, price).otherwise(price + 0.02)
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        scalars.within_relative(moved, price).alias("close"),
        scalars.within_cent(exact, price).alias("cent"),
    )


@query(
    "d21_decode",
    """SELECT m.icpsr, m.congress,
              CASE m.party_code WHEN 100 THEN 'Democrat' WHEN 200 THEN 'Republican' WHEN 328 THEN 'Independent'
              END AS party FROM members m""",
)
def _(spark, sf):
    return load(spark, sf, "members").select("icpsr", "congress", scalars.party_name(F.col("party_code")).alias("party"))


@query(
    "d21_decode_casts",
    """SELECT icpsr, rollnumber, ['Yea', 'Paired Yea', 'Announced Yea', 'Announced Nay', 'Paired Nay', 'Nay',
              'Present (not voting)', 'Present (Abstain)', 'Not in legislature'][CAST(cast_code AS INT)] AS cast_name
       FROM rollcall_casts""",
)
def _(spark, sf):
    return load(spark, sf, "rollcall_casts").select(
        "icpsr", "rollnumber", scalars.cast_name(F.col("cast_code")).alias("cast_name")
    )


@query(
    "d21_decode_contributors",
    """SELECT "transaction.id", CASE "contributor.type" WHEN 'C' THEN 'Committee' WHEN 'L' THEN 'Corporation'
              WHEN 'P' THEN 'PAC' END AS kind FROM contributions""",
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["transaction.id", "contributor.type"])
    return rows.select(c("transaction.id"), scalars.contributor_type_name(c("contributor.type")).alias("kind"))


@query(
    "d22_percent",
    f"""SELECT "bonica.rid", {money_sql("100.0 * COUNT(*) FILTER (seat LIKE 'federal:%') / COUNT(*)")} AS federal_pct
        FROM contributions GROUP BY "bonica.rid" """,
)
def _(spark, sf):
    rows = load(spark, sf, "contributions", ["bonica.rid", "seat"])
    counts = rows.groupBy(c("bonica.rid")).agg(
        F.count_if(p.federal_races().to_column()).alias("federal"), F.count("*").alias("n")
    )
    shares = counts.select(c("bonica.rid"), scalars.percent(F.col("federal"), F.col("n")).alias("federal_pct"))
    return rounded(shares, "federal_pct")
