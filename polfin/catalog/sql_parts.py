"""SQL fragments shared by several checks, in the dialect of the checking engine."""

_PERSON = """bioguide_id, last_name, first_name, full_name, birthday, gender, "type", state, party,
    TRY_CAST(icpsr_id AS BIGINT) AS icpsr,
    CASE WHEN coalesce(fec_ids, '') = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(fec_ids, ',') END AS fec_ids,
    opensecrets_id"""

# Ids are unique within either source, so "current wins" is a plain anti join.
PEOPLE = f"""
    SELECT {_PERSON}, TRUE AS is_current FROM legislators_current WHERE bioguide_id > ''
    UNION ALL
    SELECT {_PERSON}, FALSE AS is_current FROM legislators_historical h
    WHERE bioguide_id > ''
      AND NOT EXISTS (SELECT 1 FROM legislators_current k WHERE k.bioguide_id = h.bioguide_id)"""

PAIRS = """
    SELECT DISTINCT r."bonica.rid" AS rid, p.bioguide_id
    FROM recipients r
    LEFT JOIN (SELECT bioguide_id, unnest(fec_ids) AS fec_id FROM people) p
      ON left(r."ICPSR", -4) = p.fec_id AND left(r."ICPSR", 1) IN ('H', 'S')
    WHERE length(r."ICPSR") > 4"""

LINKED = f"WITH people AS ({PEOPLE}), pairs AS ({PAIRS})"

CROSSWALK = """
    SELECT left("ICPSR", -4) AS icpsr, "bonica.rid" AS bonica_rid, max(name) AS recipient_name,
           max(party) AS party, max(state) AS state, max(seat) AS seat, max("FEC.ID") AS fec_id
    FROM recipients WHERE length("ICPSR") > 4 AND "bonica.rid" > '' GROUP BY ALL"""

SERVED = "SELECT * FROM members WHERE congress >= 96 AND bioguide_id IS NOT NULL"

_LATEST_ORDER = ", ".join(
    f"{n} DESC NULLS LAST"
    for n in "congress chamber icpsr bioname state_abbrev party_code nominate_dim1 nominate_dim2".split()
)
LATEST = f"""
    SELECT bioguide_id, congress, icpsr, bioname, state_abbrev, party_code, nominate_dim1, nominate_dim2
    FROM ({SERVED}) QUALIFY row_number() OVER (PARTITION BY bioguide_id ORDER BY {_LATEST_ORDER}) = 1"""

DISTINCT_PEOPLE = f"""
    SELECT t.bioguide_id, t.icpsr, t.bioname, t.state_abbrev, t.party_code, g.congresses_served,
           g.first_congress, g.last_congress, t.nominate_dim1, t.nominate_dim2
    FROM ({LATEST}) t JOIN (
        SELECT bioguide_id, list_sort(list(congress)) AS congresses_served,
               CAST(min(congress) AS SMALLINT) AS first_congress, CAST(max(congress) AS SMALLINT) AS last_congress
        FROM ({SERVED}) GROUP BY bioguide_id) g USING (bioguide_id)"""

AGGREGATES = """
    SELECT cycle, "bonica.rid", "recipient.name", "recipient.party", "recipient.type", "recipient.state",
           "candidate.cfscore",
           ROUND(SUM(amount) + 1e-7, 2) AS total_amount,
           ROUND(AVG(amount) + 1e-7, 2) AS avg_amount,
           COUNT(*) AS contribution_count,
           ROUND(coalesce(SUM(amount) FILTER ("contributor.type" = 'I'), 0) + 1e-7, 2) AS individual_total,
           COUNT(*) FILTER ("contributor.type" = 'I') AS individual_count,
           ROUND(coalesce(SUM(amount) FILTER ("contributor.type" <> 'I'), 0) + 1e-7, 2) AS organizational_total,
           COUNT(*) FILTER ("contributor.type" <> 'I') AS organizational_count
    FROM contributions WHERE "bonica.rid" IS NOT NULL
    GROUP BY cycle, "bonica.rid", "recipient.name", "recipient.party", "recipient.type", "recipient.state",
             "candidate.cfscore" """

_DAY = """TRY_CAST(CASE WHEN length(d) = 10 THEN d END AS DATE)"""
TERM_DAYS = f"""
    SELECT bioguide AS bioguide_id, {_DAY} AS day FROM (
        SELECT bioguide, coalesce(nullif(end1, ''), nullif(start1, '')) AS d FROM term_rows
        UNION ALL SELECT bioguide, coalesce(nullif(end2, ''), nullif(start2, '')) FROM term_rows)
    WHERE bioguide > '' AND {_DAY} IS NOT NULL"""


def congress(day: str) -> str:
    """Congress on a day: shifting the day back two days moves 1 and 2 January
    into the year before, which changes the Congress in odd years only."""
    return f"CAST((year({day} - INTERVAL 2 DAY) - 1789) // 2 + 1 AS INTEGER)"


MAX_CONGRESS = f"SELECT bioguide_id, max({congress('day')}) AS max_congress FROM ({TERM_DAYS}) GROUP BY bioguide_id"
