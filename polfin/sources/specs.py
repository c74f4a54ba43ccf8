"""Declared shape of every raw dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from polfin.functions.scalars import EXPORT_BLANK_WORDS, PLAIN_BLANK_WORDS


@dataclass(frozen=True)
class DatasetSpec:
    """Types, checks and text conventions of one raw file type."""

    name: str
    schema: T.StructType
    sum_column: str | None
    key_columns: tuple[str, ...]
    null_markers: tuple[str, ...]
    blank_words: tuple[str, ...]
    encoding: str = "UTF-8"
    # Records may span lines only where free text occurs.
    multi_line: bool = True

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _schema(**columns: str) -> T.StructType:
    """Schema from blocks of column names, one block per type."""
    kinds = {
        "short": T.ShortType(),
        "integer": T.IntegerType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
    }
    return T.StructType(
        [T.StructField(name, kinds[kind]) for kind, block in columns.items() for name in block.split()]
    )


# Column names, key columns and null markers of the public files.
CONTRIBUTIONS = DatasetSpec(
    name="contributions",
    schema=_schema(
        integer="cycle excluded.from.scaling",
        double="amount gis.confidence contributor.cfscore candidate.cfscore",
        string="""
            transaction.id transaction.type date bonica.cid contributor.name contributor.lname
            contributor.fname contributor.mname contributor.suffix contributor.title
            contributor.ffname contributor.type contributor.gender contributor.address
            contributor.city contributor.state contributor.zipcode contributor.occupation
            contributor.employer occ.standardized is.corp recipient.name bonica.rid
            recipient.party recipient.type recipient.state seat election.type latitude longitude
            contributor.district censustract efec.memo efec.memo2 efec.transaction.id.orig
            bk.ref.transaction.id efec.org.orig efec.comid.orig efec.form.type
        """,
    ),
    sum_column="amount",
    key_columns=("transaction.id", "bonica.cid", "contributor.name", "amount"),
    null_markers=("\\N", ""),
    blank_words=EXPORT_BLANK_WORDS,
    encoding="ISO-8859-1",
)

RECIPIENTS = DatasetSpec(
    name="recipients",
    schema=_schema(
        string="""
            election bonica.rid bonica.cid name lname ffname fname mname title suffix party state
            seat district distcyc ico.status cand.gender pwinner gwinner s.elec.stat r.elec.stat
            fec.cand.status recipient.type igcat comtype ICPSR ICPSR2 Cand.ID FEC.ID NID
            before.switch.ICPSR after.switch.ICPSR party.orig nimsp.party
            nimsp.candidate.ICO.code nimsp.district nimsp.office nimsp.candidate.status
            included_in_scaling
        """,
        double="""
            cycle fecyear num.givers num.givers.total recipient.cfscore recipient.cfscore.dyn
            contributor.cfscore dwdime dwnom1 dwnom2 ps.dwnom1 ps.dwnom2 irt.cfscore
            composite.score total.receipts total.disbursements total.indiv.contribs
            total.unitemized total.pac.contribs total.party.contribs
            total.contribs.from.candidate ind.exp.support ind.exp.oppose prim.vote.pct
            gen.vote.pct district.pres.vs
        """,
    ),
    sum_column="recipient.cfscore",
    key_columns=("bonica.rid", "bonica.cid", "name"),
    null_markers=("\\N", ""),
    blank_words=EXPORT_BLANK_WORDS,
    encoding="ISO-8859-1",
)

CONTRIBUTORS = DatasetSpec(
    name="contributors",
    schema=_schema(
        string="""
            bonica.cid contributor.type most.recent.contributor.name
            most.recent.contributor.address most.recent.contributor.city
            most.recent.contributor.zipcode most.recent.contributor.state
            most.recent.contributor.occupation most.recent.contributor.employer
            most.recent.transaction.id most.recent.transaction.date contributor.gender is.corp
            is.projected
        """,
        double="""
            num.distinct most.recent.contributor.latitude most.recent.contributor.longitude
            contributor.cfscore first_cycle_active last_cycle_active
        """
        + " ".join(f"amount.{year}" for year in range(1980, 2025, 2)),
    ),
    sum_column="contributor.cfscore",
    key_columns=("bonica.cid", "most.recent.contributor.name"),
    null_markers=("\\N", ""),
    blank_words=EXPORT_BLANK_WORDS,
    encoding="ISO-8859-1",
)

MEMBERS = DatasetSpec(
    name="members",
    schema=_schema(
        short="congress",
        integer="icpsr",
        double="""
            state_icpsr district_code party_code occupancy last_means nominate_number_of_votes
            nominate_number_of_errors born died nominate_dim1 nominate_dim2
            nominate_log_likelihood nominate_geo_mean_probability conditional nokken_poole_dim1
            nokken_poole_dim2
        """,
        string="chamber state_abbrev bioname bioguide_id",
    ),
    sum_column="nominate_number_of_votes",
    key_columns=("icpsr", "congress", "chamber", "bioname"),
    null_markers=("", "N/A"),
    blank_words=PLAIN_BLANK_WORDS,
)

ROLLCALLS = DatasetSpec(
    name="rollcalls",
    schema=_schema(
        short="congress",
        integer="rollnumber yea_count nay_count",
        double="""
            session clerk_rollnumber nominate_mid_1 nominate_mid_2 nominate_spread_1
            nominate_spread_2 nominate_log_likelihood
        """,
        string="chamber date bill_number vote_result vote_desc vote_question dtl_desc",
    ),
    sum_column="yea_count",
    key_columns=("congress", "chamber", "rollnumber", "date"),
    null_markers=("", "N/A"),
    blank_words=PLAIN_BLANK_WORDS,
)

VOTES = DatasetSpec(
    name="votes",
    schema=_schema(
        short="congress",
        double="rollnumber icpsr cast_code prob",
        string="chamber",
    ),
    sum_column="cast_code",
    key_columns=("congress", "chamber", "rollnumber", "icpsr", "cast_code"),
    null_markers=("", "N/A"),
    blank_words=PLAIN_BLANK_WORDS,
    multi_line=False,
)

LEGISLATORS = DatasetSpec(
    name="legislators",
    schema=_schema(
        string="""
            last_name first_name middle_name suffix nickname full_name birthday gender type state
            district senate_class party url address phone contact_form rss_url twitter twitter_id
            facebook youtube youtube_id mastodon bioguide_id thomas_id opensecrets_id lis_id
            fec_ids cspan_id govtrack_id votesmart_id ballotpedia_id washington_post_id icpsr_id
            wikipedia_id
        """
    ),
    sum_column=None,
    key_columns=("bioguide_id", "icpsr_id", "state", "type"),
    null_markers=("",),
    blank_words=PLAIN_BLANK_WORDS,
)

SPECS = {
    s.name: s for s in (CONTRIBUTIONS, RECIPIENTS, CONTRIBUTORS, MEMBERS, ROLLCALLS, VOTES, LEGISLATORS)
}

# Default projection of a subset load.
DEFAULT_CONTRIBUTION_COLUMNS = tuple(
    """
    cycle transaction.id transaction.type amount date bonica.cid contributor.name contributor.type
    contributor.state contributor.occupation contributor.employer contributor.cfscore bonica.rid
    recipient.name recipient.party recipient.type recipient.state candidate.cfscore seat
    election.type occ.standardized
    """.split()
)

# Nested term file: only the fields that are used.
TERMS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StructType([T.StructField("bioguide", T.StringType())])),
        T.StructField(
            "terms",
            T.ArrayType(
                T.StructType([T.StructField("start", T.StringType()), T.StructField("end", T.StringType())])
            ),
        ),
    ]
)
