"""The library's datasets, derived from the given test tables.

Each dataset is one SELECT written in SQL that Spark and the checking engine both
understand; only the quoting of dotted column names differs. Thus both sides
start from the same rows, and every dataset grows with its tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polfin.functions.columns import cols
from polfin.operators.joins import BROADCAST_BYTES, measured_bytes
from polfin.session import cut_wide_methods
from polfin.sources.specs import CONTRIBUTIONS, LEGISLATORS, RECIPIENTS, SPECS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

# How test columns play the part of contribution columns.
_CONTRIBUTIONS = {
    "cycle": "CAST(year(o.o_orderdate) + year(o.o_orderdate) % 2 AS INT)",
    "excluded.from.scaling": "CAST(l.l_linenumber % 2 AS INT)",
    "amount": "CASE WHEN l.l_quantity = 50 THEN CAST(NULL AS DOUBLE) ELSE l.l_extendedprice END",
    "gis.confidence": "l.l_tax",
    "contributor.cfscore": "c.c_acctbal / 10000",
    "candidate.cfscore": "s.s_acctbal / 10000",
    "transaction.id": "CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING)",
    "transaction.type": "l.l_returnflag",
    "date": """CASE WHEN l.l_quantity = 49 THEN '' WHEN l.l_quantity = 48 THEN 'invalid'
               ELSE CAST(CAST(l.l_shipdate AS DATE) AS STRING) END""",
    "bonica.cid": "CAST(o.o_custkey AS STRING)",
    "contributor.name": "c.c_name",
    "contributor.type": """CASE c.c_mktsegment WHEN 'BUILDING' THEN 'I' WHEN 'AUTOMOBILE' THEN 'C'
                           WHEN 'MACHINERY' THEN 'L' WHEN 'HOUSEHOLD' THEN 'P' ELSE NULL END""",
    "contributor.state": "cn.n_name",
    "contributor.zipcode": "lpad(CAST(o.o_custkey % 100000 AS STRING), 5, '0')",
    "contributor.occupation": "o.o_orderpriority",
    "contributor.employer": "c.c_mktsegment || ' \"Co\"'",
    "occ.standardized": "lower(o.o_orderpriority)",
    "is.corp": "CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'corp' ELSE NULL END",
    "recipient.name": "s.s_name",
    "bonica.rid": "CAST(l.l_suppkey AS STRING)",
    "recipient.party": "CASE l.l_suppkey % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'R' WHEN 2 THEN 'I' ELSE NULL END",
    "recipient.type": "CASE WHEN l.l_suppkey % 4 = 3 THEN 'COMM' ELSE 'CAND' END",
    "recipient.state": "sn.n_name",
    "seat": """CASE o.o_orderpriority WHEN '1-URGENT' THEN 'federal:senate' WHEN '2-HIGH' THEN 'federal:house'
               WHEN '3-MEDIUM' THEN 'state:governor' WHEN '4-NOT SPECIFIED' THEN '' ELSE NULL END""",
    "election.type": "l.l_linestatus",
    "latitude": "CAST(cn.n_nationkey AS STRING) || '.5'",
    "longitude": "CASE WHEN cn.n_nationkey % 2 = 0 THEN 'unknown' ELSE '-70.25' END",
}
_RECIPIENTS = {
    "election": "'fd' || CAST(y.cycle AS STRING)",
    "bonica.rid": "CAST(s.s_suppkey AS STRING)",
    "bonica.cid": "CASE WHEN s.s_suppkey % 6 = 0 THEN NULL ELSE CAST(s.s_suppkey * 7 AS STRING) END",
    "name": "s.s_name || CASE WHEN y.cycle > 1998 THEN ' Jr' ELSE '' END",
    "party": "CASE s.s_suppkey % 4 WHEN 0 THEN 'D' WHEN 1 THEN 'R' WHEN 2 THEN 'I' ELSE NULL END",
    "state": "n.n_name",
    "seat": "CASE WHEN s.s_suppkey % 2 = 0 THEN 'federal:house' ELSE 'federal:senate' END",
    "recipient.type": "CASE WHEN s.s_suppkey % 4 = 3 THEN 'COMM' ELSE 'CAND' END",
    # Candidate ids, in some cycles only; some belong to a neighbour; plain numbers;
    # ids too short to carry a year.
    "ICPSR": """CASE
        WHEN s.s_suppkey % 4 = 0 AND NOT (s.s_suppkey % 3 = 0 AND y.cycle = 1996)
          THEN 'H' || lpad(CAST(s.s_suppkey AS STRING), 8, '0') || CAST(y.cycle AS STRING)
        WHEN s.s_suppkey % 4 = 1 AND s.s_suppkey % 5 = 0 AND y.cycle = 2002
          THEN 'S' || lpad(CAST(s.s_suppkey + 3 AS STRING), 8, '0') || CAST(y.cycle AS STRING)
        WHEN s.s_suppkey % 4 = 1
          THEN 'S' || lpad(CAST(s.s_suppkey AS STRING), 8, '0') || CAST(y.cycle AS STRING)
        WHEN s.s_suppkey % 4 = 3 AND y.cycle = 1996 THEN NULL
        WHEN s.s_suppkey % 4 = 3 AND y.cycle = 1998 THEN ''
        WHEN s.s_suppkey % 4 = 3 AND y.cycle = 2000 THEN 'ab12'
        ELSE CAST(s.s_suppkey AS STRING) || CAST(y.cycle AS STRING) END""",
    "FEC.ID": "CASE WHEN s.s_suppkey % 4 < 2 THEN 'C' || lpad(CAST(s.s_suppkey AS STRING), 8, '0') ELSE NULL END",
    "cycle": "CAST(y.cycle AS DOUBLE)",
    "num.givers": "CAST(s.s_suppkey % 17 AS DOUBLE)",
    "recipient.cfscore": "s.s_acctbal / 10000",
}
_LEGISLATORS = {
    "last_name": "CASE WHEN c.c_custkey % 19 = 0 THEN 'Nan' ELSE c.c_name END",
    "first_name": "'F' || CAST(c.c_custkey % 50 AS STRING)",
    "full_name": "'F' || CAST(c.c_custkey % 50 AS STRING) || ' ' || c.c_name || '{source}'",
    "birthday": "CAST(1930 + c.c_custkey % 60 AS STRING) || '-01-15'",
    "gender": "CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END",
    "type": "CASE WHEN c.c_custkey % 5 = 0 THEN 'sen' ELSE 'rep' END",
    "state": "n.n_name",
    "party": "c.c_mktsegment",
    "url": "'https://example.org/' || CAST(c.c_custkey AS STRING)",
    "bioguide_id": """CASE WHEN c.c_custkey % 23 = 0 THEN NULL WHEN c.c_custkey % 29 = 0 THEN ''
                      ELSE 'P' || lpad(CAST(c.c_custkey AS STRING), 6, '0') END""",
    "opensecrets_id": "'N' || lpad(CAST(c.c_custkey AS STRING), 8, '0')",
    "fec_ids": """CASE WHEN c.c_custkey % 11 = 0 THEN NULL WHEN c.c_custkey % 7 = 0 THEN ''
                  ELSE 'H' || lpad(CAST(c.c_custkey AS STRING), 8, '0') || ',S'
                    || lpad(CAST(c.c_custkey AS STRING), 8, '0') END""",
    "icpsr_id": """CASE WHEN c.c_custkey % 7 = 0 THEN 'bad' WHEN c.c_custkey % 13 = 0 THEN NULL
                   ELSE CAST(10000 + c.c_custkey AS STRING) END""",
}
_MEMBERS = {
    "congress": "CAST(90 + day(e.ts) AS SMALLINT)",
    "chamber": "CASE WHEN e.event_type IN ('click', 'view') THEN 'House' ELSE 'Senate' END",
    "icpsr": "CAST(e.user_id AS INT)",
    "state_icpsr": "CAST(e.user_id % 50 AS DOUBLE)",
    "state_abbrev": "upper(substr(e.event_type, 1, 2))",
    "party_code": """CASE e.event_type WHEN 'click' THEN CAST(100 AS DOUBLE) WHEN 'view' THEN CAST(200 AS DOUBLE)
                     WHEN 'signup' THEN CAST(328 AS DOUBLE) ELSE CAST(29 AS DOUBLE) END""",
    "bioname": "upper(e.event_type) || ', U' || CAST(e.user_id AS STRING)",
    "bioguide_id": "CASE WHEN e.user_id % 10 = 9 THEN NULL ELSE 'U' || lpad(CAST(e.user_id AS STRING), 6, '0') END",
    "nominate_dim1": "CASE WHEN e.event_type = 'error' THEN CAST(NULL AS DOUBLE) ELSE e.value / 1000 END",
    "nominate_dim2": "-e.value / 1000",
    "nominate_number_of_votes": "CAST(e.event_id % 500 AS DOUBLE)",
}
_VOTES = {
    "congress": "CAST(90 + day(e.ts) AS SMALLINT)",
    "rollnumber": "CAST(e.event_id % 700 AS DOUBLE)",
    "icpsr": "CAST(e.user_id AS DOUBLE)",
    "cast_code": "CAST(1 + e.event_id % 9 AS DOUBLE)",
    "prob": "CASE WHEN e.event_id % 8 = 0 THEN CAST(NULL AS DOUBLE) ELSE e.value / 1000 END",
    "chamber": "CASE WHEN e.event_type IN ('click', 'view') THEN 'House' ELSE 'Senate' END",
}
_ROLLCALLS = {
    "congress": "CAST(90 + day(e.ts) AS SMALLINT)",
    "chamber": "CASE WHEN e.event_type IN ('click', 'view') THEN 'House' ELSE 'Senate' END",
    "rollnumber": "CAST(e.event_id AS INT)",
    "date": "CAST(CAST(e.ts AS DATE) AS STRING)",
    "session": "CASE WHEN e.event_id % 6 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(e.event_id % 2 + 1 AS DOUBLE) END",
    "yea_count": "CAST(e.event_id % 435 AS INT)",
    "nay_count": "CAST(e.event_id % 100 AS INT)",
    "nominate_mid_1": "e.value / 1000",
    "bill_number": "CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE 'HR' || CAST(e.event_id % 900 AS STRING) END",
    "vote_desc": """CASE e.event_id % 4 WHEN 0 THEN 'To amend "' || e.event_type || '"' || chr(10) || chr(10) || 'and more, of it'
                    WHEN 1 THEN 'plain' WHEN 2 THEN '"' ELSE 'a' || chr(10) || '"b"' END""",
    "dtl_desc": "CASE WHEN e.event_id % 3 = 0 THEN 'two' || chr(10) || 'lines' ELSE NULL END",
}
_CONTRIBUTORS = {
    "bonica.cid": "CAST(c.c_custkey AS STRING)",
    "contributor.type": "CASE WHEN c.c_custkey % 2 = 0 THEN 'I' ELSE 'C' END",
    "most.recent.contributor.name": "c.c_name || ', \"Jr\"'",
    "most.recent.contributor.state": "n.n_name",
    "most.recent.contributor.employer": "CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE c.c_mktsegment END",
    "num.distinct": "CAST(c.c_custkey % 40 AS DOUBLE)",
    "contributor.cfscore": "CASE WHEN c.c_custkey % 9 = 0 THEN CAST(NULL AS DOUBLE) ELSE c.c_acctbal / 10000 END",
    "first_cycle_active": "CAST(1980 + 2 * (c.c_custkey % 10) AS DOUBLE)",
    "amount.1996": "c.c_acctbal",
}
_TERMS = {
    "bioguide": "CASE WHEN e.user_id % 10 = 9 THEN NULL ELSE 'U' || lpad(CAST(e.user_id AS STRING), 6, '0') END",
    "start1": "CAST(1930 + e.event_id % 50 AS STRING) || '-01-0' || CAST(1 + e.event_id % 4 AS STRING)",
    "end1": """CASE WHEN e.event_id % 5 = 0 THEN '' WHEN e.event_id % 7 = 0 THEN 'invalid'
               ELSE CAST(1932 + e.event_id % 50 AS STRING) || '-01-0' || CAST(1 + e.event_id % 4 AS STRING) END""",
    "start2": "CAST(1950 + (e.event_id * 7) % 45 AS STRING) || '-12-31'",
    "end2": "CASE WHEN e.event_id % 3 = 0 THEN NULL ELSE CAST(1952 + (e.event_id * 7) % 45 AS STRING) || '-01-03' END",
}
_POLITICIANS = {
    "politician_id": "CAST(s.s_suppkey AS STRING)",
    "last_name": "s.s_name",
    "full_name": "s.s_name",
    "party": "CASE WHEN s.s_suppkey % 2 = 0 THEN 'D' ELSE 'R' END",
    "state": "n.n_name",
    "seat": "'federal:house'",
    "is_active": "s.s_suppkey % 3 <> 0",
}
_DONORS = {
    "donor_id": "CAST(c.c_custkey AS STRING)",
    "name": "c.c_name",
    "donor_type": "c.c_mktsegment",
    "state": "n.n_name",
}
_GIFTS = {
    "transaction_id": "CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING)",
    "donor_id": "CAST(o.o_custkey AS STRING)",
    "recipient_id": "CAST(l.l_suppkey AS STRING)",
    "amount": "CAST(l.l_extendedprice AS DECIMAL(14,2))",
    "transaction_date": "CAST(l.l_shipdate AS DATE)",
    "industry": "CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE l.l_returnflag || l.l_linestatus END",
    "election_cycle": "CAST(year(o.o_orderdate) + year(o.o_orderdate) % 2 AS INT)",
}
_ROLLCALL_VOTES = {
    "politician_id": "CAST(e.user_id AS STRING)",
    "rollcall_id": "CAST(e.event_id % 100 AS INT)",
    "vote_value": """CASE e.event_type WHEN 'click' THEN 'Yea' WHEN 'view' THEN 'Nay'
                     WHEN 'signup' THEN 'Present' WHEN 'purchase' THEN 'Not Voting' ELSE 'Absent' END""",
}

_FACT_JOINS = {
    "o": "JOIN orders o ON l.l_orderkey = o.o_orderkey",
    "c": "JOIN customer c ON o.o_custkey = c.c_custkey",
    "cn": "JOIN nation cn ON c.c_nationkey = cn.n_nationkey",
    "s": "JOIN supplier s ON l.l_suppkey = s.s_suppkey",
    "sn": "JOIN nation sn ON s.s_nationkey = sn.n_nationkey",
}
_NEEDS = {"c": {"o"}, "cn": {"o", "c"}, "sn": {"s"}}
_CYCLES = "(SELECT 1996 AS cycle UNION ALL SELECT 1998 UNION ALL SELECT 2000 UNION ALL SELECT 2002)"


@dataclass(frozen=True)
class StandIn:
    """A dataset as expressions over joined test tables."""

    expressions: dict[str, str]
    source: str
    where: str = ""
    # Tables joined only when a column asks for them; every row has its partner.
    optional: bool = False

    def _joins(self, names: Iterable[str]) -> str:
        if not self.optional:
            return ""
        used = self.tables(names)
        return " ".join(text for alias, text in _FACT_JOINS.items() if alias in used)

    def tables(self, names: Iterable[str]) -> set[str]:
        """Aliases of the tables that the columns need."""
        used = {a for n in names for a in re.findall(r"\b(\w+)\.\w+", self.expressions[n])}
        for alias in list(used):
            used |= _NEEDS.get(alias, set())
        return used

    def select(self, quote: str, names: Sequence[str] | None = None) -> str:
        names = list(names or self.expressions)
        items = ", ".join(f"{self.expressions[n]} AS {quote}{n}{quote}" for n in names)
        return f"SELECT {items} FROM {self.source} {self._joins(names)} {self.where}"


def _complete(expressions: dict[str, str], spec) -> dict[str, str]:
    """All declared columns, NULL where the test tables offer nothing."""
    return {f.name: expressions.get(f.name, f"CAST(NULL AS {f.dataType.simpleString()})") for f in spec.schema}


def _legislators(source: str, where: str) -> StandIn:
    expressions = {n: e.replace("{source}", source) for n, e in _LEGISLATORS.items()}
    return StandIn(
        _complete(expressions, LEGISLATORS), "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey", where
    )


STANDINS = {
    "contributions": StandIn(_complete(_CONTRIBUTIONS, CONTRIBUTIONS), "lineitem l", optional=True),
    "recipients": StandIn(
        _complete(_RECIPIENTS, RECIPIENTS),
        f"supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey CROSS JOIN {_CYCLES} y",
    ),
    "legislators_current": _legislators(" (current)", "WHERE c.c_custkey % 3 = 0"),
    "legislators_historical": _legislators("", "WHERE c.c_custkey % 3 < 2"),
    "members": StandIn(_complete(_MEMBERS, SPECS["members"]), "events e"),
    "rollcall_casts": StandIn(_VOTES, "events e"),
    "rollcalls": StandIn(_complete(_ROLLCALLS, SPECS["rollcalls"]), "events e"),
    "contributors": StandIn(
        _complete(_CONTRIBUTORS, SPECS["contributors"]), "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"
    ),
    "term_rows": StandIn(_TERMS, "events e"),
    "politicians": StandIn(
        _POLITICIANS,
        "supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey",
        "WHERE s.s_suppkey % 50 <> 7",
    ),
    "donors": StandIn(_DONORS, "customer c JOIN nation n ON c.c_nationkey = n.n_nationkey"),
    "gifts": StandIn(_GIFTS, "lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"),
    "rollcall_votes": StandIn(_ROLLCALL_VOTES, "events e"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A dataset as a DataFrame, joining only the tables its columns come from."""
    standin = STANDINS[name]
    if name == "recipients":
        return _recipients(spark, sf_dir, columns)
    if name == "contributions":
        return contributions(spark, sf_dir, columns)
    sql = standin.select("`", columns)
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    return spark.sql(
        re.sub(r"\b(" + "|".join(used) + r")\b(?= \w+)", r"{\1}", sql),
        **{t: table(spark, sf_dir, t) for t in used},
    )


def contributions(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None, by_cycle: str | None = None
) -> DataFrame:
    """Contributions, for which items move once, by their order, and before any column is made of them.

    Orders meet their customers first, being far fewer than items. Suppliers are measured and broadcast
    if small. ``by_cycle``, an expression of the cycle, takes its place; the rows of each task are sorted by it, as a
    dataset with a folder per cycle wants them, while they are narrow.
    """
    cut_wide_methods(spark)
    standin = STANDINS["contributions"]
    names = list(columns or standin.expressions)
    used = standin.tables([*names, "cycle"] if by_cycle else names)

    def on(alias: str) -> Column:
        return F.expr(_FACT_JOINS[alias].split(" ON ")[1])

    def of(name: str, alias: str) -> DataFrame:
        return table(spark, sf_dir, name).alias(alias)

    rows = of("lineitem", "l")
    if "o" in used:
        orders = of("orders", "o")
        if "c" in used:
            orders = orders.join(of("customer", "c"), on("c"))
        if "cn" in used:
            orders = orders.join(of("nation", "cn"), on("cn"))
        rows = rows.join(orders, on("o"))
    if "s" in used:
        supplier = table(spark, sf_dir, "supplier")
        small = measured_bytes(supplier.select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")) <= BROADCAST_BYTES
        rows = rows.join(F.broadcast(supplier.alias("s")) if small else supplier.alias("s"), on("s"))
    if "sn" in used:
        rows = rows.join(of("nation", "sn"), on("sn"))
    made = {n: F.expr(standin.expressions[n]) for n in names}
    if by_cycle:
        rows = rows.withColumn("cycle", F.expr(standin.expressions["cycle"])).withColumn("cycle", F.expr(by_cycle))
        rows = rows.sortWithinPartitions("cycle")
        made["cycle"] = F.col("cycle")
    return rows.select(*[made[n].alias(n) for n in names])


def _recipients(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None) -> DataFrame:
    """Suppliers once per cycle; the cycles come from an array, not from a join."""
    s = table(spark, sf_dir, "supplier").alias("s")
    n = table(spark, sf_dir, "nation").alias("n")
    rows = s.join(n, F.expr("s.s_nationkey = n.n_nationkey")).select(
        "s.*", "n.n_name", F.explode(F.array(*[F.lit(y) for y in (1996, 1998, 2000, 2002)])).alias("cycle")
    )
    expressions = STANDINS["recipients"].expressions
    bare = {k: re.sub(r"\b[sny]\.(?=[a-z])", "", v) for k, v in expressions.items()}
    return rows.select(*[F.expr(bare[k]).alias(k) for k in (columns or expressions)])


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested term records: two terms each, one record per event."""
    rows = load(spark, sf_dir, "term_rows")
    return rows.select(
        F.struct(F.col("bioguide")).alias("id"),
        F.expr("array(named_struct('start', start1, 'end', end1), named_struct('start', start2, 'end', end2))").alias(
            "terms"
        ),
    )


def cte(name: str) -> str:
    """The dataset as a named subquery for the checking engine."""
    return f'{name} AS ({STANDINS[name].select(chr(34))})'


def with_prefix(body: str) -> str:
    """Put the datasets a query mentions in front of it."""
    used = [n for n in STANDINS if re.search(rf"\b{n}\b", body)]
    if not used:
        return body
    ctes = ",\n".join(cte(n) for n in used)
    return f"WITH {ctes}\nSELECT * FROM (\n{body}\n)"


def select(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*cols(names))
