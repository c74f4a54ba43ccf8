"""Queries over sources, sinks and projections."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.registry import query
from polfin.catalog.standins import load, select, table
from polfin.catalog.stored import contributions_root, csv_path, shifted_root, terms_path
from polfin.functions.columns import c, sanitize
from polfin.operators.predicates import CycleIn, Organizational
from polfin.plans import marts, pipelines
from polfin.plans.dimensions import combined_legislators, crosswalk_pairs, unified_legislators
from polfin.session import new_work_path
from polfin.sources import readers, sinks
from polfin.sources.specs import (
    CONTRIBUTIONS,
    CONTRIBUTORS,
    DEFAULT_CONTRIBUTION_COLUMNS,
    LEGISLATORS,
    MEMBERS,
    RECIPIENTS,
    ROLLCALLS,
    VOTES,
)

contributions = partial(load, name="contributions")


@query("s01_cycle_scan", 'SELECT "transaction.id", cycle, amount FROM contributions WHERE cycle = 1998')
def _(spark, sf):
    rows = readers.read_cycles(spark, contributions_root(spark, sf), [CycleIn([1998])])
    return select(rows, "transaction.id", "cycle", "amount")


@query(
    "s02_sql_over_cycles",
    """SELECT cycle, COUNT(*) AS n, COUNT(amount) AS n_amount, MAX(amount) AS largest FROM contributions
       WHERE cycle IN (1996, 1998) GROUP BY cycle""",
)
def _(spark, sf):
    sql = """SELECT cycle, COUNT(*) AS n, COUNT(amount) AS n_amount, MAX(amount) AS largest
             FROM contributions GROUP BY cycle"""
    return readers.query_cycles(spark, contributions_root(spark, sf), sql, [1996, 1998])


_SHIFTED = "CASE cycle WHEN 1996 THEN 2023 WHEN 1998 THEN 2026 ELSE cycle END"


@query("s02_all_cycles", f"SELECT {_SHIFTED} AS cycle, COUNT(*) AS n FROM contributions GROUP BY 1")
def _(spark, sf):
    return readers.query_cycles(spark, shifted_root(spark, sf), "SELECT cycle, COUNT(*) AS n FROM contributions GROUP BY cycle")


@query("s03_dimension_scan", "SELECT s_suppkey, s_name FROM supplier")
def _(spark, sf):
    return readers.read_parquet(spark, f"{sf}/supplier.parquet", ["s_suppkey", "s_name"])


@query(
    "s04_mart_scan",
    """SELECT "transaction.id", "contributor.type", amount FROM contributions
       WHERE "contributor.type" <> 'I'""",
)
def _(spark, sf):
    out = new_work_path(spark, "organizational")
    pipelines.build_mart(spark, "organizational", contributions_root(spark, sf), out)
    return select(readers.read_cycles(spark, out), "transaction.id", "contributor.type", "amount")


@query("s08_terms_json", "SELECT bioguide, start1, end1, start2, end2 FROM term_rows")
def _(spark, sf):
    terms = readers.read_terms(spark, terms_path(spark, sf), multi_line=False)
    first, second = F.col("terms")[0], F.col("terms")[1]
    return terms.select(
        F.col("id.bioguide").alias("bioguide"),
        first["start"].alias("start1"),
        first["end"].alias("end1"),
        second["start"].alias("start2"),
        second["end"].alias("end2"),
    )


@query(
    "s09_null_markers",
    """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 5 = 0 THEN NULL ELSE text END AS "contributor.name"
       FROM documents""",
)
def _(spark, sf):
    raw = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.expr("CASE WHEN doc_id % 3 = 0 THEN '\\\\N' WHEN doc_id % 5 = 0 THEN '' ELSE text END").alias(
            "contributor.name"
        ),
    )
    return readers.mark_nulls(raw, CONTRIBUTIONS)


@query(
    "s10_rejected_records",
    """SELECT CAST(icpsr AS VARCHAR) AS icpsr, CAST(congress AS VARCHAR) || ',' || CAST(rollnumber AS VARCHAR) || ',' || CAST(icpsr AS VARCHAR)
              || ',' || CAST(cast_code AS VARCHAR) || ',,' || chamber || ',extra' AS record
       FROM rollcall_casts WHERE CAST(rollnumber AS INT) % 10 = 3""",
)
def _(spark, sf):
    path = new_work_path(spark, "broken")
    rows = load(spark, sf, "rollcall_casts").withColumns(
        {
            "prob": F.lit(None).cast("double"),
            "chamber": F.when(F.col("rollnumber") % 10 == 3, F.concat("chamber", F.lit(",extra"))).otherwise(
                F.col("chamber")
            ),
        }
    )
    # One column under another separator: its commas turn into fields when read.
    text = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in rows.columns]
    rows.select(F.concat_ws(",", *text).alias(",".join(rows.columns))).write.options(header=True, sep="|").csv(path)
    return readers.read_csv_rejects(spark, path, VOTES).select("icpsr", "record")


@query("s12_typed_cast", "SELECT * FROM rollcall_casts")
def _(spark, sf):
    rows = load(spark, sf, "rollcall_casts")
    text = rows.select(*[F.col(n).cast("string") for n in rows.columns])
    return readers.cast_columns(text, VOTES)


@query("s15_recipients_scan", 'SELECT "bonica.rid", "ICPSR" FROM recipients')
def _(spark, sf):
    return load(spark, sf, "recipients", ["bonica.rid", "ICPSR"])


_INGESTED = ["transaction.id", "cycle", "amount", "contributor.employer", "contributor.zipcode", "date", "seat"]


@query(
    "m01_ingest_contributions",
    """SELECT "transaction.id", cycle, amount, "contributor.employer", "contributor.zipcode",
              nullif(date, '') AS date, nullif(seat, '') AS seat FROM contributions""",
)
def _(spark, sf):
    source = csv_path(
        spark, load(spark, sf, "contributions"), "contributions-csv", encoding="ISO-8859-1", null="\\N", gzip=True
    )
    out = new_work_path(spark, "contributions-parquet")
    pipelines.ingest(spark, CONTRIBUTIONS, source, out)
    return select(spark.read.parquet(out), *_INGESTED)


@query(
    "m01_ingest_recipients",
    """SELECT election, "bonica.rid", nullif("bonica.cid", '') AS "bonica.cid", name, party, nullif("ICPSR", '') AS "ICPSR" FROM recipients""",
)
def _(spark, sf):
    rows = load(spark, sf, "recipients")
    source = csv_path(spark, rows, "recipients-csv", encoding="ISO-8859-1", null="\\N", gzip=True)
    out = new_work_path(spark, "recipients-parquet")
    pipelines.ingest(spark, RECIPIENTS, source, out)
    return select(spark.read.parquet(out), "election", "bonica.rid", "bonica.cid", "name", "party", "ICPSR")


@query("m01_ingest_contributors", "SELECT * FROM contributors")
def _(spark, sf):
    rows = load(spark, sf, "contributors")
    source = csv_path(spark, rows, "contributors-csv", encoding="ISO-8859-1", null="\\N", gzip=True)
    out = new_work_path(spark, "contributors-parquet")
    pipelines.ingest(spark, CONTRIBUTORS, source, out)
    return spark.read.parquet(out)


def _rollcalls_csv(spark, sf):
    return csv_path(spark, load(spark, sf, "rollcalls"), "rollcalls-csv", encoding="UTF-8", null="N/A", gzip=False)


@query("m02_ingest_rollcalls", "SELECT * FROM rollcalls")
def _(spark, sf):
    out = new_work_path(spark, "rollcalls-parquet")
    pipelines.ingest(spark, ROLLCALLS, _rollcalls_csv(spark, sf), out)
    return spark.read.parquet(out)


@query("s13_raw_count", "SELECT COUNT(*) AS records FROM rollcalls")
def _(spark, sf):
    counted = readers.raw_record_count(spark, _rollcalls_csv(spark, sf))
    return spark.range(1).select(F.lit(counted).cast("bigint").alias("records"))


@query("m02_ingest_members", "SELECT * FROM members")
def _(spark, sf):
    source = csv_path(spark, load(spark, sf, "members"), "members-csv", encoding="UTF-8", null="N/A", gzip=False)
    out = new_work_path(spark, "members-parquet")
    pipelines.ingest(spark, MEMBERS, source, out)
    return spark.read.parquet(out)


@query("m02_ingest_votes", "SELECT * FROM rollcall_casts")
def _(spark, sf):
    source = csv_path(spark, load(spark, sf, "rollcall_casts"), "votes-csv", encoding="UTF-8", null="", gzip=False)
    out = new_work_path(spark, "votes-parquet")
    pipelines.ingest(spark, VOTES, source, out)
    return spark.read.parquet(out)


@query(
    "m03_ingest_legislators",
    """SELECT * REPLACE (nullif(bioguide_id, '') AS bioguide_id, nullif(fec_ids, '') AS fec_ids)
       FROM (SELECT * FROM legislators_current UNION ALL SELECT * FROM legislators_historical)""",
)
def _(spark, sf):
    rows = load(spark, sf, "legislators_current").unionByName(load(spark, sf, "legislators_historical"))
    source = csv_path(spark, rows, "legislators-csv", encoding="UTF-8", null="", gzip=False)
    out = new_work_path(spark, "legislators-parquet")
    pipelines.ingest(spark, LEGISLATORS, source, out)
    return spark.read.parquet(out)


# ------------------------------------------------------------------------ sinks


@query(
    "k01_parquet_zstd",
    """SELECT "transaction.id", "bonica.rid", amount FROM contributions WHERE "contributor.type" <> 'I'""",
)
def _(spark, sf):
    out = new_work_path(spark, "zstd")
    rows = contributions(spark, sf, columns=["transaction.id", "bonica.rid", "amount", "contributor.type"])
    sinks.write_parquet(select(marts.organizational(rows), "transaction.id", "bonica.rid", "amount"), out)
    return spark.read.parquet(out)


@query(
    "k03_append_twice",
    "SELECT cycle, 2 * COUNT(*) AS rows FROM contributions GROUP BY cycle",
)
def _(spark, sf):
    path = new_work_path(spark, "appended")
    name = "t" + path.rsplit("-", 1)[1]
    rows = readers.read_cycles(spark, contributions_root(spark, sf))
    rows = select(rows, "cycle", "transaction.id", "amount")
    sinks.append_table(rows, name, path)
    sinks.append_table(rows, name, path)
    return pipelines.rows_per_cycle(spark.table(name))


@query(
    "k08_underscore_names",
    """SELECT "transaction.id" AS transaction_id, "bonica.rid" AS bonica_rid, "recipient.name" AS recipient_name
       FROM contributions""",
)
def _(spark, sf):
    return sanitize(contributions(spark, sf, columns=["transaction.id", "bonica.rid", "recipient.name"]))


@query(
    "k09_clustered_lookup",
    """SELECT "transaction.id", date, amount FROM contributions WHERE "bonica.rid" = '7' AND cycle = 1998""",
)
def _(spark, sf):
    out = new_work_path(spark, "clustered")
    rows = contributions(spark, sf, columns=["cycle", "transaction.id", "bonica.rid", "bonica.cid", "date", "amount"])
    sinks.write_clustered(rows, out)
    chosen = spark.read.parquet(out).where((c("bonica.rid") == "7") & (F.col("cycle") == 1998))
    return select(chosen, "transaction.id", "date", "amount")


@query("k10_cycle_layout", "SELECT cycle, COUNT(*) AS rows FROM contributions GROUP BY cycle")
def _(spark, sf):
    root = contributions_root(spark, sf)
    return pipelines.rows_per_cycle(spark.read.parquet(root))


@query(
    "k11_skip_existing",
    """SELECT cycle, CASE WHEN cycle IN (1996, 1998) THEN 'skipped' ELSE 'written' END AS outcome,
              COUNT(*) AS rows
       FROM contributions WHERE "contributor.type" <> 'I' GROUP BY cycle""",
)
def _(spark, sf):
    root, out = contributions_root(spark, sf), new_work_path(spark, "resumed")
    pipelines.build_mart(spark, "organizational", root, out, [1996, 1998], validate=False)
    second = pipelines.build_mart(
        spark, "organizational", root, out, range(1980, 2026, 2), skip_existing=True, validate=False
    )
    outcome = F.when(F.col("cycle").isin(*second.skipped), "skipped").otherwise("written")
    counts = pipelines.rows_per_cycle(readers.read_cycles(spark, out))
    return counts.select("cycle", outcome.alias("outcome"), "rows")


@query(
    "k12_table_info",
    """SELECT COUNT(*) AS row_count, 'cycle' AS "column", 'int' AS "type", 1 AS position FROM contributions
       UNION ALL SELECT COUNT(*), 'amount', 'double', 0 FROM contributions""",
)
def _(spark, sf):
    out = new_work_path(spark, "described")
    rows = contributions(spark, sf, columns=["amount", "cycle"])
    sinks.write_parquet(rows, out)
    return sinks.table_info_frame(spark, out)


@query(
    "k14_missing_cycles",
    """SELECT CAST(y AS BIGINT) AS cycle,
              CASE WHEN y IN (SELECT cycle FROM contributions) THEN 'written' ELSE 'missing' END AS outcome
       FROM (SELECT unnest([1980, 1990, 1998, 2000, 2010]) AS y)""",
)
def _(spark, sf):
    out = new_work_path(spark, "partly")
    done = pipelines.build_mart(
        spark, "organizational", contributions_root(spark, sf), out, [1980, 1990, 1998, 2000, 2010], validate=False
    )
    rows = [(y, "written") for y in done.written] + [(y, "missing") for y in done.missing]
    return spark.createDataFrame(rows, "cycle bigint, outcome string")


# ------------------------------------------------------------------ projections

_DEFAULT = ", ".join(f'"{n}"' for n in DEFAULT_CONTRIBUTION_COLUMNS)


@query("p01_default_projection", f"SELECT {_DEFAULT} FROM contributions")
def _(spark, sf):
    return pipelines.subset(contributions(spark, sf))


@query("p02_all_columns", "SELECT * FROM contributions WHERE \"contributor.type\" <> 'I'")
def _(spark, sf):
    return marts.organizational(contributions(spark, sf))


@query(
    "p03_rename_projection",
    """SELECT CAST(cycle AS BIGINT) AS cycle, "bonica.rid", "recipient.name", "contributor.name" AS contributor_name,
              "contributor.type" AS contributor_type, "bonica.cid" AS contributor_id, amount, date,
              "contributor.state" AS contributor_state
       FROM contributions WHERE "contributor.type" <> 'I'""",
)
def _(spark, sf):
    rows = contributions(spark, sf).where(Organizational().to_column())
    renamed = rows.select(*[c(source).alias(name) for name, source in marts.DETAIL_COLUMNS.items()])
    return renamed.withColumn("cycle", F.col("cycle").cast("bigint"))


@query(
    "p04_cycle_in_front",
    """SELECT cycle, "bonica.rid", COUNT(*) AS contribution_count FROM contributions
       WHERE cycle = 2000 GROUP BY cycle, "bonica.rid" """,
)
def _(spark, sf):
    rows = contributions(spark, sf).where("cycle = 2000")
    totals = marts.recipient_aggregates(rows, by_cycle=False)
    return select(marts.with_cycle(totals, 2000), "cycle", "bonica.rid", "contribution_count")


@query(
    "p05_source_constants",
    """SELECT bioguide_id, TRUE AS is_current, 1 AS source_priority FROM legislators_current WHERE bioguide_id > ''
       UNION ALL SELECT bioguide_id, FALSE, 2 FROM legislators_historical WHERE bioguide_id > ''""",
)
def _(spark, sf):
    both = combined_legislators(load(spark, sf, "legislators_current"), load(spark, sf, "legislators_historical"))
    return both.select("bioguide_id", "is_current", "source_priority")


@query(
    "p06_crosswalk_projection",
    """SELECT left("ICPSR", -4) AS icpsr, "bonica.rid" AS bonica_rid, name AS recipient_name, party, state, seat,
              "FEC.ID" AS fec_id FROM recipients WHERE length("ICPSR") > 4""",
)
def _(spark, sf):
    return crosswalk_pairs(load(spark, sf, "recipients"))


@query(
    "p07_person_columns",
    f"SELECT bioguide_id, last_name, first_name, state FROM ({sql.PEOPLE})",
)
def _(spark, sf):
    both = [load(spark, sf, f"legislators_{n}") for n in ("current", "historical")]
    return unified_legislators(*both).select("bioguide_id", "last_name", "first_name", "state")
