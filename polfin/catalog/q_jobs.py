"""Queries over the jobs that write: marts, loads, publishing and increments."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.catalog import sql_parts as sql
from polfin.catalog.q_joins import people, recipients
from polfin.catalog.registry import money_sql, query, rounded
from polfin.catalog.standins import load, select
from polfin.catalog.stored import contributions_root, shifted_root
from polfin.operators.predicates import AmountBetween, CycleIn, federal_races
from polfin.plans import analytics, dimensions, marts, pipelines
from polfin.session import new_work_path
from polfin.sources import readers, sinks, snapshots
from polfin.streaming import deltas, incremental

_GIVEN = "\"contributor.type\" <> 'I'"


@query(
    "m10_all_marts",
    f"""{sql.LINKED}, linked AS (SELECT k.*, p.bioguide_id AS person FROM contributions k
            LEFT JOIN pairs p ON p.rid = k."bonica.rid" WHERE {_GIVEN})
        SELECT 'organizational' AS mart, cycle, COUNT(*) AS rows, COUNT(person) AS linked
        FROM (SELECT DISTINCT * FROM linked) GROUP BY cycle
        UNION ALL SELECT 'raw_organizational', cycle, COUNT(*), COUNT(person) FROM (
            SELECT DISTINCT cycle, "bonica.rid", "recipient.name", "contributor.name", "contributor.type",
            "bonica.cid", amount, date, "contributor.state", person FROM linked) GROUP BY cycle
        UNION ALL SELECT 'recipient_aggregates', cycle, COUNT(*), COUNT(p.bioguide_id)
        FROM ({sql.AGGREGATES}) a LEFT JOIN pairs p ON p.rid = a."bonica.rid" GROUP BY cycle""",
)
def _(spark, sf):
    out = new_work_path(spark, "marts")
    built = pipelines.build_marts(
        spark,
        contributions_root(spark, sf),
        out,
        recipients=recipients(spark, sf),
        legislators=people(spark, sf),
    )
    result = None
    for kind in built:
        rows = readers.read_cycles(spark, f"{out}/{kind}").groupBy("cycle").agg(
            F.count("*").alias("rows"), F.count("bioguide_id").alias("linked")
        )
        rows = rows.select(F.lit(kind).alias("mart"), F.col("cycle").cast("int").alias("cycle"), "rows", "linked")
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "m11_load_subset",
    """SELECT cycle, "transaction.id", amount, seat FROM contributions
       WHERE cycle IN (1998, 2000) AND amount >= 20000 AND seat LIKE 'federal:%'""",
)
def _(spark, sf):
    path = new_work_path(spark, "subset")
    name = "s" + path.rsplit("-", 1)[1]
    pipelines.load_subset(
        spark,
        contributions_root(spark, sf),
        lambda df: sinks.append_table(df, name, path),
        predicates=[CycleIn([1998, 2000]), AmountBetween(low=20_000), federal_races()],
        columns=["cycle", "transaction.id", "amount", "seat"],
    )
    return spark.table(name)


_SHIFTED = "CASE cycle WHEN 1996 THEN 2023 WHEN 1998 THEN 2026 ELSE cycle END"


@query("m11_all_cycles", f"SELECT {_SHIFTED} AS cycle, COUNT(*) AS rows FROM contributions GROUP BY 1")
def _(spark, sf):
    path = new_work_path(spark, "all-cycles")
    done = pipelines.load_subset(
        spark, shifted_root(spark, sf), lambda df: sinks.write_parquet(df, path), columns=["cycle", "transaction.id"]
    )
    counts = pipelines.rows_per_cycle(spark.read.parquet(path))
    return counts.where(F.col("cycle").isin(*done.cycles))


@query(
    "m12_all_cycles",
    f"""SELECT {_SHIFTED} AS cycle, COUNT(*) AS rows FROM contributions WHERE {_GIVEN} GROUP BY 1""",
)
def _(spark, sf):
    out = new_work_path(spark, "published-all")
    frames = {"organizational": marts.organizational(spark.read.parquet(shifted_root(spark, sf)))}
    pipelines.publish(frames, lambda df, name: sinks.write_parquet(df, f"{out}/{name}"), datasets="organizational")
    return pipelines.rows_per_cycle(spark.read.parquet(f"{out}/organizational"))


@query(
    "k13_refresh_summary",
    f"""SELECT politician_id, industry, COUNT(*) AS contribution_count, SUM(amount) AS total_amount, {money_sql("AVG(amount)")} AS avg_amount
        FROM gifts JOIN politicians ON recipient_id = politician_id GROUP BY politician_id, industry""",
)
def _(spark, sf):
    root = new_work_path(spark, "summary")
    gifts = load(spark, sf, "gifts")
    for batch, part in enumerate(("election_cycle < 1996", "election_cycle >= 1996 AND amount < 30000", "election_cycle >= 1996 AND amount >= 30000")):
        for _again in range(2):  # a repeated batch changes nothing
            analytics.refresh_summary(gifts.where(part), root, batch)
    kept = analytics.stored_summary(spark, root, load(spark, sf, "politicians"))
    return rounded(kept.withColumn("avg_amount", F.col("avg_amount").cast("double")), "avg_amount").withColumn(
        "total_amount", F.col("total_amount").cast("decimal(24,2)")
    )


_PUBLISHED = f"""
    SELECT 'legislators' AS dataset, COUNT(*) AS rows FROM ({sql.DISTINCT_PEOPLE})
    UNION ALL SELECT 'crosswalk', COUNT(*) FROM ({sql.CROSSWALK})
    UNION ALL SELECT 'organizational', COUNT(*) FROM contributions
              WHERE {_GIVEN}
    UNION ALL SELECT 'recipient_aggregates', COUNT(*) FROM ({sql.AGGREGATES})"""


def _publish(spark, sf, sink) -> DataFrame:
    rows = spark.read.parquet(contributions_root(spark, sf))
    frames = {
        "legislators": dimensions.distinct_legislators(load(spark, sf, "members")),
        "crosswalk": dimensions.crosswalk(load(spark, sf, "recipients")),
        "organizational": marts.organizational(rows),
        "recipient_aggregates": marts.recipient_aggregates(rows),
    }
    counts = pipelines.publish(frames, sink, datasets="all")
    return spark.createDataFrame(list(counts.items()), "dataset string, rows bigint")


@query("m12_publish", _PUBLISHED)
def _(spark, sf):
    out = new_work_path(spark, "published")
    return _publish(spark, sf, lambda df, name: sinks.write_parquet(df, f"{out}/{name}"))


@query(
    "k06_publish_tables",
    """SELECT cycle, bonica_rid, contribution_count FROM (
         SELECT cycle, "bonica.rid" AS bonica_rid, COUNT(*) AS contribution_count FROM contributions
         GROUP BY cycle, "bonica.rid")""",
)
def _(spark, sf):
    out = new_work_path(spark, "tables")
    rows = spark.read.parquet(contributions_root(spark, sf))
    pipelines.publish(
        {"recipient_aggregates": marts.recipient_aggregates(rows)},
        lambda df, name: sinks.write_parquet(df, f"{out}/{name}"),
        datasets=["recipient_aggregates"],
        tables={"recipient_aggregates": "totals"},
    )
    return spark.read.parquet(f"{out}/totals").select("cycle", "bonica_rid", "contribution_count")


@query(
    "m13_free_sql",
    f"""SELECT "contributor.state" AS state, COUNT(*) AS n, {money_sql("SUM(amount)")} AS total
        FROM contributions WHERE cycle = 2000 GROUP BY "contributor.state" """,
)
def _(spark, sf):
    text = "SELECT `contributor.state` AS state, COUNT(*) AS n, SUM(amount) AS total FROM contributions GROUP BY 1"
    return rounded(readers.query_cycles(spark, contributions_root(spark, sf), text, [2000]), "total")


@query("m05_stored_and_checked", f"SELECT bioguide_id, icpsr, last_congress FROM ({sql.DISTINCT_PEOPLE})")
def _(spark, sf):
    out = new_work_path(spark, "distinct")
    stored = pipelines.build_distinct(spark, load(spark, sf, "members"), out)
    return stored.select("bioguide_id", "icpsr", "last_congress")


@query("m04_stored_and_checked", f"SELECT bioguide_id, full_name, icpsr FROM ({sql.PEOPLE})")
def _(spark, sf):
    current, historical = (load(spark, sf, f"legislators_{n}") for n in ("current", "historical"))
    out = new_work_path(spark, "unified")
    rows = current.count() + historical.count()
    stored = pipelines.build_unified(spark, current, historical, out, bounds=(1, rows))
    return stored.select("bioguide_id", "full_name", "icpsr")


@query("m06_stored_and_checked", f"SELECT icpsr, bonica_rid FROM ({sql.CROSSWALK})")
def _(spark, sf):
    out = new_work_path(spark, "crosswalk")
    return pipelines.build_crosswalk(spark, load(spark, sf, "recipients"), out).select("icpsr", "bonica_rid")


@query(
    "x01_incremental",
    f'SELECT "transaction.id", cycle, amount, "contributor.type" FROM contributions WHERE {_GIVEN}',
)
def _(spark, sf):
    root = contributions_root(spark, sf)
    out, state = new_work_path(spark, "stream-out"), new_work_path(spark, "stream-state")
    schema = spark.read.parquet(root).schema
    for _run in range(2):  # The second run finds nothing new.
        stream = incremental.stream_parquet(spark, root, schema)
        incremental.organizational_stream(stream, out, state).awaitTermination()
    return select(spark.read.parquet(out), "transaction.id", "cycle", "amount", "contributor.type")


@query("x01_refresh_aggregates", f'SELECT cycle, "bonica.rid", total_amount, contribution_count FROM ({sql.AGGREGATES})')
def _(spark, sf):
    root = contributions_root(spark, sf)
    out, state = new_work_path(spark, "refresh-out"), new_work_path(spark, "refresh-state")
    stream = incremental.stream_parquet(spark, root, spark.read.parquet(root).schema)
    incremental.refresh_aggregates(spark, stream, root, out, state).awaitTermination()
    rows = select(readers.read_cycles(spark, out), "cycle", "bonica.rid", "total_amount", "contribution_count")
    return rounded(rows, "total_amount")


@query(
    "x01_merge_aggregates",
    f"""SELECT cycle, "bonica.rid", total_amount, avg_amount, contribution_count, organizational_count
        FROM ({sql.AGGREGATES})""",
)
def _(spark, sf):
    root = contributions_root(spark, sf)
    out, state = new_work_path(spark, "merged-sums"), new_work_path(spark, "merged-state")
    schema = spark.read.parquet(root).schema
    for _run in range(2):  # Several batches in the first run, nothing new in the second.
        stream = incremental.stream_parquet(spark, root, schema, files_at_once=3)
        incremental.merge_aggregates(stream, out, state).awaitTermination()
    rows = marts.aggregates_of_sums(sinks.read_sums(spark, out))
    names = ["cycle", "bonica.rid", "total_amount", "avg_amount", "contribution_count", "organizational_count"]
    return rounded(select(rows, *names), "total_amount", "avg_amount")


# Of the stored contributions, for each part of the state.
_PART_BYTES = 4 << 20
_ONCE = ["cycle", "bonica.rid", "contributor.type", "contributor.state", "amount"]


@query("x01_distinct_mart", f"""SELECT DISTINCT {", ".join(f'"{n}"' for n in _ONCE)} FROM contributions WHERE {_GIVEN}""")
def _(spark, sf):
    source, out, state = (new_work_path(spark, f"once-{n}") for n in ("source", "out", "state"))
    rows = spark.read.parquet(contributions_root(spark, sf))
    parts = max(4, sinks.stored_bytes(spark, contributions_root(spark, sf)) // _PART_BYTES)
    early = rows.where("cycle < 2000")
    # The second run finds the files of the first once more beside new ones, the third the rest.
    for arriving in (early, early.unionByName(rows.where("cycle BETWEEN 2000 AND 2010")), rows.where("cycle > 2010 OR cycle IS NULL")):
        arriving.write.mode("append").partitionBy("cycle").parquet(source)
        stream = incremental.stream_parquet(spark, source, rows.schema)
        incremental.append_distinct(
            stream, lambda df: select(marts.organizational(df), *_ONCE), out, state, partitions=parts
        ).awaitTermination()
    return select(spark.read.parquet(out), *_ONCE)


@query(
    "k10_snapshot_read",
    f"""SELECT 'before' AS reader, cycle, COUNT(*) AS rows FROM contributions WHERE {_GIVEN} GROUP BY cycle
        UNION ALL SELECT 'after', cycle, COUNT(*) FROM contributions WHERE {_GIVEN} AND (cycle <> 1998 OR amount >= 20000) GROUP BY cycle
        UNION ALL SELECT 'version 1', cycle, COUNT(*) FROM contributions WHERE {_GIVEN} GROUP BY cycle""",
)
def _(spark, sf):
    root, source, out = contributions_root(spark, sf), new_work_path(spark, "trimmed"), new_work_path(spark, "versions")
    pipelines.build_mart(spark, "organizational", root, out)
    before = readers.read_cycles(spark, out)  # opened now, used after the next version is out
    rows = spark.read.parquet(root)
    snapshots.publish(spark, rows.where("cycle = 1998 AND amount >= 20000"), source, [1998], sinks.write_cycles)
    pipelines.build_mart(spark, "organizational", source, out, [1998])
    readers_of = {
        "before": before,
        "after": readers.read_cycles(spark, out),
        "version 1": snapshots.read(spark, snapshots.snapshot(spark, out, 1)),
    }
    counts = [pipelines.rows_per_cycle(df).select(F.lit(name).alias("reader"), "cycle", "rows") for name, df in readers_of.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "k10_concurrent_publish",
    f"""SELECT cycle, COUNT(*) AS rows, 2 AS versions FROM contributions WHERE {_GIVEN} AND cycle IN (1994, 1996, 1998) GROUP BY cycle""",
)
def _(spark, sf):
    root, out = contributions_root(spark, sf), new_work_path(spark, "contended")
    # Both start from an empty dataset; the one that comes second takes the next version.
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(pipelines.build_mart, spark, "organizational", root, out, part) for part in ([1994, 1996], [1998])]
        for job in jobs:
            job.result()
    counts = pipelines.rows_per_cycle(readers.read_cycles(spark, out))
    return counts.withColumn("versions", F.lit(len(snapshots.versions(spark, out))))


_REPLACED = """SELECT cycle, "bonica.rid", "recipient.name", "recipient.party", "recipient.type", "recipient.state", "contributor.type", amount
               FROM contributions WHERE cycle <> 2000 AND (cycle <> 1998 OR amount < 30000)
               UNION ALL SELECT 1998, "bonica.rid", "recipient.name", "recipient.party", "recipient.type", "recipient.state", "contributor.type", amount + 0.25
               FROM contributions WHERE cycle = 1998 AND amount < 10000"""


@query(
    "x01_replace_file",
    f"""SELECT cycle, "bonica.rid", {money_sql("SUM(amount)")} AS total_amount, COUNT(*) AS contribution_count,
          {money_sql("COALESCE(SUM(amount) FILTER (WHERE " + _GIVEN + "), 0)")} AS organizational_total,
          COUNT(*) FILTER (WHERE {_GIVEN}) AS organizational_count
        FROM ({_REPLACED}) GROUP BY ALL""",
)
def _(spark, sf):
    source, out = new_work_path(spark, "versioned"), new_work_path(spark, "weighted")
    rows = spark.read.parquet(contributions_root(spark, sf))
    cycles = readers.existing_cycles(spark, contributions_root(spark, sf))
    snapshots.publish(spark, rows, source, cycles, sinks.write_cycles)
    deltas.refresh_recipient_sums(spark, source, out)
    # One cycle is replaced, one is withdrawn; taken in twice, which changes nothing.
    one = rows.where("cycle = 1998")
    kept = one.where("amount < 30000").unionByName(one.where("amount < 10000").withColumn("amount", F.col("amount") + 0.25))
    snapshots.publish(spark, kept, source, [1998, 2000], sinks.write_cycles)
    for _again in range(2):
        deltas.refresh_recipient_sums(spark, source, out)
    names = ["cycle", "bonica.rid", "total_amount", "contribution_count", "organizational_total", "organizational_count"]
    return rounded(select(deltas.recipient_aggregates(spark, out), *names), "total_amount", "organizational_total")


@query(
    "k13_delete_rows",
    f"""SELECT politician_id, industry, COUNT(*) AS contribution_count, SUM(amount) AS total_amount,
          {money_sql("AVG(amount)")} AS avg_amount, COUNT(DISTINCT donor_id) AS donor_count
        FROM (SELECT *, recipient_id AS politician_id FROM gifts WHERE amount < 30000 OR election_cycle < 1996) GROUP BY politician_id, industry""",
)
def _(spark, sf):
    root = new_work_path(spark, "weighted-summary")
    gifts = load(spark, sf, "gifts")
    steps = [gifts.withColumn(deltas.WEIGHT, F.lit(1)), gifts.where("amount >= 30000 AND election_cycle >= 1996").withColumn(deltas.WEIGHT, F.lit(-1))]
    for batch, changes in enumerate(steps):
        for _again in range(2):  # a repeated batch changes nothing
            deltas.change_summary(spark, root, changes, batch)
    kept = deltas.changed_summary(spark, root).withColumn("avg_amount", F.col("avg_amount").cast("double"))
    return rounded(kept, "avg_amount").withColumn("total_amount", F.col("total_amount").cast("decimal(24,2)"))
