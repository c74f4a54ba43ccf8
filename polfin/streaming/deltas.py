"""Sums that follow replaced and deleted rows without a rebuild.

Changes are rows with a weight: 1 for each that came, -1 for each that went. Sums, counts
and distinct values per key are kept by weight, in buckets of the key, as versions of a
dataset (``snapshots``): a batch of changes reads and writes only the buckets of the keys
it touches, and publishes them in one step with a note of how far its source was taken in.
Money is summed in decimals, which are exact whatever the order, so what is taken away
leaves what was there before, and the result is that of a rebuild to the last bit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from polfin.functions.columns import c, cols
from polfin.operators.predicates import Organizational
from polfin.plans.marts import INDIVIDUAL, RECIPIENT_KEY
from polfin.session import pieces_of
from polfin.sources import sinks, snapshots

# Buckets of a new dataset; one that exists keeps its number.
BUCKETS = 32
WEIGHT, BUCKET, ROWS = "__weight", "__bucket", "rows"
# Money has six decimals here; a finer amount is rounded to that.
MONEY = "decimal(24,6)"
# Stored rows take few bytes each, while a task holds those of a piece as keys, most of them different.
PIECE_BYTES = 16 << 20


class NotThere(ValueError):
    """More rows of a key went than there were."""


def money(amount: Column) -> Column:
    return F.coalesce(amount.try_cast(MONEY), F.lit(0).cast(MONEY))


def odd(amount: Column) -> Column:
    """1 for an amount no decimal can hold: NaN, infinite or far too large."""
    return F.when(amount.isNotNull() & amount.try_cast(MONEY).isNull(), F.lit(1)).otherwise(F.lit(0))


def apply(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    note: dict,
    buckets: int | None = None,
) -> snapshots.Snapshot:
    """Takes weighted rows into the sums below ``root``.

    ``measures`` are numbers of a row, NULL counting as 0; ``rows``, its weight, is always
    kept, and a key without rows goes. The note is published with the sums; a writer that
    meets another one fails and starts again from the new version. ``buckets``, for new
    sums only, should grow with the number of keys: a bucket is written by one task.
    """
    with pieces_of(spark, PIECE_BYTES):
        return _apply(spark, root, changes, keys, measures, note, buckets)


def _apply(
    spark: SparkSession,
    root: str,
    changes: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    note: dict,
    buckets: int | None,
) -> snapshots.Snapshot:
    base = snapshots.snapshot(spark, root, by=BUCKET)
    n = base.note.get("buckets") or buckets or BUCKETS
    bucket = F.pmod(F.xxhash64(*cols(keys)), F.lit(n)).cast("int").alias(BUCKET)
    weighted = {ROWS: F.col(WEIGHT), **{name: F.col(WEIGHT) * F.coalesce(m, F.lit(0)) for name, m in measures.items()}}
    summed = changes.groupBy(bucket, *cols(keys)).agg(*[F.sum(m).alias(name) for name, m in weighted.items()])
    types = {f.name: "decimal(38,6)" if f.dataType.typeName() == "decimal" else "bigint" for f in summed.schema if f.name in weighted}
    cells = [F.col(name).cast(t).alias(name) for name, t in types.items()]
    moved = F.lit(False)
    for name in types:
        moved = moved | (F.col(name) != 0)
    delta = sinks.stored_copy(summed.select(BUCKET, *cols(keys), *cells).where(moved), "deltas")
    batch, folder = snapshots.new_batch(root)
    try:
        touched = sorted(r[0] for r in delta.select(BUCKET).distinct().collect())  # at most the number of buckets
        merged = delta
        before = base.only(touched)
        if before.cycles:
            merged = snapshots.read(spark, before).select(*cols(delta.columns)).unionByName(delta)
            merged = merged.groupBy(BUCKET, *cols(keys)).agg(*[F.sum(name).cast(t).alias(name) for name, t in types.items()])
        least = Observation()
        laid_out = merged.observe(least, F.min(ROWS).alias("least")).where(F.col(ROWS) != 0)
        sinks.write_parquet(laid_out.repartition(F.col(BUCKET)), folder, partition_by=BUCKET)
        if (least.get["least"] or 0) < 0:
            raise NotThere(f"{root}: rows to take away were not there")
        return snapshots.commit(spark, base, batch, snapshots.stored_schema(delta.schema, BUCKET), touched, {**note, "buckets": n})
    except BaseException:
        sinks.remove(spark, folder)
        raise
    finally:
        sinks.drop_copy(delta)


def sums(spark: SparkSession, root: str) -> DataFrame:
    """The last version of the sums."""
    return snapshots.read(spark, snapshots.snapshot(spark, root)).drop(BUCKET)


def applied(spark: SparkSession, root: str) -> dict:
    """The note of the last version; empty before the first."""
    return snapshots.snapshot(spark, root, by=BUCKET).note


# ------------------------------------------------------- aggregates per recipient


def _recipient_measures() -> dict[str, Column]:
    amount, person, organization = F.col("amount"), c("contributor.type") == INDIVIDUAL, Organizational().to_column()
    out = {"amount_count": F.when(amount.isNotNull(), F.lit(1))}
    for name, test in (("total", F.lit(True)), ("individual", person), ("organizational", organization)):
        out[f"{name}_money"] = F.when(test, money(amount))
        out[f"{name}_odd"] = F.when(test, odd(amount))
        out[f"{name}_count"] = F.when(test, F.lit(1))
    return out


def refresh_recipient_sums(spark: SparkSession, source_root: str, root: str) -> dict:
    """Brings the sums per recipient from the version of the contributions they stand for to the last one.

    Cycles that did not change are not read, and of those that did only rows that came or
    went are summed. Nothing new: nothing happens. The version before must not have
    expired. Returns the note of the sums.
    """
    known = applied(spark, root)
    new = snapshots.snapshot(spark, source_root)
    if known.get("source") == new.version:
        return known
    start = known.get("source")
    old = snapshots.Snapshot(new.root, 0, {}) if start is None else snapshots.snapshot(spark, source_root, start)
    keys = ["cycle", *RECIPIENT_KEY]
    rows = snapshots.changes(spark, old, new, [*keys, "contributor.type", "amount"], WEIGHT)
    apply(spark, root, rows.where(c("bonica.rid").isNotNull()), keys, _recipient_measures(), {"source": new.version})
    return applied(spark, root)


def recipient_aggregates(spark: SparkSession, root: str) -> DataFrame:
    """The mart of recipient aggregates from its sums."""
    found = sums(spark, root)

    def total(name: str) -> Column:
        return F.when(F.col(f"{name}_odd") > 0, F.lit(float("nan"))).otherwise(F.col(f"{name}_money").cast("double"))

    return found.select(
        *cols(["cycle", *RECIPIENT_KEY]),
        F.when(F.col("amount_count") > 0, total("total")).alias("total_amount"),
        F.when(F.col("amount_count") > 0, total("total") / F.col("amount_count")).alias("avg_amount"),
        F.col("total_count").alias("contribution_count"),
        *[x for n in ("individual", "organizational") for x in (total(n).alias(f"{n}_total"), F.col(f"{n}_count"))],
    )


# ------------------------------------------------------------- industry summary


def change_summary(spark: SparkSession, root: str, changes: DataFrame, batch: int) -> None:
    """Takes weighted gifts into the summary per politician and industry; a batch that is already in is left out.

    Beside the sums it keeps how often each donor gave, hence how many different ones did.
    """
    if applied(spark, f"{root}/sums").get("batch", -1) >= batch:
        return
    gifts = changes.select(F.col("recipient_id").alias("politician_id"), "industry", "donor_id", "amount", WEIGHT)
    gifts = sinks.stored_copy(gifts, "gifts")  # both sums read them
    try:
        # The donors first: the note of the sums is what says that a batch is in.
        donors = f"{root}/donors"
        if applied(spark, donors).get("batch", -1) < batch:
            apply(spark, donors, gifts, ["politician_id", "industry", "donor_id"], {}, {"batch": batch})
        measures = {"n_amount": F.when(F.col("amount").isNotNull(), F.lit(1)), "total": F.col("amount").cast("decimal(24,6)")}
        apply(spark, f"{root}/sums", gifts, ["politician_id", "industry"], measures, {"batch": batch})
    finally:
        sinks.drop_copy(gifts)


def changed_summary(spark: SparkSession, root: str) -> DataFrame:
    """(politician_id, industry, contribution_count, total_amount, avg_amount, donor_count)."""
    found = sums(spark, f"{root}/sums")
    donors = sums(spark, f"{root}/donors").groupBy("politician_id", "industry").agg(F.count("donor_id").alias("donor_count"))
    same = found["politician_id"].eqNullSafe(donors["politician_id"]) & found["industry"].eqNullSafe(donors["industry"])
    return found.join(donors, same).select(
        found["politician_id"],
        found["industry"],
        F.col("rows").alias("contribution_count"),
        F.when(F.col("n_amount") > 0, F.col("total")).alias("total_amount"),
        F.when(F.col("n_amount") > 0, F.col("total") / F.col("n_amount")).alias("avg_amount"),
        "donor_count",
    )
