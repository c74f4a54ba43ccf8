"""End-to-end jobs: ingest raw files, build marts, load subsets, publish."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from polfin.functions.columns import c, cols
from polfin.operators.limits import limit_by_cycle, rows_by_cycle
from polfin.operators.linking import link_table
from polfin.operators.predicates import Predicate, valid_cycles, where_all
from polfin.plans import dimensions, marts, quality
from polfin.sources import readers, sinks, snapshots
from polfin.sources.sinks import stored_copy
from polfin.sources.specs import DEFAULT_CONTRIBUTION_COLUMNS, DatasetSpec

MART_KINDS = ("organizational", "recipient_aggregates", "raw_organizational")
PUBLISHABLE = ("legislators", "legislators_unified", "crosswalk", "organizational", "recipient_aggregates")
# What "all" stands for: the unified legislators are asked for by name.
PUBLISHED_BY_DEFAULT = ("legislators", "crosswalk", "organizational", "recipient_aggregates")
CYCLE_DATASETS = ("organizational", "recipient_aggregates")


# ---------------------------------------------------------------------- ingest


@dataclass
class IngestResult:
    rows: int
    report: DataFrame | None


def conversion_report(source: DataFrame, output: DataFrame, spec: DatasetSpec, keep_one_in: int = 1) -> DataFrame:
    """Row count, checksums and row-by-row equality of a converted file, each side being read once if all is well."""
    sums = [stored_copy(quality.conversion_sums(side, spec, keep_one_in), "conversion") for side in (source, output)]
    totals = quality.totals_of_sums(*sums, spec)
    return totals.unionByName(quality.check_rows(source, output, spec, keep_one_in, sums))


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    source: str,
    output: str,
    *,
    validate: bool = True,
    keep_one_in: int = 1,
    multi_line: bool | None = None,
    parallel: bool | None = None,
) -> IngestResult:
    """Convert a raw CSV file (or a folder of them) to typed Parquet and prove the result.

    The file is parsed once for conversion and checks: sums of row hashes and checksums of
    the source are observed while its rows are written, then the output is read once for
    the same sums. Only if these differ are both read again and compared in detail. The raw
    file is also read as lines, to count its records by quotes. Rows are counted in the
    writing stage, whose tasks count once however often one is retried. A compressed file
    is parsed by one task, so its records are spread right behind the parser, unless there are
    files enough to keep all tasks busy (``readers.lopsided``). Columns keep
    the order of the file.
    """
    text = readers.read_csv_text(spark, source, spec, multi_line, parallel)
    if (parallel is False or not readers.splits(spark, source)) and readers.lopsided(spark, source):
        text = text.hint("rebalance")
    typed = readers.cast_columns(readers.mark_nulls(text, spec), spec)
    if not validate:
        out = sinks.counted(typed)
        sinks.write_parquet(out.df, output)
        return IngestResult(out.rows, None)
    rows, sums = quality.with_row_hash(typed, spec, keep_one_in)
    seen = Observation()
    sinks.write_parquet(rows.observe(seen, *sums).select(*cols(typed.columns)), output)
    stored = spark.read.parquet(output)
    report = quality.observed_report(spark, seen.get, stored, spec, keep_one_in)
    if report is None:
        report = conversion_report(text, stored, spec, keep_one_in)
    raw = quality.check_raw_count(spark, readers.raw_record_count(spark, source), seen.get["rows"])
    return IngestResult(seen.get["rows"], quality.raise_for_status(raw.unionByName(report)))


# ------------------------------------------------------------------ dimensions


def build_unified(
    spark: SparkSession,
    current: DataFrame,
    historical: DataFrame,
    output: str,
    *,
    terms: DataFrame | None = None,
    min_congress: int | None = dimensions.DEFAULT_MIN_CONGRESS,
    validate: bool = True,
    bounds: tuple[int, int] | None = None,
    sample: int | None = None,
) -> DataFrame:
    """Unified legislators, written in key order and checked."""
    people = dimensions.unified_legislators(current, historical, terms, min_congress)
    sinks.write_parquet(people.orderBy("bioguide_id"), output)
    stored = spark.read.parquet(output)
    if validate:
        filtered = terms is not None and min_congress is not None
        limits = bounds or (quality.FILTERED_BOUNDS if filtered else quality.UNFILTERED_BOUNDS)
        quality.raise_for_status(unified_report(stored, current, historical, limits, sample))
    return stored


def unified_report(output, current, historical, bounds, sample=None) -> DataFrame:
    return (
        quality.check_unified_completeness(output, bounds)
        .unionByName(quality.check_unified_coverage(output))
        .unionByName(quality.check_unified_names(output, current, historical, sample))
    )


def unified_summary(current: DataFrame, historical: DataFrame, output: DataFrame) -> DataFrame:
    """One row of facts about a unified table: sizes, people left out, coverage."""
    ids = current.select("bioguide_id").union(historical.select("bioguide_id")).distinct()
    known = ids.agg(
        F.count("bioguide_id").alias("people"),
        F.lit(0).cast("bigint").alias("kept"),
        F.lit(0).cast("bigint").alias("with_fec"),
        F.lit(0).cast("bigint").alias("with_icpsr"),
    )
    kept = output.agg(
        F.lit(0).cast("bigint").alias("people"),
        F.count("*").alias("kept"),
        F.count_if(F.size("fec_ids") > 0).alias("with_fec"),
        F.count("icpsr").alias("with_icpsr"),
    )
    total = known.unionByName(kept).agg(*[F.sum(n).alias(n) for n in known.columns])
    return total.select(
        F.col("kept").alias("output_count"),
        (F.col("people") - F.col("kept")).alias("filtered_out"),
        quality.percent(F.col("with_fec"), F.col("kept")).alias("fec_pct"),
        quality.percent(F.col("with_icpsr"), F.col("kept")).alias("icpsr_pct"),
    )


def build_distinct(
    spark: SparkSession,
    members: DataFrame,
    output: str,
    *,
    min_congress: int = dimensions.DEFAULT_MIN_CONGRESS,
    validate: bool = True,
) -> DataFrame:
    """Distinct legislators, written in key order and checked."""
    people = dimensions.distinct_legislators(members, min_congress)
    sinks.write_parquet(people.orderBy("bioguide_id"), output)
    stored = spark.read.parquet(output)
    if validate:
        quality.raise_for_status(distinct_report(members, stored, min_congress))
    return stored


def distinct_report(members: DataFrame, output: DataFrame, min_congress: int) -> DataFrame:
    return (
        quality.check_distinct_completeness(members, output, min_congress)
        .unionByName(quality.check_distinct_aggregates(members, output, min_congress))
        .unionByName(quality.check_distinct_lists(members, output, min_congress))
        .unionByName(quality.check_distinct_latest(members, output, min_congress))
    )


def build_crosswalk(
    spark: SparkSession, recipients: DataFrame, output: str, *, validate: bool = True, sample: int | None = None
) -> DataFrame:
    """Crosswalk, written in key order and checked."""
    sinks.write_parquet(dimensions.crosswalk(recipients).orderBy("icpsr", "bonica_rid"), output)
    stored = spark.read.parquet(output)
    if validate:
        quality.raise_for_status(crosswalk_report(recipients, stored, sample))
    return stored


def crosswalk_report(recipients: DataFrame, output: DataFrame, sample: int | None = None) -> DataFrame:
    return (
        quality.check_crosswalk_counts(recipients, output)
        .unionByName(quality.check_crosswalk_unique(output))
        .unionByName(quality.check_crosswalk_pairs(recipients, output, sample))
    )


# ----------------------------------------------------------------------- marts


@dataclass
class MartResult:
    kind: str
    written: list[int]
    skipped: list[int]
    missing: list[int]
    report: DataFrame | None = field(default=None, repr=False)
    warnings: list[str] = field(default_factory=list)


def mart(
    kind: str,
    contributions: DataFrame,
    recipients: DataFrame | None = None,
    legislators: DataFrame | None = None,
    mode: str = "all",
    links: DataFrame | None = None,
) -> DataFrame:
    if kind == "organizational":
        return marts.organizational(contributions, recipients, legislators, mode=mode, links=links)
    if kind == "recipient_aggregates":
        return marts.recipient_aggregates(contributions, recipients, legislators, mode=mode, links=links)
    if kind == "raw_organizational":
        if legislators is None:
            raise ValueError("the detailed mart needs legislators")
        return marts.organizational_detail(contributions, recipients, legislators, mode=mode, links=links)
    raise ValueError(f"mart must be one of {MART_KINDS}")


def mart_report(kind: str, contributions: DataFrame, output: DataFrame, mode: str, sample: int | None) -> DataFrame:
    """Checks of one mart.

    Recipients shared by several people appear once per pair in mode ``all``;
    their totals are compared after removing that repetition.
    """
    if kind != "recipient_aggregates":
        if "bioguide_id" in output.columns and mode == "all":
            return quality.check_organizational(contributions, output, rows=quality.rows_before_link(output))
        return quality.check_organizational(contributions, output)
    if "bioguide_id" in output.columns and mode == "all":
        output = output.drop("bioguide_id").distinct()
    return quality.check_aggregates(contributions, output, sample)


def _cycles_to_build(spark: SparkSession, root: str, cycles: Iterable[int] | None) -> tuple[list[int], list[int]]:
    """Cycles that are there, and known ones asked for that are not; a year that is neither is an error."""
    there = readers.existing_cycles(spark, root)
    if cycles is None:
        return there, []
    wanted = list(cycles)
    absent = [x for x in wanted if x not in there]
    if absent:
        valid_cycles(absent, strict=True)
    return [x for x in wanted if x in there], absent


def build_mart(
    spark: SparkSession,
    kind: str,
    contributions_root: str,
    output_root: str,
    cycles: Iterable[int] | None = None,
    *,
    recipients: DataFrame | None = None,
    legislators: DataFrame | None = None,
    mode: str = "all",
    skip_existing: bool = False,
    validate: bool = True,
    sample: int | None = None,
    links: DataFrame | None = None,
) -> MartResult:
    """One mart for many cycles, all of the source by default, in one job.

    Cycles are written where no version of the output shows them and checked there; only
    then does one commit put them in the place of the old ones (``snapshots``). So a cycle
    that is there has passed, ``skip_existing`` can go by that, a reader keeps the version
    it opened, and a run that failed is simply repeated. Jobs for different cycles may run
    at once; of two for the same cycle the later fails. A cycle whose result is empty
    loses its old rows. Cycles without source data are reported, not fatal.
    """
    base = snapshots.snapshot(spark, output_root)
    present, missing = _cycles_to_build(spark, contributions_root, cycles)
    done = base.cycles if skip_existing else {}
    todo = [x for x in present if x not in done]
    skipped = [x for x in present if x in done]
    if not todo:
        return MartResult(kind, [], skipped, missing)
    source = readers.all_cycles(spark, contributions_root).where(F.col("cycle").isin(*todo))
    own_links = None
    if legislators is not None and links is None:
        own_links = links = stored_copy(link_table(recipients, legislators, mode), "links")
    out = mart(kind, source, recipients, legislators, mode, links)
    batch, staging = snapshots.new_batch(output_root)
    report, notes, published = None, [], False
    try:
        if kind == "recipient_aggregates":
            largest_first = [F.col("cycle"), F.col("total_amount").desc_nulls_last()]
            laid_out = out.hint("rebalance", F.col("cycle")).sortWithinPartitions(*largest_first)
            sinks.write_cycles(laid_out, staging, gather=False)
        else:
            # A plain filter keeps the layout of its input; linked rows are gathered anew.
            sinks.write_cycles(out, staging, gather=legislators is not None)
        if validate:
            stored = spark.read.schema(out.schema).parquet(staging).where(F.col("cycle").isin(*todo))
            report = quality.raise_for_status(mart_report(kind, source, stored, mode, sample))
            notes = quality.warnings_of(report)
        snapshots.commit(spark, base, batch, snapshots.stored_schema(out.schema), todo)
        published = True
    finally:
        if not published:
            sinks.remove(spark, staging)
        if own_links is not None:
            sinks.drop_copy(own_links)
    return MartResult(kind, todo, skipped, missing, report, notes)


def build_marts(
    spark: SparkSession,
    contributions_root: str,
    output_root: str,
    cycles: Iterable[int] | None = None,
    *,
    kinds: Sequence[str] = MART_KINDS,
    recipients: DataFrame | None = None,
    legislators: DataFrame | None = None,
    **options,
) -> dict[str, MartResult]:
    """Several marts below one folder, with one link table; the detailed one only with legislators."""
    cycles = None if cycles is None else list(cycles)
    chosen = [k for k in kinds if k != "raw_organizational" or legislators is not None]
    links = None
    if legislators is not None:
        links = stored_copy(link_table(recipients, legislators, options.get("mode", "all")), "links")
    try:
        return {
            kind: build_mart(
                spark,
                kind,
                contributions_root,
                f"{output_root}/{kind}",
                cycles,
                recipients=recipients,
                legislators=legislators,
                links=links,
                **options,
            )
            for kind in chosen
        }
    finally:
        if links is not None:
            sinks.drop_copy(links)


# --------------------------------------------------------------- load, publish


@dataclass
class LoadResult:
    rows: int
    cycles: list[int]
    missing_cycles: list[int]


def subset(
    contributions: DataFrame,
    predicates: Sequence[Predicate] = (),
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    cycles: Sequence[int] | None = None,
    positions: bool = False,
) -> DataFrame:
    """Filtered, projected and capped contributions; the cap fills in cycle order.

    Without ``cycles`` all cycles count that the rows have and the predicates leave.
    ``positions`` is for rows as read from Parquet: a cap then takes them file by file.
    """
    rows = where_all(contributions, predicates)
    if cycles is not None:
        rows = rows.where(F.col("cycle").isin(*cycles))
    names = list(columns or DEFAULT_CONTRIBUTION_COLUMNS)
    if limit is None:
        return rows.select(*cols(names))
    kept = rows.select(*cols(dict.fromkeys(["cycle", *names])))
    return limit_by_cycle(kept, limit, cycles, positions).select(*cols(names))


def load_subset(
    spark: SparkSession,
    root: str,
    sink: Callable[[DataFrame], None],
    *,
    predicates: Sequence[Predicate] = (),
    columns: Sequence[str] | None = None,
    limit: int | None = None,
) -> LoadResult:
    """Load part of the contributions through any sink, such as ``append_table`` or ``write_jdbc``.

    All cycles on disk are loaded that the predicates leave; cycles named in a predicate
    and not on disk are reported.
    """
    present, missing = readers.cycles_to_load(predicates, readers.existing_cycles(spark, root))
    rows = subset(readers.all_cycles(spark, root), predicates, columns, limit, present, positions=True)
    out = sinks.counted(rows)
    sink(out.df)
    return LoadResult(out.rows, present, missing)


def rows_per_cycle(df: DataFrame) -> DataFrame:
    return df.groupBy("cycle").agg(F.count("*").alias("rows"))


def dataset_names(datasets: str | Sequence[str]) -> list[str]:
    """Datasets to publish; "all" works alone and inside a list."""
    asked = [datasets] if isinstance(datasets, str) else list(datasets)
    unknown = set(asked) - set(PUBLISHABLE) - {"all"}
    if unknown:
        raise ValueError(f"unknown dataset {sorted(unknown)}; choose from {PUBLISHABLE}")
    expanded = [n for a in asked for n in (PUBLISHED_BY_DEFAULT if a == "all" else [a])]
    return list(dict.fromkeys(expanded))


def publish(
    frames: Mapping[str, DataFrame],
    sink: Callable[[DataFrame, str], None],
    *,
    datasets: str | Sequence[str] = "all",
    cycles: Sequence[int] | None = None,
    limit: int | None = None,
    tables: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Send datasets to a sink and return the rows of each.

    Dimensions always go out whole; a cap and a choice of cycles apply to the
    per-cycle datasets only, of which all cycles go out by default. A warning names
    chosen cycles that a dataset does not have. Dots leave the column names here.
    """
    counts = {}
    for name in dataset_names(datasets):
        df, copy = frames[name], None
        if name in CYCLE_DATASETS:
            if limit is not None and name == "recipient_aggregates":
                df = copy = stored_copy(df, name)  # counted and read: sums are formed once
            if cycles is not None:
                there = rows_by_cycle(df)
                absent = [x for x in cycles if x not in there]
                if absent:
                    warnings.warn(f"{name} has no rows of the cycles {absent}", stacklevel=2)
            df = limit_by_cycle(df, limit, cycles)
            df = df.select("cycle", *[c(n) for n in df.columns if n != "cycle"])
        out = sinks.counted(sinks.sanitize(df))
        sink(out.df, (tables or {}).get(name, name))
        counts[name] = out.rows
        if copy is not None:
            sinks.drop_copy(copy)
    return counts
