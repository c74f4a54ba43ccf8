"""Checks of outputs against their sources.

Every check returns a report: one row per check with ``check``, ``passed``,
``expected`` and ``actual``. Nothing but such reports is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.functions.columns import c, cols
from polfin.functions.scalars import (
    blank_to_null,
    filled,
    non_empty_array,
    normal_number,
    normal_stripped,
    normal_text,
    percent,
    same_value,
    strip,
    within_cent,
    within_relative,
    without_nan,
)
from polfin.operators.joins import lookup_join
from polfin.operators.limits import sample_keys, sample_rows
from polfin.operators.predicates import INDIVIDUAL
from polfin.operators.sets import duplicate_keys, key_counts, latest_per_key, missing_keys
from polfin.plans.dimensions import LATEST_TIES, crosswalk_pairs, served
from polfin.session import cut_wide_methods
from polfin.sources.sinks import stored_copy
from polfin.sources.specs import DatasetSpec

# Plausible sizes of the unified legislator table.
FILTERED_BOUNDS = (500, 5_000)
UNFILTERED_BOUNDS = (10_000, 15_000)
DIAGNOSTIC_ROWS = 10
# Buckets in which row hashes are summed for a first comparison; a power of two.
SUM_BUCKETS = 4096


class QualityError(Exception):
    """At least one check of a report failed."""


@dataclass(frozen=True)
class Check:
    name: str
    passed: Column
    expected: Column
    actual: Column


def report(metrics: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Turn a one-row frame of metrics into report rows."""
    rows = [
        F.struct(
            F.lit(k.name).alias("check"),
            F.coalesce(k.passed, F.lit(False)).alias("passed"),
            k.expected.cast("double").alias("expected"),
            k.actual.cast("double").alias("actual"),
        )
        for k in checks
    ]
    return metrics.select(F.inline(F.array(*rows)))


def zero(name: str, column: str) -> Check:
    """A check that a count is 0."""
    return Check(name, F.col(column) == 0, F.lit(0), F.col(column))


def equal(name: str, expected: str, actual: str) -> Check:
    return Check(name, F.col(expected).eqNullSafe(F.col(actual)), F.col(expected), F.col(actual))


def all_valid(checks: DataFrame) -> DataFrame:
    return checks.agg(F.coalesce(F.bool_and("passed"), F.lit(False)).alias("all_valid"))


def mart_valid(checks: DataFrame) -> DataFrame:
    """Roll-up of contribution marts: row count, and filter or aggregation."""

    def passed(name: str) -> Column:
        return F.coalesce(F.bool_and(F.when(F.col("check") == name, F.col("passed"))), F.lit(False))

    verdict = passed("row_count") & (passed("filter") | passed("aggregation"))
    return checks.agg(verdict.alias("all_valid"))


def raise_for_status(checks: DataFrame) -> DataFrame:
    """Run a report, raise with every failed check, and return the settled report.

    A report has a handful of rows; the returned one no longer depends on the
    data it was made from.
    """
    rows = checks.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityError("; ".join(f"{r['check']}: expected {r['expected']}, got {r['actual']}" for r in failed))
    return checks.sparkSession.createDataFrame(rows, checks.schema)


def diagnostics(violations: DataFrame, order: Sequence[str]) -> DataFrame:
    """First few offending rows, for a message."""
    return violations.orderBy(*cols(order)).limit(DIAGNOSTIC_ROWS)


def _pair(source: DataFrame, output: DataFrame) -> DataFrame:
    """Two one-row frames with equal columns as one row of source_* and output_*."""
    names = source.columns
    both = source.withColumn("__s", F.lit(True)).unionByName(output.withColumn("__s", F.lit(False)))
    return both.agg(
        *[F.max(F.when(F.col("__s"), c(n))).alias(f"source_{n}") for n in names],
        *[F.max(F.when(~F.col("__s"), c(n))).alias(f"output_{n}") for n in names],
    )


# ---------------------------------------------------------------- conversions


def check_row_count(source: DataFrame, output: DataFrame) -> DataFrame:
    counts = _pair(source.agg(F.count("*").alias("rows")), output.agg(F.count("*").alias("rows")))
    return report(counts, [equal("row_count", "source_rows", "output_rows")])


def checksum_columns(sum_column: str | None, key_columns: Sequence[str]) -> list[Column]:
    """Aggregates behind the checksum comparison; usable with ``observe`` too."""
    result = []
    if sum_column:
        number = c(sum_column).cast("double")
        result.append(F.coalesce(F.sum(without_nan(number)), F.lit(0.0)).alias("total"))
        result.append(F.count_if(F.isnan(number)).alias("nans"))
    return result + [F.count(c(k)).alias(f"filled {k}") for k in key_columns]


def compare_checksums(sum_column: str | None, key_columns: Sequence[str]) -> list[Check]:
    checks = []
    if sum_column:
        total = within_cent(F.col("output_total"), F.col("source_total"))
        checks.append(Check(f"sum {sum_column}", total, F.col("source_total"), F.col("output_total")))
        checks.append(equal(f"nan {sum_column}", "source_nans", "output_nans"))
    for k in key_columns:
        a, b = c(f"source_filled {k}"), c(f"output_filled {k}")
        checks.append(Check(f"filled {k}", a == b, a, b))
    return checks


def check_totals(
    source: DataFrame, output: DataFrame, sum_column: str | None, key_columns: Sequence[str]
) -> DataFrame:
    """Row count and checksums together, in one pass over either side."""
    wanted = [F.count("*").alias("rows"), *checksum_columns(sum_column, key_columns)]
    sums = _pair(source.agg(*wanted), output.agg(*wanted))
    row_count = equal("row_count", "source_rows", "output_rows")
    return report(sums, [row_count, *compare_checksums(sum_column, key_columns)])


def check_raw_count(spark: SparkSession, raw: int, rows: int) -> DataFrame:
    """Records counted in the raw file against rows written."""
    counts = spark.range(1).select(F.lit(raw).cast("bigint").alias("raw"), F.lit(rows).cast("bigint").alias("rows"))
    return report(counts, [equal("raw_count", "raw", "rows")])


def check_checksums(
    source: DataFrame, output: DataFrame, sum_column: str | None, key_columns: Sequence[str]
) -> DataFrame:
    """Sum of one column and filled cells of the key columns, NaN counted apart."""
    wanted = checksum_columns(sum_column, key_columns)
    sums = _pair(source.agg(*wanted), output.agg(*wanted))
    return report(sums, compare_checksums(sum_column, key_columns))


def _number(f: T.StructField) -> Column:
    return normal_number(c(f.name).try_cast("double"))


def _comparable(f: T.StructField, spec: DatasetSpec) -> Column:
    """A cell after normalisation, as text that is never NULL."""
    if isinstance(f.dataType, T.StringType):
        value = normal_text(c(f.name).cast("string"), spec.null_markers, spec.blank_words)
    else:
        value = _number(f).cast("string")
    return F.coalesce(value, F.lit("\x00"))


def row_fingerprint(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Two independent 64-bit hashes of every row after normalisation.

    Texts are stripped and normalised in steps, so that each cell goes through either once.
    """
    cut_wide_methods(df.sparkSession)
    texts = [f.name for f in spec.schema if isinstance(f.dataType, T.StringType)]
    raw = df.select(*[c(f.name).cast("string").alias(f.name) if f.name in texts else _number(f).alias(f.name) for f in spec.schema])
    stripped = raw.select("*", *[strip(c(n)).alias(f"stripped {n}") for n in texts])
    cells = stripped.select(
        *[
            normal_stripped(c(f.name), c(f"stripped {f.name}"), spec.null_markers, spec.blank_words).alias(f.name)
            if f.name in texts
            else c(f.name)
            for f in spec.schema
        ]
    )
    parts = cols(spec.columns)
    return cells.select(_cells_hash(parts, spec.schema).alias("h1"), _cells_hash(parts, spec.schema, F.lit(spec.name)).alias("h2"))


# Helper column of row hashes, and the parts they are summed in.
_HASH = "__row_hash"
_HASH_PARTS = (0, 16, 32, 48)


def _typed(df: DataFrame, f: T.StructField, spec: DatasetSpec) -> Column:
    """A cell as the conversion makes it: null marks gone, declared type, nothing trimmed or rounded."""
    if df.schema[f.name].dataType == f.dataType:
        plain = c(f.name)
    else:
        plain = blank_to_null(c(f.name).cast("string"), spec.null_markers).try_cast(f.dataType)
    return blank_to_null(plain, spec.null_markers) if isinstance(f.dataType, T.StringType) else plain


def _sampled(df: DataFrame, spec: DatasetSpec, keep_one_in: int) -> DataFrame:
    """A stable sample of records, drawn by their key columns."""
    if keep_one_in <= 1:
        return df
    keys = [_comparable(spec.schema[k], spec) for k in spec.key_columns]
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(keep_one_in)) == 0)


def _cells_hash(cells: Sequence[Column], schema: T.StructType, *first: Column) -> Column:
    """One hash of a row's cells, ``first`` before them. NULLs, which hashing skips, become a character no text holds, or a bit of a mask."""
    texts = [isinstance(f.dataType, T.StringType) for f in schema]
    filled = [F.coalesce(x, F.lit("\x00")) if text else x for x, text in zip(cells, texts)]
    numbers = [x for x, text in zip(cells, texts) if not text]
    masks = [
        reduce(lambda a, b: a + b, [F.when(x.isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, x in enumerate(part)])
        for part in (numbers[k : k + 60] for k in range(0, len(numbers), 60))
    ]
    return F.xxhash64(*first, *masks, *filled)


def _typed_hash(df: DataFrame, spec: DatasetSpec) -> Column:
    """One hash of a row as converted."""
    return _cells_hash([_typed(df, f, spec) for f in spec.schema], spec.schema)


def _bucket(h: Column) -> Column:
    """Never NULL by its type, and met by a join: about a condition that holds all columns,
    even that they are not NULL, the optimizer reasons very long."""
    return h.bitwiseAND(F.lit(SUM_BUCKETS - 1).cast("bigint"))


def conversion_sums(df: DataFrame, spec: DatasetSpec, keep_one_in: int = 1) -> DataFrame:
    """Rows, sums of row hashes, and checksums, for each of ``SUM_BUCKETS`` buckets of row hashes.

    With a sample the hashes of other records are left out; rows and checksums always
    count all. Both sides of a conversion have equal sums unless a row differs before
    any trimming and rounding.
    """
    cut_wide_methods(df.sparkSession)
    number = _typed(df, spec.schema[spec.sum_column], spec).cast("double") if spec.sum_column else F.lit(None).cast("double")
    keys = [_comparable(spec.schema[k], spec) for k in spec.key_columns]
    chosen = F.pmod(F.xxhash64(*keys), F.lit(keep_one_in)) == 0 if keep_one_in > 1 else F.lit(True)
    rows = df.select(
        _typed_hash(df, spec).alias("h"),
        chosen.alias("chosen"),
        number.alias("number"),
        *[_typed(df, spec.schema[k], spec).isNotNull().alias(f"is {i}") for i, k in enumerate(spec.key_columns)],
    )
    low = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))
    return rows.groupBy(_bucket(F.col("h")).alias("bucket")).agg(
        F.count("*").alias("rows"),
        F.count_if("chosen").alias("n"),
        F.sum(F.when(F.col("chosen"), low)).alias("low"),
        F.sum(F.when(F.col("chosen"), F.shiftright("h", 32))).alias("high"),
        F.coalesce(F.sum(without_nan(F.col("number"))), F.lit(0.0)).alias("total"),
        F.count_if(F.isnan("number")).alias("nans"),
        *[F.count_if(f"`is {i}`").alias(f"filled {k}") for i, k in enumerate(spec.key_columns)],
    )


def with_row_hash(typed: DataFrame, spec: DatasetSpec, keep_one_in: int = 1) -> tuple[DataFrame, list[Column]]:
    """Converted rows with helper columns, and the aggregates over these that ``conversion_sums`` has, of all rows at once.

    Meant to be observed while the rows are written, so that the source is read only once.
    Hashes are summed in parts of 16 bits: no sum overflows below 2^47 rows.
    """
    cut_wide_methods(typed.sparkSession)
    keys = [_comparable(spec.schema[k], spec) for k in spec.key_columns]
    chosen = F.pmod(F.xxhash64(*keys), F.lit(keep_one_in)) == 0 if keep_one_in > 1 else F.lit(True)
    rows = typed.withColumns({_HASH: F.when(chosen, _cells_hash(cols(spec.columns), spec.schema))})
    number = c(spec.sum_column).cast("double") if spec.sum_column else F.lit(None).cast("double")
    parts = [F.coalesce(F.sum(F.shiftrightunsigned(_HASH, k).bitwiseAND(F.lit(0xFFFF))), F.lit(0)).alias(f"hash {k}") for k in _HASH_PARTS]
    sums = [F.count(F.lit(1)).alias("rows"), F.count(_HASH).alias("n"), *parts]
    sums += [F.coalesce(F.sum(without_nan(number)), F.lit(0.0)).alias("total"), F.count_if(F.isnan(number)).alias("nans")]
    return rows, [*sums, *[F.count(c(k)).alias(f"filled {k}") for k in spec.key_columns]]


def observed_report(spark: SparkSession, source: dict, output: DataFrame, spec: DatasetSpec, keep_one_in: int = 1) -> DataFrame | None:
    """The conversion's report from sums observed of the source, in one pass over the output; None if rows differ."""
    rows, sums = with_row_hash(output, spec, keep_one_in)
    there = rows.agg(*sums)
    found = there.first().asDict()
    hashed = ["n", *(f"hash {k}" for k in _HASH_PARTS)]
    if any(source[k] != found[k] for k in hashed):
        return None
    one = [spark.createDataFrame([tuple(x[n] for n in there.columns)], there.schema) for x in (source, found)]
    same = report(spark.range(1).select(F.lit(0).alias("none")), [zero("rows lost", "none"), zero("rows gained", "none")])
    return totals_of_sums(*one, spec).unionByName(same)


def totals_of_sums(source: DataFrame, output: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Row count and checksums of both sides from their ``conversion_sums``."""
    names = ["rows", "total", "nans", *[f"filled {k}" for k in spec.key_columns]]
    wanted = [F.coalesce(F.sum(c(n)), F.lit(0)).alias(n) for n in names]
    sums = _pair(source.agg(*wanted), output.agg(*wanted))
    row_count = equal("row_count", "source_rows", "output_rows")
    return report(sums, [row_count, *compare_checksums(spec.sum_column, spec.key_columns)])


def _uneven_buckets(source: DataFrame, output: DataFrame) -> list[int]:
    """Buckets whose rows or hash sums differ; at most ``SUM_BUCKETS`` numbers."""
    names = ["n", "low", "high"]
    a = source.select("bucket", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
    b = output.select("bucket", *[(-F.coalesce(n, F.lit(0))).alias(n) for n in names])
    off = a.unionByName(b).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).where("n <> 0 OR low <> 0 OR high <> 0")
    return sorted(r["bucket"] for r in off.collect())


def row_differences(
    source: DataFrame,
    output: DataFrame,
    spec: DatasetSpec,
    keep_one_in: int = 1,
    sums: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Normalised row fingerprints that occur a different number of times on the two sides.

    Hash sums per bucket are compared first (``sums``, or computed here). Rows are
    normalised and compared one by one only in buckets that differ: a row that is equal
    as it stands is never moved, unless differences are in all buckets. ``keep_one_in`` restricts the comparison to a
    sample of records.
    """
    left, right = sums or [conversion_sums(side, spec, keep_one_in) for side in (source, output)]
    uneven = _uneven_buckets(left, right)
    if not uneven:
        return source.sparkSession.createDataFrame([], "h1 bigint, h2 bigint, in_left bigint, in_right bigint")

    spark = source.sparkSession
    off = F.broadcast(spark.createDataFrame([(b,) for b in uneven], "__bucket bigint"))  # SUM_BUCKETS rows at most

    def suspects(side: DataFrame) -> DataFrame:
        if len(uneven) == SUM_BUCKETS:  # no row would be left out, so none is hashed for that
            return row_fingerprint(_sampled(side, spec, keep_one_in), spec)
        marked = side.withColumn("__bucket", _bucket(_typed_hash(side, spec)))
        return row_fingerprint(_sampled(marked.join(off, "__bucket", "left_semi"), spec, keep_one_in), spec)

    return key_counts(suspects(source), suspects(output), ["h1", "h2"]).where("in_left != in_right")


def check_rows(
    source: DataFrame,
    output: DataFrame,
    spec: DatasetSpec,
    keep_one_in: int = 1,
    sums: Sequence[DataFrame] | None = None,
) -> DataFrame:
    """Every source row is in the output exactly as often, and nothing else is."""
    differing = row_differences(source, output, spec, keep_one_in, sums).agg(
        F.coalesce(F.sum(F.greatest(F.col("in_left") - F.col("in_right"), F.lit(0))), F.lit(0)).alias("lost"),
        F.coalesce(F.sum(F.greatest(F.col("in_right") - F.col("in_left"), F.lit(0))), F.lit(0)).alias("gained"),
    )
    return report(differing, [zero("rows lost", "lost"), zero("rows gained", "gained")])


# --------------------------------------------------------------- contributions


def rows_before_link(output: DataFrame) -> DataFrame:
    """Rows of a linked mart before the link repeated them, as a one-row frame.

    Every row of a recipient is repeated once per person linked to it.
    """
    pairs = output.groupBy(c("bonica.rid"), "bioguide_id").agg(F.count("*").alias("n"))
    each = pairs.groupBy(c("bonica.rid")).agg(F.expr("sum(n) div count(*)").alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


def warnings_of(checks: DataFrame) -> list[str]:
    """What a passed report of a mart is still worth saying."""
    rows = {r["check"]: r for r in checks.collect()}
    count = rows.get("row_count")
    if "filter" in rows and count and count["expected"] == count["actual"]:
        return ["the source has no contributions of individuals"]
    return []


def check_organizational(source: DataFrame, output: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """No more rows than the source and no individual among them.

    Equal row counts pass, as a source may hold no individuals; ``warnings_of`` tells.
    ``rows`` gives the rows to be counted where the output repeats them.

    Both spellings of the type column are understood; without one the filter
    check passes unexamined.
    """
    spelling = next((n for n in ("contributor_type", "contributor.type") if n in output.columns), None)
    persons = F.count_if(c(spelling) == INDIVIDUAL) if spelling else F.lit(0).cast("bigint")
    metrics = _pair(
        source.agg(F.count("*").alias("rows"), F.lit(0).cast("bigint").alias("persons")),
        output.agg(F.count("*").alias("rows"), persons.alias("persons"))
        if rows is None
        else rows.crossJoin(output.agg(persons.alias("persons"))),  # two one-row frames
    )
    fewer = F.col("output_rows") <= F.col("source_rows")
    return report(
        metrics,
        [
            Check("row_count", fewer, F.col("source_rows"), F.col("output_rows")),
            zero("filter", "output_persons"),
        ],
    )


def aggregate_differences(
    contributions: DataFrame, aggregates: DataFrame, sample: int | None = None, seed: int = 0
) -> DataFrame:
    """Recipients whose count or sum disagrees between source and aggregates."""
    rid = c("bonica.rid")
    keys = ["cycle", "bonica.rid"] if "cycle" in aggregates.columns else ["bonica.rid"]
    source = contributions.where(rid.isNotNull())
    output = aggregates.where(rid.isNotNull())
    if sample is not None:
        chosen = stored_copy(sample_keys(output, ["bonica.rid"], sample, seed), "sample")
        source = lookup_join(source, chosen, ["bonica.rid"], "left_semi", is_stored=True)
        output = lookup_join(output, chosen, ["bonica.rid"], "left_semi", is_stored=True)
    a = source.groupBy(*cols(keys)).agg(
        F.count("*").alias("expected_count"), F.sum("amount").alias("expected_total")
    )
    b = output.groupBy(*cols(keys)).agg(
        F.sum("contribution_count").alias("actual_count"), F.sum("total_amount").alias("actual_total")
    )
    both = a.join(b, keys, "full")
    count_ok = F.col("expected_count").eqNullSafe(F.col("actual_count"))
    sum_ok = F.coalesce(within_relative(F.col("actual_total"), F.col("expected_total")), F.lit(True))
    return both.select("*", count_ok.alias("count_ok"), sum_ok.alias("sum_ok"))


def check_aggregates(
    contributions: DataFrame, aggregates: DataFrame, sample: int | None = None, seed: int = 0
) -> DataFrame:
    """Counts agree exactly, sums within a cent or a millionth.

    All recipients are compared unless a sample size is given.
    """
    compared = aggregate_differences(contributions, aggregates, sample, seed).agg(
        F.count("*").alias("recipients"),
        F.count_if(~F.col("count_ok")).alias("counts_off"),
        F.count_if(~F.col("sum_ok")).alias("sums_off"),
    )
    off = F.col("counts_off") + F.col("sums_off")
    return report(
        compared,
        [
            Check("row_count", F.col("recipients") > 0, F.lit(1), F.col("recipients")),
            Check("aggregation", off == 0, F.lit(0), off),
        ],
    )


def coverage(df: DataFrame, linked: Column) -> DataFrame:
    """Linked rows, all rows, and the share in per cent."""
    return df.agg(F.count_if(linked).alias("matched"), F.count("*").alias("total")).select(
        "matched", "total", percent(F.col("matched"), F.col("total")).alias("coverage_pct")
    )


def check_links(output: DataFrame, legislators: DataFrame) -> DataFrame:
    """Every linked person exists; the share of linked rows is reported.

    Rows are counted per person first, so a person with very many rows costs one
    row per task in the comparison.
    """
    per_person = output.groupBy("bioguide_id").agg(F.count("*").alias("n"))
    known = legislators.select("bioguide_id").where("bioguide_id IS NOT NULL").distinct()
    marked = per_person.join(known.withColumn("__known", F.lit(True)), "bioguide_id", "left")
    person = filled(F.col("bioguide_id"))
    metrics = marked.agg(
        F.count_if(person & F.col("__known").isNull()).alias("unknown"),
        F.coalesce(F.sum(F.when(F.col("bioguide_id").isNotNull(), F.col("n")).otherwise(0)), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    share = percent(F.col("matched"), F.col("total"))
    return report(
        metrics,
        [
            zero("unknown persons", "unknown"),
            Check("matched rows", F.lit(True), F.col("total"), F.col("matched")),
            Check("coverage", F.lit(True), F.lit(None), share),
        ],
    )


# ---------------------------------------------------------- unified legislators


def check_unified_completeness(output: DataFrame, bounds: tuple[int, int] = UNFILTERED_BOUNDS) -> DataFrame:
    key = F.col("bioguide_id")
    low, high = bounds
    metrics = (
        output.groupBy("bioguide_id")
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum(F.when(filled(key), 0).otherwise(F.col("n"))), F.lit(0)).alias("blank"),
            F.coalesce(F.sum(F.when(key.isNotNull(), F.col("n") - 1).otherwise(F.col("n"))), F.lit(0)).alias("repeated"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        )
    )
    return report(
        metrics,
        [
            zero("blank key", "blank"),
            zero("unique key", "repeated"),
            Check("enough rows", F.col("rows") >= low, F.lit(low), F.col("rows")),
            Check("not too many rows", F.col("rows") <= high, F.lit(high), F.col("rows")),
        ],
    )


def check_unified_coverage(output: DataFrame) -> DataFrame:
    metrics = output.agg(
        F.count("*").alias("rows"),
        F.count_if(non_empty_array(F.col("fec_ids"))).alias("with_fec"),
        F.count("icpsr").alias("with_icpsr"),
    )
    return report(
        metrics,
        [Check(n, F.col(m) > 0, F.lit(1), F.col(m)) for n, m in
         (("not empty", "rows"), ("fec_ids filled", "with_fec"), ("icpsr filled", "with_icpsr"))],
    )


def check_unified_names(
    output: DataFrame, current: DataFrame, historical: DataFrame, sample: int | None = None, seed: int = 0
) -> DataFrame:
    """Names equal those of some row of the proper source file."""
    names = ("last_name", "first_name")
    picked = output if sample is None else sample_rows(output, sample, seed)
    picked = picked.select("bioguide_id", "is_current", *names)
    sources = current.withColumn("is_current", F.lit(True)).unionByName(
        historical.withColumn("is_current", F.lit(False)), allowMissingColumns=True
    )
    there = sources.select("bioguide_id", "is_current", *[F.col(n).alias(f"source_{n}") for n in names]).distinct()
    joined = picked.join(there.withColumn("__there", F.lit(True)), ["bioguide_id", "is_current"], "left")
    agree = reduce(lambda a, b: a & b, [same_value(F.col(n), F.col(f"source_{n}")) for n in names])
    per_person = joined.groupBy("bioguide_id").agg(
        F.max(F.coalesce(F.col("__there"), F.lit(False))).alias("found"),
        F.max(F.col("__there").isNotNull() & agree).alias("same"),
    )
    metrics = per_person.agg(
        F.count("*").alias("people"),
        F.count_if(~F.col("found")).alias("absent"),
        F.count_if(F.col("found") & ~F.col("same")).alias("renamed"),
    )
    return report(
        metrics,
        [
            Check("rows compared", F.col("people") > 0, F.lit(1), F.col("people")),
            zero("found in source", "absent"),
            zero("same name", "renamed"),
        ],
    )


# --------------------------------------------------------- distinct legislators


def check_distinct_completeness(members: DataFrame, output: DataFrame, min_congress: int) -> DataFrame:
    """Every person of the source once, and nobody else."""
    counts = key_counts(served(members, min_congress), output, ["bioguide_id"])
    metrics = counts.agg(
        F.count_if(F.col("in_left") > 0).alias("people"),
        F.coalesce(F.sum("in_right"), F.lit(0)).alias("rows"),
        F.count_if(F.col("in_right") > 1).alias("repeated"),
        F.count_if((F.col("in_left") > 0) & (F.col("in_right") == 0)).alias("missing"),
        F.count_if((F.col("in_left") == 0) & (F.col("in_right") > 0)).alias("extra"),
    )
    return report(
        metrics,
        [
            equal("row_count", "people", "rows"),
            zero("duplicates", "repeated"),
            zero("missing", "missing"),
            zero("extra", "extra"),
        ],
    )


def check_distinct_aggregates(members: DataFrame, output: DataFrame, min_congress: int) -> DataFrame:
    """First and last Congress and the number of sittings, for every person."""
    expected = (
        served(members, min_congress)
        .groupBy("bioguide_id")
        .agg(F.min("congress").alias("first"), F.max("congress").alias("last"), F.count("*").alias("n"))
    )
    both = expected.join(output, "bioguide_id", "full")

    def off(a: str, b: Column, name: str) -> Column:
        return F.count_if(~F.col(a).eqNullSafe(b)).alias(name)

    metrics = both.agg(
        off("first", F.col("first_congress"), "first_off"),
        off("last", F.col("last_congress"), "last_off"),
        off("n", F.size("congresses_served").cast("bigint"), "length_off"),
    )
    return report(
        metrics,
        [
            zero("first_congress", "first_off"),
            zero("last_congress", "last_off"),
            zero("congresses_served length", "length_off"),
        ],
    )


def check_distinct_lists(members: DataFrame, output: DataFrame, min_congress: int) -> DataFrame:
    """Exact contents and order of the Congress list.

    The list is unfolded and counted per person and Congress beside the source;
    no list is rebuilt.
    """
    keys = ["bioguide_id", "congress"]
    listed = output.select("bioguide_id", F.explode("congresses_served").alias("congress"))
    source = served(members, min_congress).select("bioguide_id", F.col("congress").cast("smallint").alias("congress"))
    contents = key_counts(source, listed, keys).agg(
        F.count_if(F.col("in_left") != F.col("in_right")).alias("list_off")
    )
    unsorted = F.col("congresses_served") != F.array_sort("congresses_served")
    order = output.agg(F.count_if(unsorted).alias("unsorted"))
    return report(contents, [zero("list contents", "list_off")]).unionByName(
        report(order, [zero("list order", "unsorted")])
    )


def check_distinct_latest(members: DataFrame, output: DataFrame, min_congress: int) -> DataFrame:
    """Name and state come from the most recent row."""
    source = served(members, min_congress).select("bioguide_id", "congress", *LATEST_TIES)
    latest = latest_per_key(source, ["bioguide_id"], "congress", LATEST_TIES).select(
        "bioguide_id", F.col("bioname").alias("e_name"), F.col("state_abbrev").alias("e_state")
    )
    metrics = latest.join(output, "bioguide_id", "full").agg(
        F.count_if(~F.col("e_name").eqNullSafe(F.col("bioname"))).alias("name_off"),
        F.count_if(~F.col("e_state").eqNullSafe(F.col("state_abbrev"))).alias("state_off"),
    )
    return report(metrics, [zero("latest bioname", "name_off"), zero("latest state_abbrev", "state_off")])


# --------------------------------------------------------------------- crosswalk


def check_crosswalk_counts(recipients: DataFrame, output: DataFrame) -> DataFrame:
    """Rows exist, keys are filled, and there is one row per pair of the source."""
    pairs = crosswalk_pairs(recipients).select("icpsr", "bonica_rid").distinct()
    blank_icpsr = F.count_if(~F.coalesce(filled(F.col("icpsr")), F.lit(False))).alias("blank_icpsr")
    blank_rid = F.count_if(~F.coalesce(filled(F.col("bonica_rid")), F.lit(False))).alias("blank_rid")
    rows = F.count("*").alias("rows")
    metrics = _pair(pairs.agg(rows, blank_icpsr, blank_rid), output.agg(rows, blank_icpsr, blank_rid))
    return report(
        metrics,
        [
            Check("not empty", F.col("output_rows") > 0, F.lit(1), F.col("output_rows")),
            zero("icpsr filled", "output_blank_icpsr"),
            zero("bonica_rid filled", "output_blank_rid"),
            equal("row_count", "source_rows", "output_rows"),
        ],
    )


def check_crosswalk_unique(output: DataFrame) -> DataFrame:
    repeated = duplicate_keys(output, ["icpsr", "bonica_rid"]).agg(F.count("*").alias("repeated"))
    return report(repeated, [zero("unique pairs", "repeated")])


def check_crosswalk_pairs(
    recipients: DataFrame, output: DataFrame, sample: int | None = None, seed: int = 0
) -> DataFrame:
    """Pairs of the crosswalk exist in the source; all of them unless sampled."""
    keys = ["icpsr", "bonica_rid"]
    picked = output.select(*keys) if sample is None else sample_keys(output, keys, sample, seed)
    absent = missing_keys(picked, crosswalk_pairs(recipients), keys).agg(F.count("*").alias("absent"))
    return report(absent, [zero("pairs in source", "absent")])


# ------------------------------------------------------------------- constraints


@dataclass(frozen=True)
class Constraints:
    """Declared rules of a relational table."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    # column -> (parent frame, parent key)
    references: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)


def orphans(children: DataFrame, column: str, parents: DataFrame, key: str) -> DataFrame:
    """Keys without a parent and the number of rows that hold them.

    Rows are counted per key before the join, which takes the weight off any
    dominant key. A NULL key refers to nothing and is no orphan.
    """
    used = children.where(c(column).isNotNull()).groupBy(c(column).alias("key")).agg(F.count("*").alias("rows"))
    return used.join(parents.select(c(key).alias("key")).distinct(), "key", "left_anti")


def check_constraints(df: DataFrame, rules: Constraints) -> DataFrame:
    """Report every declared rule of a table."""
    simple = [F.count_if(c(n).isNull()).alias(f"null {n}") for n in rules.not_null]
    simple += [F.count_if(~c(n).isin(*values)).alias(f"allowed {n}") for n, values in rules.allowed.items()]
    names = [f"null {n}" for n in rules.not_null] + [f"allowed {n}" for n in rules.allowed]
    parts = []
    if simple:
        parts.append(report(df.agg(*simple), [Check(n, c(n) == 0, F.lit(0), c(n)) for n in names]))
    for keys in rules.unique:
        whole = df.where(reduce(lambda a, b: a & b, [c(k).isNotNull() for k in keys]))
        repeated = duplicate_keys(whole, keys).agg(F.count("*").alias("repeated"))
        parts.append(report(repeated, [zero("unique " + ",".join(keys), "repeated")]))
    for column, (parents, key) in rules.references.items():
        lost = orphans(df, column, parents, key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("lost"))
        parts.append(report(lost, [zero(f"reference {column}", "lost")]))
    return reduce(DataFrame.unionByName, parts)
