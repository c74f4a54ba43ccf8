"""Quality rules with thresholds learned per language and source.

Every document is measured once. The measures of documents that pass the base rules
go into quantile sketches per (language, source): counts of values rounded down to
six significant bits, so a sketch has a bounded number of entries, its quantiles a
relative error below 1/32, and sketches merge by adding counts. A measure's bound is
its upper quartile plus ``SPREADS`` times the spread between quartiles (or, where low
values are suspicious too, the lower quartile minus that). Groups of few documents
take the merged sketch of their language, then of all.

Only DataFrame functions are used. Texts never leave the scan: what is shuffled is
one entry per sketch value and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polfin.llm.common import WORD, fresh, stored, text_key

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = r"[#*$%&|<>]"
SPREADS = 3
MIN_GROUP = 50
SIGNIFICANT_BITS = 6
# Measures as whole numbers: numerator, factor, denominator, the least spread, and whether low values count against a text.
MEASURES = {
    "mean_word": ("word_chars", 1_000, "n_words", 500, True),
    "symbols": ("n_symbols", 1_000_000, "word_chars", 20_000, False),
    "dup_lines": ("n_dup_lines", 1_000_000, "n_lines", 200_000, False),
    "repeats": ("n_repeat_words", 1_000_000, "n_words", 70_000, False),
}


def _covered(starts: Column) -> Column:
    """Places covered by windows at the sorted ``starts``."""
    return F.aggregate(
        F.transform(starts, lambda s, i: F.coalesce(F.least(F.get(starts, i + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, text_key, lang, source) and the base counts of every row's whole text.

    Windows are compared within their text by 64-bit hashes: hashes are sorted with
    their places, and neighbours that agree are repeats. Nothing is exploded.
    """
    words = docs.select(
        "doc_id",
        text_key(F.col(text)).alias("text_key"),
        "lang",
        "source",
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    ).withColumn("words", F.regexp_extract_all("body", F.lit(WORD), 0))
    w, n = F.col("words"), F.size("words")
    window = lambda i: F.xxhash64(*[F.get(w, i + F.lit(k)) for k in range(WINDOW)])
    hashed = words.withColumn(
        "windows", F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window)).otherwise(F.array().cast("array<bigint>"))
    )
    h = F.col("windows")
    has_repeats = F.size(F.array_distinct(h)) < F.size(h)
    placed = hashed.withColumn(
        "placed", F.when(has_repeats, F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    )
    p = F.col("placed")
    repeated = placed.withColumn(
        "starts",
        F.when(
            p.isNotNull(),
            F.array_sort(
                F.transform(
                    F.filter(
                        p,
                        lambda x, j: F.coalesce(x["h"] == F.get(p, j - 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(p, j + 1)["h"], F.lit(False)),
                    ),
                    lambda x: x["i"],
                )
            ),
        ),
    )
    lines = F.filter(F.split("body", "\n", -1), lambda line: line.rlike(WORD))
    counted = repeated.withColumn("lines", lines)
    return counted.select(
        "doc_id",
        "text_key",
        "lang",
        "source",
        n.cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _value(name: str) -> Column:
    top, factor, bottom, _, _ = MEASURES[name]
    return F.expr(f"CASE WHEN {bottom} > 0 THEN ({top} * {factor}L) div {bottom} ELSE 0L END")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n) of the documents that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _value(m).alias("value")) for m in MEASURES])
    each = measured.where(~base_failed()).select("lang", "source", F.explode(pairs).alias("m")).select("lang", "source", "m.*")
    shift = F.greatest(F.length(F.bin("value")) - SIGNIFICANT_BITS, F.lit(0))
    rough = F.call_function("shiftleft", F.call_function("shiftright", F.col("value"), shift), shift)
    return each.groupBy("lang", "source", "measure", rough.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merges sketches by ``keys``; one row per group with documents and quartiles of each measure."""
    merged = sketch.groupBy(*keys, "measure", "value").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    run = merged.withColumn("upto", F.sum("n").over(group.orderBy("value"))).withColumn("total", F.sum("n").over(group))
    cells = [F.max(F.when(F.col("measure") == next(iter(MEASURES)), F.col("total"))).alias("docs")]
    for m in MEASURES:
        for q in (1, 3):
            at = (F.col("measure") == m) & (4 * F.col("upto") >= q * F.col("total"))
            cells.append(F.min(F.when(at, F.col("value"))).alias(f"{m}_q{q}"))
    return run.groupBy(*keys).agg(*cells)


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, bounds): bounds is a struct of <measure>_low and <measure>_high.

    A group with fewer than ``MIN_GROUP`` documents takes the bounds of its language, or of all.
    """
    of_all = lambda df: F.struct(*[c for c in df.columns if c not in ("lang", "source")])
    fine, lang, every = _quartiles(sketch, ["lang", "source"]), _quartiles(sketch, ["lang"]), _quartiles(sketch, [])
    fine = fine.select("lang", "source", of_all(fine).alias("fine"))
    lang = lang.select(F.col("lang").alias("_lang"), of_all(lang).alias("by_lang"))
    every = every.select(of_all(every).alias("every"))
    both = fine.join(lang, fine["lang"].eqNullSafe(lang["_lang"])).join(F.broadcast(every))  # ``every`` is one row
    q = F.when(F.col("fine.docs") >= MIN_GROUP, F.col("fine")).when(F.col("by_lang.docs") >= MIN_GROUP, F.col("by_lang"))
    picked = both.select("lang", "source", q.otherwise(F.col("every")).alias("q"))
    bounds = []
    for m, (_, _, _, least, two_sided) in MEASURES.items():
        spread = SPREADS * F.greatest(F.col(f"q.{m}_q3") - F.col(f"q.{m}_q1"), F.lit(least))
        bounds.append((F.col(f"q.{m}_q3") + spread).alias(f"{m}_high"))
        if two_sided:
            bounds.append((F.col(f"q.{m}_q1") - spread).alias(f"{m}_low"))
    return picked.select("lang", "source", F.struct(*bounds).alias("bounds"))


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts, base_failed, ``reasons`` (measures out of bounds) and kept.

    A NULL text has no words and fails the base rules. NULL languages and sources are
    groups of their own. Repeated rows weigh as often as they come. A group all of whose
    documents fail the base rules has no bounds and needs none. Further columns are
    ignored; an empty table gives an empty result.
    """
    measured = stored(measure(docs), "quality-measures")
    limits = stored(thresholds(sketches(measured)), "quality-bounds").toDF("_lang", "_source", "bounds")
    joined = measured.join(
        limits, measured["lang"].eqNullSafe(limits["_lang"]) & measured["source"].eqNullSafe(limits["_source"]), "left"
    )
    out = []
    for m, (_, _, _, _, two_sided) in MEASURES.items():
        bad = _value(m) > F.col(f"bounds.{m}_high")
        if two_sided:
            bad = bad | (_value(m) < F.col(f"bounds.{m}_low"))
        out.append(F.when(bad, F.lit(m)))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("reasons", F.array_compact(F.array(*out)))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("reasons") == 0)).drop("_lang", "_source", "bounds")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    key, doc, tk = fresh(docs.columns, "_key", "_doc", "_tk")
    good = judge(docs).where("kept").select(F.col("doc_id").alias(doc), F.col("text_key").alias(tk)).distinct()
    keyed = docs.withColumn(key, text_key(F.col("text")))
    return keyed.join(good, keyed["doc_id"].eqNullSafe(good[doc]) & (keyed[key] == good[tk]), "left_semi").drop(key)
