"""Mixing sources to target weights by repetition rates.

Words are counted per document and source; a source's target over its size is the
rate at which its documents repeat. A document is emitted floor(rate) times, plus
once more with the probability of the fraction, drawn from a hash of its id and a
seed, so that reruns agree and the draw needs no state.

Targets stop at ``max_rate`` times a source's size; the excess goes to the other
sources by weight until none is above. That fixed point is found in closed form:
with sources in order of capacity per weight, the full ones are a prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polfin.llm.common import WORD, fresh, stored

# Hex digits of the hash that are drawn: 52 bits, which a double holds exactly.
DRAW_DIGITS = 13


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("long") / F.lit(16**DRAW_DIGITS)


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share_percent: int = 150, max_rate: int = 2
) -> DataFrame:
    """(source, source_size, target) from a frame of (source, size).

    Sources take the weights in turn by code point, NULL last. One row per source
    meets in the windows; documents are summed before. All arithmetic before the one
    division is in whole numbers.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turns = F.array(*[F.lit(int(w)) for w in weights])
    ranked = totals.withColumn("n", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(turns, F.col("n") % len(weights)).cast("long")
    )
    everything = Window.partitionBy()
    fullest = Window.orderBy(F.col("source_size") / F.col("weight"), "n")
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    onwards = fullest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # All in hundredths of a word: to share out, held by full sources before, and weight left.
    left = (
        ranked.withColumn("wanted", F.sum("source_size").over(everything) * share_percent)
        .withColumn("cap", F.col("source_size") * (100 * max_rate))
        .withColumn("left", F.col("wanted") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(onwards))
        .withColumn("full", F.col("left") * F.col("weight") > F.col("cap") * F.col("weight_left"))
    )
    level = F.min(F.when(~F.col("full"), F.struct("n_full", "left", "weight_left"))).over(everything)
    shared = left.withColumn("n_full", F.row_number().over(fullest)).withColumn("level", level)
    target = F.when(F.col("full"), F.col("cap") / F.lit(100.0)).otherwise(
        (F.col("weight") * F.col("level.left")).cast("double") / (F.col("level.weight_left") * 100).cast("double")
    )
    return shared.select("source", "source_size", target.alias("target"))


def repetitions(
    docs: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share_percent: int = 150,
    max_rate: int = 2,
    seed: str = "mix-1",
    text: str = "text",
) -> DataFrame:
    """``docs`` with size, source_size, target and copies added; nothing is emitted yet.

    ``copies`` is floor(target / source_size), plus one with the probability of the
    fraction. Documents without words have size 0; a source without words has target 0
    and no copies. A NULL source is a source of its own. Repeated rows of one doc_id
    are drawn alike. Columns of ``docs`` with one of the four names are replaced.
    """
    new = ("size", "source_size", "target", "copies")
    rest = [c for c in docs.columns if c.lower() not in new]
    sized = docs.select(*[f"`{c}`" for c in rest], word_count(F.col(f"`{text}`")).alias("size"))
    targets = stored(source_targets(sized.select("source", "size"), weights, share_percent, max_rate), "mix-targets")
    name, total, target, rate = fresh(sized.columns, "_source", "_total", "_target", "_rate")
    targets = targets.toDF(name, total, target)
    joined = sized.join(targets, sized["source"].eqNullSafe(targets[name]), "left").withColumn(
        rate, F.when(F.col(total) > 0, F.col(target) / F.col(total)).otherwise(0.0)
    )
    whole = F.floor(rate)
    extra = (draw(F.col("doc_id"), seed) < F.col(rate) - whole).cast("long")
    return joined.select(
        *[f"`{c}`" for c in rest],
        "size",
        F.col(total).alias("source_size"),
        F.col(target).alias("target"),
        (whole + extra).alias("copies"),
    )


def emit(planned: DataFrame) -> DataFrame:
    """Each row ``copies`` times, without the columns that ``repetitions`` added."""
    (each,) = fresh(planned.columns, "_copy")
    rest = [c for c in planned.columns if c not in ("size", "source_size", "target", "copies")]
    return planned.where("copies > 0").withColumn(each, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        *[f"`{c}`" for c in rest]
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: rows of ``docs``, repeated or left out."""
    return emit(repetitions(docs, **options))
