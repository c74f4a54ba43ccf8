"""How far sources of a language differ in their words: pair tasks over sparse count arrays.

A language keeps the V terms that stand in ``MIN_DOCS`` of its documents. A group, one
(language, source), gives each kept term a price: 1 + floor(10^9 (n + 5) / (N + 5 V)), n
being the term's count there and N the sum of these. Two groups differ by the sum, over
all kept terms, of the distances of their prices.

Terms are counted per task first (``_count_terms``) and shuffled once, by language and
term. Kept terms are dealt into chunks by their hash, about ``CHUNK_TERMS`` each, and have
an id within their chunk; a group's counts of a chunk are one sorted sparse array. Sources
are dealt into blocks of about ``BLOCK_SOURCES``. A pair task gets, for one chunk, the
arrays of two blocks and merges them per unordered pair: overlaps are found by galloping
through the longer array, the terms of one side and those of neither are priced in closed
form. So no task holds more than two blocks of one chunk, however large the vocabulary,
the number of sources or one source may be, and each array is sent to one task per block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polfin.llm.common import ASCII_LOWER, ASCII_UPPER, stored, text_batches

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTH = 5
CHUNK_TERMS = 2048
BLOCK_SOURCES = 8
# Distinct terms a counting task holds before it passes them on, and bytes of a text it cuts at once.
HELD_TERMS = 200_000
SLICE_BYTES = 1 << 20

# Bytes of terms stay (ASCII letters lower-cased; every byte of a character beyond ASCII), others part terms.
_TERM_BYTES = bytes(
    ord(ASCII_LOWER[ASCII_UPPER.index(chr(b))]) if chr(b) in ASCII_UPPER else b if chr(b) in ASCII_LOWER or b >= 128 else 32
    for b in range(256)
)


def _slices(text: str) -> Iterator[list[bytes]]:
    """Terms of a text, slice by slice."""
    raw = text.encode().translate(_TERM_BYTES)
    at = 0
    while at < len(raw):
        end = at + SLICE_BYTES
        if end < len(raw):
            end = raw.find(b" ", end)
            end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs), each term once per group for as many documents as fit."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    names = ["lang", "source", "term", "n", "docs"]

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            size = len(n)
            columns = [pa.array([lang], pa.string()).take(np.zeros(size, np.int64)), pa.array([source], pa.string()).take(np.zeros(size, np.int64))]
            columns += [pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([docs[t] for t in n], pa.int64())], names=names)
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            distinct: set[bytes] = set()
            for terms in _slices(text):
                n.update(terms)
                distinct.update(terms)
            docs.update(distinct)
        if sum(len(n) for n, _ in counts.values()) > HELD_TERMS:
            yield from passed_on()
    yield from passed_on()


def _no_nulls(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n): counts of the kept terms per group and language."""
    text_batches(docs.sparkSession)
    schema = "lang string, source string, term string, n long, docs long"
    counted = _no_nulls(docs).mapInArrow(_count_terms, schema).repartition("lang", "term")
    each = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    every = each.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_docs", F.sum("docs").over(of_term))
    return every.where(F.col("lang_docs") >= min_docs).select("lang", "term", "source", "n", "lang_n")


def price(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), three digits at a time so that no product overflows."""
    rest, whole, out = n + F.lit(SMOOTH), total + F.lit(SMOOTH) * terms, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * F.lit(1000)
        out = out * F.lit(1000) + F.call_function("div", rest, whole)
        rest = rest % whole
    return out + F.lit(1)


def prices(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``price`` on arrays; exact below 9 * 10^15 counted words."""
    rest, whole = np.asarray(n, np.int64) + SMOOTH, total + SMOOTH * terms
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // whole
        rest = rest % whole
    return out + 1


def gallop(few: np.ndarray, many: np.ndarray, block: int = 64) -> np.ndarray:
    """Of each of ``few`` its place in ``many``, both sorted: ranges doubled from the last place on, then halved."""
    out = np.empty(len(few), np.int64)
    low = 0
    for at in range(0, len(few), block):
        part = few[at : at + block]
        high, step = low, 1
        while high < len(many) and many[high] < part[-1]:
            high += step
            step *= 2
        out[at : at + block] = low + np.searchsorted(many[low : high + 1], part)
        low = int(out[at + len(part) - 1])
    return out


def difference(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], totals: tuple[int, int], size: int, terms: int) -> int:
    """Summed distance of prices over the ``size`` terms of a chunk, from the (ids, counts) of two groups."""
    if not size:
        return 0
    pa_, pb = (prices(x[1], t, terms) for x, t in zip((a, b), totals))
    none_a, none_b = (int(prices(np.zeros(1), t, terms)[0]) for t in totals)
    swapped = len(a[0]) > len(b[0])
    few, many = (b[0], a[0]) if swapped else (a[0], b[0])
    place = gallop(few, many)
    met = place < len(many)
    met[met] = many[place[met]] == few[met]
    in_few, in_many = np.flatnonzero(met), place[met]
    in_a, in_b = (in_many, in_few) if swapped else (in_few, in_many)
    only_a, only_b = np.ones(len(pa_), bool), np.ones(len(pb), bool)
    only_a[in_a] = False
    only_b[in_b] = False
    absent = size - len(pa_) - len(pb) + len(in_a)
    return (
        int(np.abs(pa_[in_a] - pb[in_b]).sum())
        + int(np.abs(pa_[only_a] - none_b).sum())
        + int(np.abs(pb[only_b] - none_a).sum())
        + absent * abs(none_a - none_b)
    )


def _pair_task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Differences of all pairs of one source of the first block and one of the second, in one chunk."""
    lang, _, first, second = key
    sides = {
        r.source: (r.block, (np.asarray(r.ids, np.int64), np.asarray(r.counts, np.int64)), int(r.total), int(r.size), int(r.terms))
        for r in rows.itertuples()
    }
    left = sorted(s for s, x in sides.items() if x[0] == first)
    right = sorted(s for s, x in sides.items() if x[0] == second)
    out = []
    for s in left:
        for t in right:
            if first != second or s < t:
                (_, a, n_a, size, terms), (_, b, n_b, _, _) = sides[s], sides[t]
                out.append((lang, s, t, difference(a, b, (n_a, n_b), size, terms)))
    return pd.DataFrame(out, columns=["lang", "a", "b", "value"]).astype({"value": "int64"})


def _statistics(kept: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lang, terms, lang_total, chunks) and (lang, source, total), of all languages and groups that occur."""
    groups = _no_nulls(docs).select("lang", "source").distinct()
    by_lang = kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang")
    langs = groups.select("lang").distinct().join(by_lang.agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total")), "lang", "left")
    langs = langs.na.fill(0, ["terms", "lang_total"])
    chunks = F.greatest(F.lit(1), F.ceil(F.col("terms") / CHUNK_TERMS)).cast("int")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    return langs.withColumn("chunks", chunks), groups.join(totals, ["lang", "source"], "left").na.fill(0, ["total"])


def pair_values(kept: DataFrame, langs: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every unordered pair of sources of a language, a before b."""
    dealt = kept.join(langs.select("lang", "chunks"), "lang").withColumn("chunk", F.expr("pmod(xxhash64(term), chunks)").cast("int"))
    in_chunk = Window.partitionBy("lang", "chunk").orderBy("term")
    numbered = dealt.select("lang", "chunk", "source", "n", F.dense_rank().over(in_chunk).alias("id"))
    entries = F.array_sort(F.collect_list(F.struct("id", "n")))
    arrays = numbered.groupBy("lang", "chunk", "source").agg(entries.alias("e"))
    arrays = stored(arrays.select("lang", "chunk", "source", F.col("e.id").alias("ids"), F.col("e.n").alias("counts")), "divergence-arrays")
    # An id beyond those of all groups does not exist, so the largest is the number of terms of the chunk.
    sizes = arrays.groupBy("lang", "chunk").agg(F.max(F.array_max("ids")).alias("size"))

    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SOURCES).cast("int").alias("blocks"))
    every = langs.join(blocks, "lang").select("lang", "terms", "blocks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    cells = every.join(sizes, ["lang", "chunk"], "left").na.fill(0, ["size"]).join(groups, "lang").join(arrays, ["lang", "chunk", "source"], "left")
    # Every cell goes to one task per block of sources that its own is paired with.
    block = F.expr("pmod(xxhash64(source), blocks)").cast("int")
    sent = cells.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    empty = F.array().cast("array<bigint>")
    tasks = sent.select(
        "lang",
        "chunk",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "source",
        "block",
        "total",
        "size",
        "terms",
        F.coalesce(F.col("ids").cast("array<bigint>"), empty).alias("ids"),
        F.coalesce("counts", empty).alias("counts"),
    )
    parts = tasks.groupBy("lang", "chunk", "first", "second").applyInPandas(_pair_task, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def term_values(kept: DataFrame, langs: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): kept terms that a group uses more than its language, by how much."""
    joined = kept.join(langs, "lang").join(groups, ["lang", "source"])
    own, whole = price(F.col("n"), F.col("total"), F.col("terms")), price(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    valued = joined.select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value"))
    return valued.where(F.col("value") > 0)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of ``docs``.

    Part ``pair`` has a row for each other source of the language, part ``term`` the
    ``top_terms`` terms that stand out most. NULL text, lang and source count as ''. A text
    without terms still makes its group occur; a group without kept terms, or a language
    that keeps none (then all values are 0), has its pairs. Each row is a document, repeated
    or not. Equal values are ranked by item in the order of UTF-8. Further columns are
    ignored; an empty table gives an empty result.
    """
    kept = stored(kept_terms(docs, min_docs), "divergence-terms")
    langs, groups = (stored(x, f"divergence-{name}") for x, name in zip(_statistics(kept, docs), ("langs", "groups")))
    pairs = stored(pair_values(kept, langs, groups), "divergence-pairs")
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    both = pairs.select("lang", ways.alias("way"), "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    of_pairs = both.withColumn("rank", rank)
    terms = term_values(kept, langs, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value")
    return of_pairs.unionByName(terms.withColumn("rank", rank).where(F.col("rank") <= top_terms))
