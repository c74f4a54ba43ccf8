"""Benchmark decontamination by template canonicalisation.

Texts and benchmark items are brought to templates: numbers, names and units become
typed placeholders, other words are lower-cased. Windows of ``WINDOW`` template words
are hashed and joined by equality with those of the benchmark. For documents that
meet an item, the words behind the placeholders are looked at: within one alignment,
equal slot values of the item must stand for equal values of the document, else the
agreement is by chance. An item whose words are covered to ``COVERAGE_PERCENT`` by
consistent windows has leaked, as it stands or with other numbers and names.

A capital that starts a sentence may be that of a name or not: templates come in two
forms, with and without placeholders there, and slot consistency tells.

Beside the templates, items are looked for word for word, whatever their case: one that
stands whole has leaked, however short or full of numbers it is, and so has one of which
``RUN`` words in a row stand, whatever their share of the item.

Templates are dear, so texts are cut into plain words first. Every window that is looked
for has an anchor: of its literal words, and of the pairs of such side by side, the one
that is rarest in all documents. A text without any anchor has none of the windows, so
templates are made of the others only.

Only DataFrame functions are used. Of such a document all windows are hashed where it
is read; only those that the benchmark has go on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polfin.llm.common import fresh, stored, text_key

WINDOW = 8
# Of the words of a window so many at least are no placeholders; else any list of numbers would match any other.
MIN_LITERAL = 4
# Items with fewer words are looked for word for word only, since their templates cannot be told from chance.
MIN_ITEM = 5
COVERAGE_PERCENT = 50
# So many words in a row, word for word, are a leak of the item.
RUN = 13
# Documents are removed for items of so many words at least; shorter ones, such as "yes", are reported by ``leaks`` only.
MIN_REMOVED = 5
# Up to so many anchors are looked up within the row; more are joined, with the same result.
LITERAL_ANCHORS = 20_000

# Units that may follow a number.
UNITS = (
    "km m cm mm mi mile miles feet ft inch inches kg g mg lb lbs pound pounds ton tons litre litres liter liters l ml "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "euro euros dollar dollars cent cents percent kilometre kilometres kilometer kilometers metre metres meter meters"
).split()
# Numbers in words.
NUMBER_WORDS = "two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()

_OPEN, _CLOSE, _SPLIT = "\x01", "\x02", "\x03"
_NUMBER = r"(?<![\p{L}\d])\d+(?:[.,:/]\d+)*(?![\p{L}\d])"
_NUMBER_WORD = r"(?i)(?<![\p{L}\p{M}\d])(?:" + "|".join(NUMBER_WORDS) + r")(?![\p{L}\p{M}\d])"
# A capital in the middle of a sentence, up to the end of the word.
_NAME = r"\p{Lu}(?<=[\p{Ll}\d,\x02] .)[\p{L}\p{M}]*"
# Any capital at the start of a word; the first word of a sentence may be a name.
_ANY_NAME = r"(?<![\p{L}\p{M}\d\x03])\p{Lu}[\p{L}\p{M}]*"
_UNIT = _CLOSE + r" ?(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r"|[%$€£])(?![\p{L}\d])"
_WORD = r"[\p{L}\p{M}\d]+"
_TOKEN = _OPEN + "[^" + _CLOSE + "]*" + _CLOSE + "|" + _WORD


def template_words(text: Column, name: str = _NAME) -> Column:
    """Words of a text with placeholders in place; a placeholder is its type and, after a mark, the word it stands for.

    One word of the text is one element, whatever it became.
    """
    clean = F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE + _SPLIT, "   ")
    slot = lambda kind, group: f"{_OPEN}{kind}{_SPLIT}${group}{_CLOSE}"
    numbers = F.regexp_replace(clean, "(" + _NUMBER + ")", slot("num", 1))
    words = F.regexp_replace(numbers, "(" + _NUMBER_WORD + ")", slot("num", 1))
    units = F.regexp_replace(words, _UNIT, f"{_CLOSE} " + slot("unit", 1))
    names = F.regexp_replace(units, "(" + name + ")", slot("name", 1))
    return F.regexp_extract_all(F.lower(names), F.lit(_TOKEN), 0)


def template_only(text: Column, name: str = _NAME) -> Column:
    """The same words, placeholders without what they stand for; elements agree in number and order."""
    clean = F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE + _SPLIT, "   ")
    slot = lambda kind: f"{_OPEN}{kind}{_CLOSE}"
    numbers = F.regexp_replace(clean, _NUMBER, slot("num"))
    words = F.regexp_replace(numbers, _NUMBER_WORD, slot("num"))
    units = F.regexp_replace(words, _UNIT, f"{_CLOSE} " + slot("unit"))
    names = F.regexp_replace(units, name, slot("name"))
    return F.regexp_extract_all(F.lower(names), F.lit(_TOKEN), 0)


def _is_slot(word: Column) -> Column:
    return word.startswith(_OPEN)


def _window_hashes(words: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` template words, in order."""
    hashed = lambda i: F.xxhash64(F.lit(size), *[F.get(words, i + F.lit(k)) for k in range(size)])
    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), hashed)).otherwise(none)


def _placed_hashes(hashes: Column, **fixed: Column) -> Column:
    """Structs of the ``fixed`` values, the place and the hash of each window."""
    return F.transform(hashes, lambda h, i: F.struct(*[v.alias(k) for k, v in fixed.items()], i.alias("at"), h.alias("hash")))


def _by_size(size: Column, sizes: Iterable[int], of: Callable[[int], Column]) -> Column:
    """What ``of`` makes of the row's own size, NULL if that is none of ``sizes``.

    One expression, not a union of a frame per size: each frame of a union is a scan of its own, and
    with each scan and stage the driver sends out settings and code, for all of them at once.
    """
    return F.coalesce(*[F.when(size == s, of(s)) for s in sizes])


def _anchors(window: Column, literal: Callable[[Column], Column]) -> Column:
    """Hashes of every two literal words side by side in a window, and of every literal word."""
    named = lambda x: F.coalesce(literal(x), F.lit(False))
    pair = lambda x, i: F.when(named(x) & named(F.get(window, i + 1)), F.xxhash64(x, F.get(window, i + 1)))
    one = lambda x: F.when(named(x), F.xxhash64(F.lit(1), x))
    return F.array_compact(F.concat(F.transform(window, pair), F.transform(window, one)))


def _literal(word: Column) -> Column:
    """Words of a template that are words of the text as they stand: letters only, since digits may part from letters."""
    return word.rlike(r"^[\p{L}\p{M}]+$")


def _text_anchors(text: Column) -> Column:
    """Hashes of all neighbours and of all words of a text."""

    def hashed(w: Column) -> Column:
        return F.concat(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1))), F.transform(w, lambda x: F.xxhash64(F.lit(1), x)))

    # The words are bound by a transform around them, or they would be cut anew for each word.
    return F.get(F.transform(F.array(plain_words(text)), hashed), F.lit(0))


def _suspects(docs: DataFrame, windows: Sequence[DataFrame]) -> DataFrame:
    """(doc_id, text) of the documents that have an anchor of ``windows``; all if some window has none.

    The anchor of a window is that of its pairs and words which is rarest in the documents,
    counted in all of them.
    """
    named = reduce(DataFrame.unionByName, [w.select(F.array_sort("anchors").alias("anchors")) for w in windows]).distinct()
    named = stored(named, "benchmark-anchors")
    if named.where(F.size("anchors") == 0).limit(1).count():
        return docs.select("doc_id", "text")
    wanted = stored(named.select(F.explode("anchors").alias("anchor")).distinct(), "benchmark-anchor-hashes")
    every = docs.select(F.explode(_text_anchors(F.col("text"))).alias("anchor")).join(wanted, "anchor", "left_semi")
    often = stored(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")), "benchmark-anchor-counts")
    counted = named.select("anchors", F.explode("anchors").alias("anchor")).join(often, "anchor", "left")
    rarest = counted.groupBy("anchors").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("anchor"))).alias("best"))
    # A window whose rarest part stands nowhere stands nowhere itself.
    chosen = stored(rarest.where("best.n > 0").select("best.anchor").distinct(), "benchmark-rarest")
    if chosen.count() <= LITERAL_ANCHORS:
        near = [r["anchor"] for r in chosen.collect()]
        known = F.exists(_text_anchors(F.col("text")), lambda h: h.isin(near)) if near else F.lit(False)
        return stored(docs.select("doc_id", "text").where(known), "suspect-texts")
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.explode(_text_anchors(F.col("text"))).alias("anchor"))
    met = keyed.join(chosen, "anchor", "left_semi")
    who = stored(met.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct(), "suspects")
    texts = docs.select("doc_id", "text")
    return stored(
        texts.join(who, texts["doc_id"].eqNullSafe(who["_doc"]) & (text_key(texts["text"]) == who["_key"]), "left_semi"),
        "suspect-texts",
    )


def item_windows(benchmark: DataFrame, name: str = _NAME) -> DataFrame:
    """(item_id, n_words, size, at, hash, slots, anchors) of every window that may be looked for.

    An item shorter than ``WINDOW`` is one window of its own size. ``slots`` are the
    places of placeholders, counted from the start of the item. The first window comes
    in a second form, with a name for its first word, which looks like one where the
    item stands inside a sentence.
    """
    items = benchmark.select("item_id", template_only(F.col("text"), name).alias("words")).withColumn("n_words", F.size("words"))
    items = items.where(F.col("n_words") >= MIN_ITEM).distinct()
    items = items.withColumn("size", F.least(F.col("n_words"), F.lit(WINDOW)))
    inside = F.concat(F.array(F.lit(f"{_OPEN}name{_CLOSE}")), F.slice("words", F.lit(2), F.col("n_words")))
    hashes = lambda words: _by_size(F.col("size"), range(MIN_ITEM, WINDOW + 1), lambda s: _window_hashes(words, s))
    every = _placed_hashes(hashes(F.col("words")), skip=F.lit(0))
    first = _placed_hashes(hashes(F.slice(inside, F.lit(1), F.col("size"))), skip=F.lit(1))
    window = F.slice("words", F.col("at") + 1, F.col("size"))
    places = F.filter(F.transform(window, lambda w, i: F.when(_is_slot(w), i + F.col("at"))), lambda x: x.isNotNull())
    # Windows of short items need fewer literal words, in proportion.
    return (
        items.withColumn("each", F.explode(F.when(_is_slot(F.get("words", F.lit(0))), every).otherwise(F.concat(every, first))))
        .select("item_id", "n_words", "words", "each.*", "size")
        .withColumn("slots", places)
        .where((F.col("size") - F.size("slots")) * WINDOW >= MIN_LITERAL * F.col("size"))
        .withColumn("looked", F.slice("words", F.col("at") + F.col("skip") + 1, F.col("size") - F.col("skip")))
        .withColumn("anchors", _anchors(F.col("looked"), _literal))
        .drop("words", "looked", "skip")
    )


def _document_windows(docs: DataFrame, wanted: DataFrame, sizes: list[int], name: str) -> DataFrame:
    """(doc_id, text_key, start, hash) of windows whose hash is ``wanted``."""
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), template_only(F.col("text"), name).alias("words"))
    every = F.concat(*[_placed_hashes(_window_hashes(F.col("words"), s)) for s in sizes])
    placed = keyed.select("doc_id", "text_key", F.explode(every).alias("each"))
    return placed.select("doc_id", "text_key", F.col("each.at").alias("start"), "each.hash").join(wanted, "hash", "left_semi")


def _covered(starts: Column, size: Column) -> Column:
    """Words covered by windows of ``size`` at the sorted ``starts``."""
    step = lambda s, i: F.coalesce(F.least(F.get(starts, i + 1) - s, size), size)
    return F.aggregate(F.transform(starts, step), F.lit(0), lambda a, b: a + b)


def plain_words(text: Column) -> Column:
    """Lower-cased words, without regard to templates."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), 0)


def verbatim_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, size, at, hash, anchors) of every run that is looked for word for word."""
    items = benchmark.select("item_id", plain_words(F.col("text")).alias("words")).withColumn("n_words", F.size("words")).distinct()
    items = items.withColumn("size", F.least(F.col("n_words"), F.lit(RUN)))
    hashes = _by_size(F.col("size"), range(1, RUN + 1), lambda s: _window_hashes(F.col("words"), s))
    placed = items.select("item_id", "n_words", "words", "size", F.posexplode(hashes).alias("at", "hash"))
    every = placed.withColumn("looked", F.slice("words", F.col("at") + 1, F.col("size")))
    return every.withColumn("anchors", _anchors(F.col("looked"), lambda x: x.isNotNull())).drop("words", "looked")


def verbatim(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_words, n_covered): items of which ``RUN`` words in a row, or all of fewer, stand in documents.

    ``windows`` are stored ``verbatim_windows``. Words are those of ``plain_words``;
    ``n_covered`` counts the item's words in such runs.
    """
    sizes = [r.size for r in windows.select("size").distinct().collect()] or [RUN]  # from 1 to 13
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), plain_words(F.col("text")).alias("words"))
    hashes = F.array_distinct(F.concat(*[_window_hashes(F.col("words"), s) for s in sizes]))
    runs = keyed.select("doc_id", "text_key", F.explode(hashes).alias("hash")).join(windows, "hash")
    return (
        runs.groupBy("doc_id", "text_key", "item_id", "n_words", "size")
        .agg(F.array_sort(F.collect_set("at")).alias("ats"))
        .select("doc_id", "text_key", "item_id", "n_words", _covered(F.col("ats"), F.col("size")).alias("n_covered"))
    )


def _added(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` and the rows of ``more`` for documents and items that it has none for."""
    same = [found[k].eqNullSafe(more[k]) for k in ("doc_id", "text_key", "item_id")]
    return found.unionByName(more.join(found, reduce(lambda x, y: x & y, same), "left_anti"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_words, n_covered, n_slots, n_changed): items found in documents.

    ``n_slots`` counts placeholders that consistent windows cover, ``n_changed`` those
    that stand for other words than in the item. A document with several items has a
    row for each. Items that are found word for word only have no placeholders, and their
    words are those of ``plain_words``; items without words are not looked for. NULL or
    empty texts match nothing; repeated rows, of documents or of the benchmark, give one
    row. Further columns are ignored.
    """
    forms = {name: stored(item_windows(benchmark, name), "benchmark-windows") for name in (_NAME, _ANY_NAME)}
    runs = stored(verbatim_windows(benchmark), "verbatim-windows")
    docs = _suspects(docs, [*forms.values(), runs])
    in_sentences = stored(template_leaks(docs, benchmark, _NAME, forms[_NAME]), "leaks-templates")
    any_names = stored(template_leaks(docs, benchmark, _ANY_NAME, forms[_ANY_NAME]), "leaks-names")
    by_templates = _added(in_sentences, any_names)
    none = F.lit(0).cast("long")
    by_words = verbatim(docs, runs).select(
        "doc_id",
        "text_key",
        "item_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_covered").cast("long").alias("n_covered"),
        none.alias("n_slots"),
        none.alias("n_changed"),
    )
    return _added(by_templates, stored(by_words, "leaks-verbatim"))


def template_leaks(docs: DataFrame, benchmark: DataFrame, name: str = _NAME, windows: DataFrame | None = None) -> DataFrame:
    """The rows of ``leaks`` for items that are covered by template windows, with names as ``name`` finds them."""
    windows = windows or stored(item_windows(benchmark, name), "benchmark-windows")
    sizes = [r.size for r in windows.select("size").distinct().collect()]  # from 5 to 8
    wanted = stored(windows.select("hash").distinct(), "benchmark-hashes")
    if not sizes:
        sizes = [WINDOW]
    met = stored(_document_windows(docs, wanted, sizes, name), "benchmark-met")
    placed = met.join(windows, "hash").select(
        "doc_id", "text_key", "item_id", "n_words", "size", (F.col("start") - F.col("at")).alias("shift"), "at", "slots"
    )
    # One row per alignment of an item with a document; its windows are places of the item, so they are bounded.
    lined_up = stored(
        placed.groupBy("doc_id", "text_key", "item_id", "n_words", "size", "shift").agg(
            F.array_sort(F.collect_set("at")).alias("ats"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots")
        ),
        "benchmark-aligned",
    )
    slotted = stored(_slot_values(lined_up.where(F.size("slots") > 0), docs, benchmark, name), "benchmark-slots")
    same = ["doc_id", "text_key", "item_id", "shift"]
    checked = (
        lined_up.alias("a")
        .join(slotted.alias("s"), reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"s.{k}")) for k in same]), "left")
        .where("coalesce(s.consistent, true)")
        .select("a.*", F.coalesce("s.n_slots", F.lit(0)).alias("n_slots"), F.coalesce("s.n_changed", F.lit(0)).alias("n_changed"))
    )
    together = checked.groupBy("doc_id", "text_key", "item_id", "n_words", "size").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ats")))).alias("ats"),
        F.max("n_slots").cast("long").alias("n_slots"),
        F.max("n_changed").cast("long").alias("n_changed"),
    )
    covered = together.withColumn("n_covered", _covered(F.col("ats"), F.col("size")))
    return covered.where(100 * F.col("n_covered") >= COVERAGE_PERCENT * F.col("n_words")).select(
        "doc_id",
        "text_key",
        "item_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.col("n_covered").cast("long").alias("n_covered"),
        "n_slots",
        "n_changed",
    )


def _slot_values(lined_up: DataFrame, docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """(doc_id, text_key, item_id, shift, consistent, n_slots, n_changed) of alignments that cover placeholders.

    Reads the texts again, of the documents that meet an item with placeholders only.
    """
    who = lined_up.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    texts = texts.join(who, texts["doc_id"].eqNullSafe(who["_doc"]) & (texts["text_key"] == who["_key"]), "left_semi")
    texts = texts.dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), template_words(F.col("text"), name).alias("theirs")
    )
    items = benchmark.select(
        F.col("item_id").alias("_item"),
        template_words(F.col("text"), name).alias("ours"),
        template_only(F.col("text"), name).alias("plain"),
    )
    items = items.dropDuplicates(["_item", "plain"]).withColumn("_n", F.size("plain"))
    both = lined_up.join(
        texts, lined_up["doc_id"].eqNullSafe(texts["_doc"]) & (lined_up["text_key"] == texts["_key"])
    ).join(items, (F.col("item_id") == F.col("_item")) & (F.col("n_words") == F.col("_n")))
    value = lambda words, i: F.substring_index(F.get(words, i), _SPLIT, -1)
    pairs = F.transform(
        "slots", lambda i: F.struct(value(F.col("ours"), i).alias("b"), value(F.col("theirs"), i + F.col("shift")).alias("d"))
    )
    listed = both.select("doc_id", "text_key", "item_id", "shift", pairs.alias("pairs"))
    kinds = F.size(F.array_distinct("pairs"))
    ours = F.size(F.array_distinct(F.transform("pairs", lambda p: p["b"])))
    return listed.select(
        "doc_id",
        "text_key",
        "item_id",
        "shift",
        (kinds == ours).alias("consistent"),
        F.size("pairs").alias("n_slots"),
        F.size(F.filter("pairs", lambda p: ~p["b"].eqNullSafe(p["d"]))).alias("n_changed"),
    ).groupBy("doc_id", "text_key", "item_id", "shift").agg(
        F.max("consistent").alias("consistent"), F.max("n_slots").alias("n_slots"), F.max("n_changed").alias("n_changed")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows in which an item of ``MIN_REMOVED`` words or more was found.

    All columns stay as they are, whatever their names; rows with NULL or empty texts
    and repeated rows stay. A document goes by its id and text together.
    """
    key, doc, tk = fresh(docs.columns, "_key", "_doc", "_tk")
    found = leaks(docs, benchmark).where(F.col("n_words") >= MIN_REMOVED).select(F.col("doc_id").alias(doc), F.col("text_key").alias(tk)).distinct()
    found = stored(found, "leaked")
    keyed = docs.withColumn(key, text_key(F.col("text")))
    return keyed.join(found, keyed["doc_id"].eqNullSafe(found[doc]) & (keyed[key] == found[tk]), "left_anti").drop(key)
