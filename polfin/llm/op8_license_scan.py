"""Licence scan by an exact set-similarity join.

Blocks are the lines of a text, as sets of words; templates are licence notices, as
sets of words too. A block matches when it contains at least ``THRESHOLD`` of a
template's words. Words of templates are ordered by the number of blocks of the whole
corpus that hold them, rarest first. For an overlap of a of t template words, the
rarest common word must be among the first t - a + 1 of the template and, of the c
template words in the block, among the first c - a + 1 (prefix filter); c must reach a
(length filter); and from the common word on, both must have enough words left
(positional filter). Blocks and templates meet by an equality join on such words, and
what meets is verified. No pair above the threshold is missed.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polfin.llm.common import stored, text_key

THRESHOLD_PERCENT = 80
# ASCII letters (lower-cased before) and digits, and everything beyond ASCII.
WORD8 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str

    @property
    def words(self) -> list[str]:
        return sorted(set(self.text.split()))

    @property
    def needed(self) -> int:
        return -(-len(self.words) * THRESHOLD_PERCENT // 100)


# The wording of public licence notices, lower-cased, without punctuation.
TEMPLATES = (
    Template("mit-line", "mit", "released under the mit license"),
    Template("mit-grant", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("apache-line", "apache", "licensed under the apache license version 2 0"),
    Template("apache-notice", "apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("gpl-line", "gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl-notice", "gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("bsd-notice", "bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-line", "cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-short", "cc", "licensed under cc by 4 0"),
    Template("cc-by-nc-short", "cc", "licensed under cc by nc 4 0"),
)

# Fixed values of the task: phrase and label.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))


def _lowered(text: Column) -> Column:
    """Lower case. Only ASCII letters can make a word equal to one that is looked for, except the
    Kelvin sign, whose lower case is a plain k; it is put out of the way."""
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u00e9")))


def tokenized(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """(doc_id, text_key, n_words, words, blocks), one row per row; every text is cut into words once.

    ``words`` are all words of texts that hold the word shared by all phrases, else NULL.
    ``blocks`` lists lines with words of the vocabulary: number of the line, distinct words.
    """
    body = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), _lowered(F.col("text")).alias("body"))
    cut = body.select(
        "doc_id", "text_key", "body", F.transform(F.split("body", "\n", -1), lambda x: F.regexp_extract_all(x, F.lit(WORD8), 0)).alias("lines")
    )
    maybe = F.lit(True)
    for word in sorted(set.intersection(*(set(p) for p, _ in PHRASES))):
        maybe = maybe & F.col("body").contains(word)
    known = lambda line: F.array_distinct(F.filter(line, lambda w: w.isin(list(vocabulary))))
    blocks = F.transform("lines", lambda line, i: F.struct(i.alias("block"), known(line).alias("words")))
    return cut.select(
        "doc_id",
        "text_key",
        F.aggregate("lines", F.lit(0).cast("long"), lambda n, line: n + F.size(line)).alias("n_words"),
        F.when(maybe, F.flatten("lines")).alias("words"),
        F.filter(blocks, lambda x: F.size(x["words"]) > 0).alias("blocks"),
    )


def phrase_places(cut: DataFrame) -> DataFrame:
    """``cut`` with n_base, first_word, last_word and base_labels (an array) in place of ``words``."""
    w = F.col("words")

    def stands(phrase: Sequence[str]) -> Column:
        def at(word: Column, i: Column) -> Column:
            hit = word == phrase[0]
            for k, p in enumerate(phrase[1:], 1):
                hit = hit & (F.get(w, i + k) == p)
            return F.when(F.coalesce(hit, F.lit(False)), i)

        return F.array_compact(F.transform(w, at))

    found = cut.select("*", *[stands(p).alias(f"at{i}") for i, (p, _) in enumerate(PHRASES)])
    places = F.coalesce(F.concat(*[F.col(f"at{i}") for i in range(len(PHRASES))]), F.array().cast("array<int>"))
    labels = F.array_compact(F.array(*[F.when(F.size(f"at{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]))
    return found.withColumn("places", places).select(
        "doc_id",
        "text_key",
        "n_words",
        "blocks",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        labels.alias("base_labels"),
    )


def vocabulary_of(templates: Sequence[Template]) -> list[str]:
    return sorted({w for t in templates for w in t.words})


def license_blocks(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """(doc_id, text_key, block, template, label, overlap, containment): every line that holds
    ``THRESHOLD_PERCENT`` of a template's distinct words, once per template.

    ``templates`` is a list kept by hand; their words are the only ones that are looked
    at. Lines of any length count; a NULL text is one empty line.
    """
    return _matches(stored(tokenized(docs, vocabulary_of(templates)).drop("words"), "license-words"), templates)


def _matches(cut: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """Matching blocks of a stored table with a ``blocks`` column."""
    spark = cut.sparkSession
    vocabulary = vocabulary_of(templates)
    blocks = cut.select("doc_id", "text_key", F.explode("blocks").alias("b")).select("doc_id", "text_key", "b.*")
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    often = {r.word: r.n for r in counts.collect()}  # one row per template word
    order = sorted(vocabulary, key=lambda w: (often.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    index = []
    for number, t in enumerate(templates):
        ranks = sorted(rank[w] for w in t.words)
        for q, r in enumerate(ranks[: len(ranks) - t.needed + 1], 1):
            index.append((r, number, t.name, t.label, q, len(ranks), t.needed, ranks))
    prefixes = spark.createDataFrame(
        index, "rank int, number int, template string, label string, q int, t int, needed int, ranks array<int>"
    )

    ranks_of = F.create_map(*[x for w in order for x in (F.lit(w), F.lit(rank[w]))])
    least = min(t.needed for t in templates)
    ranked = (
        blocks.where(F.size("words") >= least)
        .withColumn("mine", F.array_sort(F.transform("words", lambda w: F.element_at(ranks_of, w))))
        .withColumn("c", F.size("mine"))
    )
    probes = ranked.select(
        "doc_id", "text_key", "block", "mine", "c", F.posexplode(F.slice("mine", F.lit(1), F.col("c") - least + 1)).alias("p0", "rank")
    ).withColumn("p", F.col("p0") + 1)
    meet = (
        probes.join(F.broadcast(prefixes), "rank")  # as many rows as template words
        .where("c >= needed AND p <= c - needed + 1 AND least(t - q, c - p) + 1 >= needed")
        .withColumn("overlap", F.size(F.array_intersect("mine", "ranks")))
        .where("overlap >= needed")
    )
    return meet.select(
        "doc_id", "text_key", "block", "template", "label", "overlap", (F.col("overlap") / F.col("t")).alias("containment")
    ).distinct()


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: phrase places, labels of phrases and templates, score.

    ``labels`` are those of phrases and of matching blocks, distinct and sorted. ``score``
    is 1 where a phrase stands, else the best containment reached, else 0. A NULL or
    empty text has no words, no labels, score 0. Rows that repeat doc_id and text each
    get the same result. Further columns are ignored.
    """
    base = stored(phrase_places(tokenized(docs, vocabulary_of(templates))), "license-words")
    per_doc = (
        _matches(base, templates)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
        .toDF("_doc", "_key", "more", "best")
    )
    joined = base.join(per_doc, base["doc_id"].eqNullSafe(per_doc["_doc"]) & (base["text_key"] == per_doc["_key"]), "left")
    none = F.array().cast("array<string>")
    return joined.select(
        "doc_id",
        "text_key",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort("base_labels").alias("base_labels"),
        F.array_sort(F.array_union("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
