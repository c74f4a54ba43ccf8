"""Operators 2, 3, 4 and 8: judgements of single rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from polfin.llm import op2_quality as op2
from polfin.llm import op3_url_filter as op3
from polfin.llm import op4_language_id as op4
from polfin.llm import op8_license_scan as op8
from polfin.llm.queries import URL_RULES
from tests.llm.tables import awkward, frame, with_clashes, words

BLANKS = " \t\n\x0b\f\r"


def split(text: str) -> list[str]:
    out, word = [], ""
    for c in text + " ":
        if c in BLANKS:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def counts(text: str | None) -> tuple:
    text = text or ""
    w = split(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    covered = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if split(line)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    loop = "we go round and round again and we go round and round again\n"
    rows = [r for r in awkward() if len(r[1] or "") < 3000] + [(300, loop * 2 + "# & x|y <b>\n" + loop, "en", "a", 1), (301, "ä\u00a0b \U0001f600 c", "en", "a", 1)]
    got = op2.judge(with_clashes(frame(spark, rows))).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted(str((r.doc_id, *(r[n] for n in names))) for r in got) == sorted(str((r[0], *counts(r[1]))) for r in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and not r.reasons)


def test_quality_thresholds_follow_language_and_source(spark):
    rng = random.Random(2)
    short = [(i, " ".join("abc"[: rng.randint(1, 3)] + str(rng.randint(0, 9)) for _ in range(50)), "xx", "s", 1) for i in range(80)]
    long = [(100 + i, " ".join("l" * rng.randint(14, 18) + str(rng.randint(0, 99)) for _ in range(50)), "yy", "s", 1) for i in range(80)]
    odd = [(300, long[0][1], "xx", "s", 1), (301, short[0][1] + " ## ## ## ## ## ## ## ##" * 3, "xx", "s", 1)]
    few = [(400, long[1][1], "yy", "rare", 1)]  # takes the bounds of its language
    got = {r.doc_id: r for r in op2.judge(frame(spark, short + long + odd + few)).collect()}
    assert all(got[r[0]].kept for r in short + long + few)
    assert got[300].reasons == ["mean_word"] and "symbols" in got[301].reasons
    kept = op2.keep_good(with_clashes(frame(spark, short + long + odd)))
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in short + long} and len(kept.columns) > 5


def test_quality_sketches_merge(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 40), "en", "ab"[i % 2], 1) for i in range(120)]
    measured = op2.measure(frame(spark, rows))
    whole, parts = op2.sketches(measured), op2.sketches(measured.where("doc_id < 50")).unionByName(op2.sketches(measured.where("doc_id >= 50")))
    merged = parts.groupBy("lang", "source", "measure", "value").agg(F.sum("n").alias("n"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))
    assert op2.judge(frame(spark, [])).collect() == []


def fits(host: str, path: str, rules) -> tuple:
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h) + len(p), len(h), verdict == "block")
            best = max(best, (key, h + p, verdict)) if best else (key, h + p, verdict)
    return (best[1], best[2]) if best else (None, "allow")


def test_url_rules(spark, monkeypatch):
    monkeypatch.setattr(op3, "BORDER_SAMPLE", 16)
    rng = random.Random(1)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", "badexample.org", "net", "b.a.example.org", "com.", "é.com"]
    paths = ["", "/", "/es/", "/es/x", "/en/1", "/en/12", "/fr/q", "/de/", "/d", "/de"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=/es/', '#f'])}" for _ in range(300)]
    urls += [None, "", "nohost", "://", "HTTP://ORG/ES/", "http://org", "http://org/" + "x" * 9000, "http://" + "a." * 2000 + "org/y", "a://b://c/d"]
    rules = [*URL_RULES, ("block", "org", "/"), ("allow", "a.example.org", "/es"), ("block", "net", "")]
    pages = with_clashes(spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string"))
    got = op3.filter_urls(pages, rules).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, *fits(host, path, rules))
    assert op3.filter_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in op3.filter_urls(pages, [], default="block").collect()} == {"block"}


LANGS = {"aa": ["ka", "lo", "mi", "kal", "tor"], "bb": ["zu", "wex", "qua", "ziq", "wu"], "cc": ["pé", "fü", "ñan", "éri", "ßo"]}


def spoken(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(9)
    return [(i, spoken(rng, lang := rng.choice(list(LANGS)), rng.randint(5, 80)), lang, "s", 1) for i in range(400)]


def test_languages_of_held_out_documents(spark, speech):
    rows = speech + [(900, None, "aa", "s", 0), (901, "", "aa", "s", 0), (902, "12 !! 34", "aa", "s", 0), (None, speech[0][1], None, None, 0)]
    rows += [(903, speech[0][1] + " " + " ".join(r[1] for r in speech[:200] if r[2] == speech[0][2]), None, None, 0)]
    got = op4.languages(with_clashes(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    truth = {r[0]: r[2] for r in speech}
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(test) > 50 and sum(r.lang_pred == truth[r.doc_id] for r in test) >= 0.97 * len(test)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (900, 901, 902))
    assert by[903].lang_pred == speech[0][2] and by[None].lang_pred == speech[0][2]
    assert all(0 <= r.score <= 1 for r in got)


def test_language_is_learned_from_text_alone(spark, speech):
    """Labels of held-out documents, and sources, change nothing."""
    docs = frame(spark, speech)
    other = docs.withColumn("lang", F.when(op4.held_out(F.col("doc_id")), F.lit("bb")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    assert sorted(op4.languages(docs).collect()) == sorted(op4.languages(other).collect())


def test_switch_inside_a_text(speech):
    model = op4.fit([r[1] for r in speech], [r[2] for r in speech])
    rng = random.Random(3)
    text = spoken(rng, "aa", 12) + " " + spoken(rng, "bb", 20)
    w = op4.words_of([text])
    p, _, _ = model.marginals(w, model.rows(w))
    labels = [model.labels[i] for i in p.argmax(axis=1)]
    assert labels[:10] == ["aa"] * 10 and labels[-18:] == ["bb"] * 18
    lang, score = op4.predict(model, [text])[0]
    assert lang == "bb" and 0.5 < score < 0.75


def test_marginals_against_all_labelings():
    """Forward-backward equals the sum over every labeling of a short text."""
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    model = op4.fit(["ka lo mi zu", "wex zu qua ka"], ["a", "b"], rounds=2)
    model.change, model.start = rng.normal(size=(2, 2)), rng.normal(size=2)
    w = op4.words_of(["ka wex lo zu mi"])
    e = model.scores(w, model.rows(w))
    p, pairs, first = model.marginals(w, model.rows(w))
    want, both = np.zeros((5, 2)), np.zeros((2, 2))
    for y in itertools.product(range(2), repeat=5):
        s = np.exp(model.start[y[0]] + sum(e[i, y[i]] for i in range(5)) + sum(model.change[y[i], y[i + 1]] for i in range(4)))
        for i in range(5):
            want[i, y[i]] += s
        for i in range(4):
            both[y[i], y[i + 1]] += s
    assert np.allclose(p, want / want.sum(axis=1, keepdims=True), atol=1e-4)
    assert np.allclose(pairs, both / both.sum() * 4, atol=1e-3)
    assert np.allclose(first, p[0], atol=1e-4)


def test_languages_without_labels_or_rows(spark, speech):
    unlabelled = frame(spark, [(r[0], r[1], None, None, 1) for r in speech[:5]])
    assert {r.lang_pred for r in op4.languages(unlabelled).collect()} == {"und"}
    assert op4.languages(frame(spark, [])).collect() == []
    kept = op4.keep_languages(with_clashes(frame(spark, speech + [(900, "12", None, None, 1), (901, None, None, None, 1)])), 0.4)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in speech} and "row" in kept.columns


def test_license_scan(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = awkward() + [
        (300, "x y\n" + gpl + "\n", "en", "a", 1),
        (301, "MIT license, mit LICENSE. apache-license", "en", "a", 1),
        (302, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and documentation", "en", "a", 1),
        (303, "permission is granted", "en", "a", 1),
        (304, "Licensed under CC BY-NC 4.0.", "en", "a", 1),
        (305, "General\npublic license mitlicense mit\u00e9 license", "en", "a", 1),
        (306, words(random.Random(1), 30000) + " redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "en", "a", 1),
    ]
    got = {r.doc_id: r for r in op8.scan(with_clashes(frame(spark, rows))).collect()}
    assert (got[300].n_base, got[300].first_word, got[300].labels, got[300].score) == (1, 9, ["gpl"], 1.0)
    assert (got[301].n_base, got[301].first_word, got[301].last_word, got[301].base_labels) == (3, 0, 4, ["apache", "mit"])
    assert got[302].labels == ["mit"] and 0.8 <= got[302].score < 1 and got[302].n_base == 0
    assert got[303].labels == [] and got[303].score == 0
    assert got[304].labels == ["cc"]
    assert got[305].base_labels == ["gpl"] and got[305].first_word == 0
    assert got[306].labels == ["bsd"]
    assert got[4].n_words == 0 and got[4].first_word is None and len(op8.scan(frame(spark, rows)).collect()) == len(rows)
    assert op8.scan(frame(spark, [])).collect() == []


def test_license_join_misses_nothing(spark):
    """Every line and template, by brute force, with templates that overlap."""
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(14)]
    templates = [op8.Template(f"t{i}", f"l{i}", " ".join(rng.sample(vocabulary, rng.randint(2, 9)))) for i in range(8)]
    rows = [(i, "\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(0, 14))) for _ in range(4)), None, None, 1) for i in range(60)]
    got = {(r.doc_id, r.block, r.template, r.overlap) for r in op8.license_blocks(frame(spark, rows), templates).collect()}
    want = set()
    for i, text, *_ in rows:
        for b, line in enumerate(text.split("\n")):
            for t in templates:
                overlap = len(set(line.split()) & set(t.words))
                if 100 * overlap >= op8.THRESHOLD_PERCENT * len(t.words):
                    want.add((i, b, t.name, overlap))
    assert got == want and len(want) > 20
