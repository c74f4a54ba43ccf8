"""Operator 10: anchors lose nothing, runs against brute force, re-parameterised items are found."""

from __future__ import annotations

import random
import re

from polfin.llm import components
from polfin.llm import op10_decontaminate as op10
from tests.llm.tables import frame

ITEMS = "item_id long, text string"
VERBS = "buys sells carries paints counts measures borrows collects finds loses".split()
THINGS = "apples bricks lamps kites boxes ropes coins shells bottles wheels".split()
ENDINGS = ["How many are left in the old shed?", "What is the total after that day?", "How long does the whole trip take then?", "Which of the two had more at the end?"]
NAMES = "Tom Anna Peter Marie Lukas Zoë Omar Ines Ravi Ute".split()


def question(rng: random.Random, shape: int, names, numbers) -> str:
    shaped = random.Random(shape)
    verb, other, thing, ending = shaped.choice(VERBS), shaped.choice(VERBS), shaped.choice(THINGS), shaped.choice(ENDINGS)
    filler = [" ".join(shaped.choice(THINGS + VERBS + ["with", "under", "from", "the", "a"]) for _ in range(8)) for _ in range(2)]
    a, b = names
    x, y = numbers
    return f"{a} {verb} {x} {thing} near the {filler[0]} while {b} {other} {y} km of {filler[1]} and gives {x} to {a}. {ending}"


def test_reparameterised_items_are_found(spark):
    rng = random.Random(12)
    items = [(i, question(rng, i, ("Tom", "Anna"), (5, 12))) for i in range(60)]
    copies = [(i, question(rng, i, rng.sample(NAMES[2:], 2), rng.sample(range(20, 99), 2)), "en", "s", 1) for i in range(60)]
    others = [(1000 + i, question(rng, 5000 + i, rng.sample(NAMES, 2), rng.sample(range(9), 2)), "en", "s", 1) for i in range(60)]
    bench = spark.createDataFrame(items, ITEMS)
    found = {(r.doc_id, r.item_id) for r in op10.leaks(frame(spark, copies + others), bench).where("n_words > 20").collect()}
    assert sum((i, i) in found for i in range(60)) >= 54
    assert sum(d >= 1000 for d, _ in found) <= 3  # questions of another shape share at most an ending


def words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def test_runs_and_anchors_against_brute_force(spark, monkeypatch):
    """All documents against all items, without anchors; word-for-word runs by plain loops."""
    rng = random.Random(4)
    vocabulary = "a the of 7 12 km Two red Bob Ann stone river Été 3.5 x1y 1b O'Neil % five".split()
    phrase = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, phrase(rng.choice([1, 2, 4, 5, 6, 8, 9, 14, 20]))) for i in range(30)] + [(30, None), (31, ""), (32, "7 12 3.5 7 12")]
    rows = [(i, phrase(rng.randint(0, 40)), "en", "s", 1) for i in range(60)]
    for i in range(60, 90):
        text = phrase(6) + ". " + (items[i % 30][1] or "").swapcase() + ", " + phrase(5)
        rows.append((i, text, "en", "s", 1))
    bench, docs = spark.createDataFrame(items, ITEMS), frame(spark, rows)
    got = sorted(map(tuple, op10.leaks(docs, bench).collect()))
    monkeypatch.setattr(op10, "LITERAL_ANCHORS", 3)
    assert got == sorted(map(tuple, op10.leaks(docs, bench).collect()))
    runs = {(r.doc_id, r.item_id, r.n_covered) for r in op10.verbatim(docs, op10.verbatim_windows(bench)).collect()}
    want = set()
    for d, text, *_ in rows:
        theirs = words(text)
        for item, own in items:
            ours = words(own or "")
            size = min(len(ours), op10.RUN)
            there = {tuple(theirs[k : k + size]) for k in range(len(theirs) - size + 1)} if size else set()
            covered = {j for k in range(len(ours) - size + 1) if tuple(ours[k : k + size]) in there for j in range(k, k + size)}
            if covered:
                want.add((d, item, len(covered)))
    assert runs == want and len(want) > 30
    monkeypatch.setattr(op10, "_suspects", lambda docs, windows: docs.select("doc_id", "text"))
    assert got == sorted(map(tuple, op10.leaks(docs, bench).collect()))
    kept = {r.doc_id for r in op10.decontaminate(docs, bench).collect()}
    assert {d for d, *_ in rows} - kept == {r[0] for r in got if r[3] >= op10.MIN_REMOVED}


def leaves(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_windows_of_all_sizes_come_from_one_scan(spark):
    """Each scan and stage costs the driver memory, and those of a union cost it at once."""
    texts = {1: "one two cat", 2: "a bird met the fox", 3: "Water is warm near the old town", 4: " ".join(f"w{chr(97 + i)}x" for i in range(16)), 5: None, 6: "7 km and 9 km of road go by"}
    bench = spark.createDataFrame([*texts.items(), (4, texts[4])], "item_id long, text string")
    windows, runs = op10.item_windows(bench), op10.verbatim_windows(bench)
    assert (leaves(windows), leaves(runs)) == (1, 1)
    wanted = windows.select("hash").distinct()
    met = op10._document_windows(frame(spark, [(1, texts[4], "en", "a", 1), (2, texts[2], "en", "a", 1)]), wanted, [5, 7, 8], op10._NAME)
    assert leaves(met) == 1 + leaves(wanted)

    found = sorted((r.item_id, r.n_words, r.size, r["at"], len(r.slots)) for r in windows.collect())
    # The first window of an item that starts with a word comes with a name there, too.
    expected = [(2, 5, 5, 0, 0), (2, 5, 5, 0, 0), (3, 7, 7, 0, 0), (3, 7, 7, 0, 0), (4, 16, 8, 0, 0)] + [(4, 16, 8, i, 0) for i in range(9)]
    assert [r for r in found if r[0] != 6] == expected
    assert {r.size for r in windows.where("item_id = 6").collect()} == {8} and windows.select("hash").distinct().count() == windows.count()
    assert sorted((r.item_id, r.size, r["at"]) for r in runs.collect()) == [(1, 3, 0), (2, 5, 0), (3, 7, 0), *((4, 13, i) for i in range(4)), (6, 9, 0)]
    assert sorted((r.doc_id, r.start) for r in met.collect()) == [*((1, i) for i in range(9)), (2, 0)]


def test_rounds_of_components_scan_edges_twice(spark, tmp_path):
    edges = [(2, 1), (3, 1), (3, 2), (5, 3), (9, 5), (9, 8)]
    spark.createDataFrame(edges, "u long, v long").write.parquet(f"{tmp_path}/edges")
    stored = spark.read.parquet(f"{tmp_path}/edges")
    large, small = components._large_star(stored), components._small_star(stored)
    assert (leaves(large), leaves(small)) == (2, 2)
    near = {u: {v for e in edges for v in e if u in e and v != u} for e in edges for u in e}
    assert {tuple(r) for r in large.collect()} == {(v, m) for u in near for m in [min(u, *near[u])] for v in near[u] if v > u and v != m}
    below = {u: {v for x, v in edges if x == u} for u, _ in edges}
    assert sorted(map(tuple, small.collect())) == sorted({(v, m) if v != m else (u, m) for u in below for m in [min(below[u])] for v in below[u]})
