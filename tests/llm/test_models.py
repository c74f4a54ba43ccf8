"""Operators 11 to 13: quality of bags of passages, clustering, divergence of sources."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from polfin.llm import op11_quality_mil as op11
from polfin.llm import op12_vafile as op12
from polfin.llm import op13_divergence as op13
from tests.llm.tables import awkward, frame, with_clashes, words

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def marked():
    """Texts that are bad where one passage is full of symbols, wherever it stands."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(500):
        parts = [words(rng, rng.randint(20, 120)) for _ in range(rng.randint(1, 4))]
        bad = rng.random() < 0.4
        if bad:
            parts.insert(rng.randrange(len(parts) + 1), " ".join(rng.choice(["$$$", "###", "&&&"]) + w for w in words(rng, 90).split()))
        rows.append((i, "\n".join(parts), "en", "s", 1))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_quality_of_held_out_documents(spark, marked):
    rows, labels = marked
    more = [(900, None, None, None, 0), (901, "", "en", "s", 0), (None, rows[0][1], None, None, 0), (902, words(random.Random(1), 60_000), "en", "s", 1), (rows[3][0], rows[3][1], "x", "y", 1)]
    said = [*labels, (None, 1, 1), (7000, None, None), (7001, 5, 0), (labels[0][0], 1 - labels[0][1], 0), labels[1]]
    docs, marks = with_clashes(frame(spark, rows + more)), spark.createDataFrame(said, LABELS).withColumn("text", F.lit("x"))
    got = op11.qualities(docs, marks).collect()
    assert len(got) == len(rows + more)
    truth = {i: q for i, q, _ in labels}
    test = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(test) > 100 and sum(r.predicted == truth[r.doc_id] for r in test) >= 0.95 * len(test)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[900].score == by[901].score and by[902].predicted == 1
    # Neither other columns nor labels of held-out documents are looked at.
    other = frame(spark, [(r[0], r[1], "zz", "zz", 5) for r in rows])
    flipped = spark.createDataFrame([(i, 1 - q if op11_held_out(i) else q, 1) for i, q, _ in labels], LABELS)
    one, two = op11.qualities(frame(spark, rows), spark.createDataFrame(labels, LABELS)), op11.qualities(other, flipped)
    assert sorted(one.collect()) == sorted(two.collect())


def op11_held_out(doc_id: int) -> bool:
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality_without_labels_or_rows(spark, marked):
    rows, _ = marked
    docs = frame(spark, rows[:5])
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in op11.qualities(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(5)], LABELS)
    assert {r.predicted for r in op11.qualities(docs, ones).collect()} == {1}
    assert op11.qualities(frame(spark, []), ones).collect() == []


def test_quality_gradient_and_parts(monkeypatch):
    rng = np.random.default_rng(3)
    texts = ["ab cd " * 300, "", "X1 y" * 50, "### " * 200 + "ok " * 500]
    bags = [op11.encode(op11.passages(t)) for t in texts]
    features = np.concatenate(bags).astype(np.float64)
    bag = np.repeat(np.arange(4), [len(b) for b in bags])
    model = op11._new_model(features)
    model.weights = {n: rng.normal(size=w.shape) * 0.3 for n, w in model.weights.items()}
    y, weight = np.array([1.0, 0, 1, 0]), np.array([0.1, 0.2, 0.3, 0.4])
    _, gradient = op11.loss_and_gradient(model, features, bag, y, weight)
    for n, w in model.weights.items():
        at = tuple(rng.integers(0, s) for s in w.shape)
        keep = w[at]
        w[at] = keep + 1e-5
        above = op11.loss_and_gradient(model, features, bag, y, weight)[0]
        w[at] = keep - 1e-5
        below = op11.loss_and_gradient(model, features, bag, y, weight)[0]
        w[at] = keep
        assert abs((above - below) / 2e-5 - gradient[n][at]) < 1e-4, n
    # Part by part as at once, and by the plain formula.
    whole = op11.predict(model, texts)
    monkeypatch.setattr(op11, "_PASSAGES_AT_ONCE", 2)
    assert np.allclose(op11.predict(model, texts), whole, atol=1e-6)
    for t, p in zip(texts, whole):
        h = model.encoded(op11.encode(op11.passages(t)))
        e = model.attention(h)[0]
        a = np.exp(e - e.max())
        want = 1 / (1 + np.exp(-((a / a.sum()) @ h @ model.weights["out"] + model.weights["out_0"][0])))
        assert abs(want - p) < 1e-5


def lloyd(rows, k: int, rounds: int, d: int):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    for r in range(rounds + 1):
        near = [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
        if r < rounds:
            for c in range(len(centroids)):
                own = [v for (_, v), n in zip(kept, near) if n == c]
                centroids[c] = [sum(x) // len(own) for x in zip(*own)] if own else centroids[c]
    inertia = [sum(far(v, centroids[c]) for (_, v), n in zip(kept, near) if n == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, far(v, centroids[n]), inertia[n], sum(inertia), sha[n]) for (i, v), n in zip(kept, near)]


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_clusters_against_plain_lloyd(spark, bits):
    rng = np.random.default_rng(bits)
    centers = rng.normal(size=(6, 8))
    rows = [(i, (centers[i % 6] + rng.normal(size=8) * 0.3).tolist()) for i in range(300)]
    rows += [(301, None), (302, [1.0] * 7), (303, [1.0] * 7 + [float("nan")]), (304, [1.0] * 7 + [float("inf")]), (305, [1.0] * 7 + [None])]
    rows += [rows[3], rows[3], (None, rows[5][1]), (None, rows[6][1]), (306, [0.0] * 8), (307, [9e4] * 8)]
    table = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = op12.cluster(table, k=9, rounds=3, dimensions=8, bits=bits)
    assert sorted(map(str, map(tuple, op12.assignments(found).collect()))) == sorted(map(str, lloyd(rows, 9, 3, 8)))
    assert all(n == 306 and fetched <= n for n, fetched in found.work)
    if bits == 6:
        assert found.work[-1][1] < 306  # some are settled by their cells alone


def test_clusters_of_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert op12.assignments(op12.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema))).collect() == []
    few = op12.assignments(op12.cluster(spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, [-1e30] * 64)], schema))).collect()
    assert sorted(r.cluster for r in few if r.vec_id < 3)[0] == sorted(r.cluster for r in few if r.vec_id < 3)[1]
    assert len(few) == 3 and all(r.distance == 0 for r in few)


def apart(rows, min_docs: int, top: int):
    """Divergence by dense loops over Python numbers."""
    def terms(t):
        return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
    groups, df = {}, {}
    for _, text, lang, source, _ in rows:
        found = terms(text)
        groups.setdefault((lang or "", source or ""), Counter()).update(found)
        df.setdefault(lang or "", Counter()).update(set(found))
    out = []
    for lang in df:
        kept = [t for t in df[lang] if df[lang][t] >= min_docs]
        def priced(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}
        own = {s: n for (g, s), n in groups.items() if g == lang}
        p = {s: priced(n) for s, n in own.items()}
        q = priced(sum(own.values(), Counter()))
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            up = [(t, p[s][t] - q[t]) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", up, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(order)]
    return out


def test_divergence_against_dense_loops(spark, monkeypatch):
    monkeypatch.setattr(op13, "CHUNK_TERMS", 16)
    monkeypatch.setattr(op13, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(op13, "HELD_TERMS", 50)
    monkeypatch.setattr(op13, "SLICE_BYTES", 512)
    rng = random.Random(8)
    vocabulary = [words(rng, 1) + str(i % 3) + words(rng, 1) for i in range(120)] + ["É", "é", "Zoo", "zoo", "a\x00b", "_x_"]
    rows = awkward()
    for i in range(260):
        lang, source = rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", "s4", "s5", "s6", None, "é"])
        rows.append((1000 + i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))), lang, source, 1))
    rows += [(2000, "solo", "xx", "one", 1), (2001, None, "xx", "two", 1), (2002, "solo", "xx", "one", 1)]
    got = op13.divergence(with_clashes(frame(spark, rows)), min_docs=5, top_terms=7)
    want = apart(rows, 5, 7)
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(r[2] == "term" for r in want)
    assert op13.divergence(frame(spark, [])).collect() == []


def test_gallop_and_prices():
    rng = np.random.default_rng(2)
    for n, m in ((0, 5), (5, 0), (3, 4000), (700, 900), (1, 1)):
        few, many = np.unique(rng.integers(0, 5000, n)), np.unique(rng.integers(0, 5000, m))
        assert (op13.gallop(few, many) == np.searchsorted(many, few)).all()
    big = np.array([0, 7, 10**12, 10**15])
    assert op13.prices(big, 2 * 10**15, 10**6).tolist() == [1 + 10**9 * (int(n) + 5) // (2 * 10**15 + 5 * 10**6) for n in big]
