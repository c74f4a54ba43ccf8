"""Operator 1: run-length index and removal of long repeats, against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from polfin.llm import op1_suffix_dedup as op1
from polfin.llm.run_index import RunIndex
from tests.llm.tables import awkward, frame, with_clashes


def brute(rows) -> set:
    """Documents by (id, text), each once for judging; a result per row."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from polfin.llm.common import text_key

    spark = SparkSession.getActiveSession()
    keyed = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(rows)], "i long, doc_id long, text string")
    keys = {r.i: r.k for r in keyed.select("i", text_key(F.col("text")).alias("k")).collect()}
    order = sorted({(r[0] is not None, r[0] or 0, keys[i], r[1] or "") for i, r in enumerate(rows)})
    seen, results = set(), {}
    for known, doc, key, text in order:
        b = text.encode()
        mask = bytearray(len(b))
        for s in range(len(b) - op1.LENGTH + 1):
            piece = b[s : s + op1.LENGTH]
            if piece in seen:
                mask[s : s + op1.LENGTH] = b"\1" * op1.LENGTH
            seen.add(piece)
        kept = bytes(c for c, m in zip(b, mask) if not m)
        spans = sum(1 for j, m in enumerate(mask) if m and (j == 0 or not mask[j - 1]))
        results[(known, doc, key)] = (len(b), sum(mask), spans, hashlib.sha256(kept).hexdigest())
    return sorted(str((r[0], *results[(r[0] is not None, r[0] or 0, keys[i])])) for i, r in enumerate(rows))


def texts_without_inner_repeats(length: int):
    def ok(t: bytes) -> bool:
        pieces = [t[i : i + length] for i in range(len(t) - length + 1)]
        return len(set(pieces)) == len(pieces)

    return st.lists(st.binary(max_size=14).map(lambda b: bytes(x % 4 for x in b)).filter(ok), min_size=1, max_size=7)


@pytest.mark.parametrize("length", [3, 4, 5, 8])
def test_index_marks_what_earlier_texts_hold(length):
    @settings(max_examples=60, deadline=None)
    @given(texts_without_inner_repeats(length))
    def check(texts):
        index = RunIndex(texts, length)
        seen: set[bytes] = set()
        for text, got in zip(texts, index.repeated()):
            pieces = [text[i : i + length] for i in range(len(text) - length + 1)]
            assert got.tolist() == [i for i, p in enumerate(pieces) if p in seen]
            seen |= set(pieces)
        assert sorted(index.locate(np.arange(index.rows)).tolist()) == list(range(index.rows))

    check()


def test_index_is_run_compressed():
    text = bytes(random.Random(1).choices(range(97, 123), k=300))
    texts = [text[:i] + b"#" + text[i + 1 :] for i in range(0, 300, 10)]
    index = RunIndex(texts, 100)
    assert len(index.heads) < index.rows / 4


@pytest.mark.parametrize("limit", [op1.INDEX_STRETCHES, 1])
def test_awkward_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(op1, "INDEX_STRETCHES", limit)
    rows = awkward() + [(200, "a" * 1000, None, None, 1), (201, "-" * 150 + "a" * 400, None, None, 1), (202, "ab" * 300, None, None, 1)]
    got = op1.summary(with_clashes(frame(spark, rows))).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


@pytest.mark.parametrize("limit", [op1.INDEX_STRETCHES, 3])
def test_many_variants_of_one_text(spark, monkeypatch, limit):
    monkeypatch.setattr(op1, "INDEX_STRETCHES", limit)
    monkeypatch.setattr(op1, "INDEX_BYTES", 2000)
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefgh \u00e9\U0001f600", k=400))
    rows = []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = rng.choice("xyz\0")
        rows.append((i * 7 % 60, "".join(t), "en", "a", 1))
    got = op1.summary(frame(spark, rows).repartition(5)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_parts_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(op1, "_AT_ONCE", 700)
    rng = random.Random(5)
    block = "".join(rng.choices("abcdefgh ", k=350))
    rows = [(1, block + "".join(rng.choices("mnop", k=900)) + block, "en", "a", 1), (2, "x" + block[100:] + "y", "en", "a", 1)]
    got = op1.summary(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows)


def test_kept_bytes_and_empty_table(spark):
    assert op1.summary(frame(spark, [])).collect() == []
    rows = [(1, "k" + "abcdefghij" * 2 + "0123456789" * 9, "en", "a", 1), (2, "abcdefghij" * 2 + "0123456789" * 9 + "tail", "en", "a", 1)]
    docs = frame(spark, rows)
    marked = op1.with_runs(docs, op1.repeats(docs))
    assert {r.doc_id: bytes(r.k) for r in marked.select("doc_id", op1.kept(marked.text, marked.runs).alias("k")).collect()} == {
        1: rows[0][1].encode(),
        2: b"tail",
    }
