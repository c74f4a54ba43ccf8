"""Classes of near copies against brute force over all pairs."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from polfin.llm import op9_near_copies as near
from polfin.llm import op9_simhash
from tests.llm.tables import awkward, frame, with_clashes, words


def edited(rng: random.Random, base: list[str], edits: int) -> str:
    out = list(base)
    for at in rng.sample(range(len(out)), edits):
        out[at] = "edit" + str(rng.randrange(10**6))
    return " ".join(out)


def corpus() -> list[tuple]:
    """Unrelated texts, families around a base at several similarities, chains, reordered words, exact copies."""
    rng = random.Random(21)
    rows = awkward()
    for family in range(12):
        base = words(rng, rng.choice([40, 120, 300]), "f").split()
        for i in range(10):
            rows.append((1000 + 20 * family + i, edited(rng, base, rng.randint(0, 1 + len(base) // 30)), "en", "a", 1))
        rows.append((1000 + 20 * family + 15, " ".join(base[20:] + base[:20]), "en", "a", 1))
        rows.append((1000 + 20 * family + 16, " ".join(sorted(base)), "en", "a", 1))
    chain = words(rng, 200, "c").split()
    for i in range(25):
        chain[rng.randrange(len(chain))] = f"step{i}"
        rows.append((3000 + i, " ".join(chain), "en", "b", 1))
    return rows


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 1.0


def brute(texts: list[str], only_candidates: bool) -> dict[str, str]:
    """The smallest text of each class, by normalised text."""
    sets = {t: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.split()) else set() for t in texts}
    prints = {t: [near.word_simhash(t.encode().split(), s) for s in near.SEEDS] for t in texts}
    root = {t: t for t in texts}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            close = any((x ^ y).bit_count() <= near.MAX_BITS for x, y in zip(prints[a], prints[b]))
            if (close or not only_candidates) and similarity(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {t: find(t) for t in texts}


def plain(text: str | None) -> str:
    return b" ".join((text or "").encode().lower().split()).decode()


@pytest.mark.parametrize("bucket", [op9_simhash.BUCKET, 3])
def test_classes(spark, monkeypatch, bucket):
    monkeypatch.setattr(op9_simhash, "BUCKET", bucket)
    rows = corpus()
    got = near.copy_classes(with_clashes(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = brute(sorted({plain(r[1]) for r in rows}), only_candidates=True)
    by_id = defaultdict(set)
    for r in got:
        by_id[r.root].add(r.doc_id)
    expected = defaultdict(set)
    for r in rows:
        expected[want[plain(r[1])]].add(r[0])
    assert sorted(map(str, map(sorted, ([str(i) for i in s] for s in by_id.values())))) == sorted(
        map(str, map(sorted, ([str(i) for i in s] for s in expected.values())))
    )


def test_recall_of_similar_texts():
    """Of pairs at a similarity of 0.8 or more, 0.9 at least are candidates."""
    rng = random.Random(5)
    found = total = 0
    for _ in range(400):
        base = words(rng, rng.choice([60, 150, 400]), "r").split()
        a, b = base, edited(rng, base, rng.randint(1, max(1, len(base) // 40))).split()
        sa, sb = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
        if similarity(sa, sb) < 0.8:
            continue
        total += 1
        pa, pb = ([near.word_simhash([x.encode() for x in w], s) for s in near.SEEDS] for w in (a, b))
        found += any((x ^ y).bit_count() <= near.MAX_BITS for x, y in zip(pa, pb))
    assert total > 200 and found >= 0.9 * total


def test_a_word_in_common_is_no_copy(spark):
    """Texts of the same words in another order have equal fingerprints and stay apart."""
    rng = random.Random(6)
    base = words(rng, 80).split()
    rows = []
    for i in range(30):
        rng.shuffle(base)
        rows.append((i, " ".join(base), "en", "a", 1))
    assert near.keep_one(frame(spark, rows)).count() == 30


def test_keep_one(spark):
    """Without ids, repeated, empty and NULL texts each class keeps one row."""
    rng = random.Random(9)
    rows = awkward() + [(None, words(rng, 50), "en", "a", 1)] * 2
    want = brute(sorted({plain(r[1]) for r in rows}), only_candidates=True)
    kept = near.keep_one(with_clashes(frame(spark, rows)))
    assert kept.columns == with_clashes(frame(spark, [])).columns
    assert len(kept.collect()) == len(set(want.values()))
    assert near.keep_one(frame(spark, [])).collect() == []
