"""Operators 5, 6, 7, 9 and 10, and the pipeline: what depends on other rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from polfin.llm import op5_mixing as op5
from polfin.llm import op6_sharding as op6
from polfin.llm import op7_line_dedup as op7
from polfin.llm import op9_simhash as op9
from polfin.llm import op10_decontaminate as op10
from polfin.llm.components import components
from tests.llm.tables import awkward, frame, with_clashes, words
from tests.llm.test_near_copies import brute, plain

WORD = re.compile(r"[^ \t\n\x0b\f\r]+")


def filled(sizes: list[int], weights=(3, 1, 2)) -> list[float]:
    """Targets by sharing and resharing, source by source."""
    weight = [weights[i % 3] for i in range(len(sizes))]
    target, left, open_ = [0.0] * len(sizes), 1.5 * sum(sizes), set(range(len(sizes)))
    while open_ and left > 1e-9:
        share = left / sum(weight[i] for i in open_)
        full = [i for i in open_ if target[i] + share * weight[i] >= 2 * sizes[i] - 1e-9]
        if not full:
            for i in open_:
                target[i] += share * weight[i]
            break
        for i in full:
            left -= 2 * sizes[i] - target[i]
            target[i] = 2.0 * sizes[i]
            open_.remove(i)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": rng.choice([0, 1, 5, 40, 300, 5000]) for i in range(rng.randint(1, 9))}
    rows = [(name, size) for name, size in sizes.items()] + [(None, 7)]
    got = {r.source: r.target for r in op5.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    order = sorted(sizes) + [None]
    want = filled([sizes.get(s, 7) for s in order])
    assert [got[s] for s in order] == pytest.approx(want)


def test_mixing(spark):
    rng = random.Random(1)
    rows = awkward() + [(1000 + i, words(rng, 30), "en", "abcd"[i % 4], 1) for i in range(3000)]
    docs = with_clashes(frame(spark, rows))
    plan = op5.repetitions(docs).collect()
    assert len(plan) == len(rows) and plan == op5.repetitions(docs).collect()
    taken, targets = Counter(), {}
    for r in plan:
        assert r.size == len(WORD.findall(r.text or "")) and 0 <= r.copies <= 2
        taken[r.source] += r.size * r.copies
        targets[r.source] = r.target
    assert all(abs(taken[s] - targets[s]) <= 0.15 * targets[s] for s in "abd")
    mixed = op5.mix(frame(spark, rows)).collect()
    assert Counter(r.doc_id for r in mixed) == Counter({d: n for d, n in _sum((r.doc_id, r.copies) for r in plan).items() if n})
    assert op5.mix(frame(spark, [])).collect() == [] and op5.mix(frame(spark, [(1, None, "en", "a", 1)])).collect() == []


def _sum(pairs) -> Counter:
    out = Counter()
    for k, v in pairs:
        out[k] += v
    return out


def test_curve_steps_to_neighbours():
    n = 1 << 3
    cells = np.array([(x, y, z) for x in range(n) for y in range(n) for z in range(n)])
    index = op6.hilbert_index(cells, 3)
    path = cells[np.argsort(index)]
    assert sorted(index) == list(range(n**3)) and (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("shards", [7, 40])
def test_shards(spark, monkeypatch, tmp_path, shards):
    monkeypatch.setattr(op6, "ROWS_PER_PIECE", 10)
    rng = random.Random(1)
    rows = awkward() + [(500 + i, words(rng, rng.randint(0, 40)), rng.choice(["en", "de", None]), rng.choice("abcde"), 1) for i in range(300)]
    got = op6.hilbert_shards(with_clashes(frame(spark, rows)), shards)
    rest = got.collect()
    assert Counter((r.doc_id, r.text) for r in rest) == Counter((r[0], r[1]) for r in rows)
    by = defaultdict(list)
    for r in rest:
        assert r.size == len((r.text or "").encode()) + 16
        by[r.shard].append((r.slot, r.curve))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) == set(range(shards))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())
    along = [c for s in range(shards) for _, c in sorted(by[s])]
    assert along == sorted(along)
    op6.write_shards(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert op6.hilbert_shards(frame(spark, []), shards).collect() == []
    assert len(op6.hilbert_shards(frame(spark, rows[:3]), shards).collect()) == 3


def dedup(rows, min_docs: int, keep_first: bool = False) -> dict:
    docs = {(r[0], r[1]): (r[1] or "").split("\n") for r in rows}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    found = defaultdict(set)
    for d, lines in docs.items():
        for line in lines:
            found[key(line)].add(d)
    often = {k for k, v in found.items() if k and len(v) >= min_docs}
    out, seen = {}, set()
    for d in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        keep = []
        for line in docs[d]:
            k = key(line)
            keep.append(k not in often or (keep_first and k not in seen))
            seen.add(k)
        out[d] = (len(keep), keep.count(False), "\n".join(x for x, k in zip(docs[d], keep) if k))
    return out


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_line_dedup(spark, min_docs, keep_first):
    rng = random.Random(2)
    pool = ["Hot Line", " hot line\t", "", "  ", "b", "É", "é", *(words(rng, 3) for _ in range(12))]
    rows = [r for r in awkward() if r[0] is not None]
    rows += [(400 + i, "\n".join(rng.choices(pool, k=rng.randint(1, 9))), None, None, 1) for i in range(70)] + [(400, "hot line", None, None, 1)] * keep_first * 0
    docs = with_clashes(frame(spark, rows)).repartition(6)
    marked = op7.with_bitmaps(docs, op7.keep_bitmaps(docs, min_docs=min_docs, keep_first=keep_first))
    got = marked.select("doc_id", "text", "lines.n_lines", "lines.n_dropped", op7.kept_text(marked.text, marked.lines).alias("t"), op7.kept_sha256(marked.text, marked.lines).alias("sha")).collect()
    want = dedup(rows, min_docs, keep_first)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_lines, r.n_dropped, r.t) == want[(r.doc_id, r.text)]
        assert r.sha == hashlib.sha256(r.t.encode()).hexdigest()


def test_line_dedup_with_one_hot_line(spark):
    """A key that spans many ranges is settled as a whole; NULL ids and empty tables are fine."""
    rows = [(i, f"hot\nown {i}", None, None, 1) for i in range(600)] + [(None, None, None, None, None), (None, "hot", None, None, 1)]
    docs = frame(spark, rows).repartition(8)
    marked = op7.with_bitmaps(docs, op7.keep_bitmaps(docs)).select("doc_id", "lines.n_dropped", "text").collect()
    assert len(marked) == len(rows) and all(r.n_dropped == (1 if r.text else 0) for r in marked)
    kept = op7.keep_bitmaps(docs, keep_first=True)
    assert sum(r.n_dropped for r in kept.collect()) == 600
    assert op7.keep_bitmaps(frame(spark, [])).collect() == []


def fingerprint(text: str | None) -> int:
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closed(prints: list[int]) -> dict[int, int]:
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("bucket", [op9.BUCKET, 2])
def test_simhash_classes(spark, monkeypatch, bucket):
    monkeypatch.setattr(op9, "BUCKET", bucket)
    rows = awkward()
    rng = random.Random(8)
    base = words(rng, 400).split()
    for i in range(40):
        t = list(base)
        t[rng.randrange(len(t))] = "edit"
        rows.append((600 + i, " ".join(t), "en", "a", 1))
    got = op9.near_duplicates(with_clashes(frame(spark, rows))).collect()
    prints = {r[0:2]: fingerprint(r[1]) for r in rows}
    root = closed(sorted(set(prints.values())))
    least = defaultdict(lambda: None)
    for (doc, _), p in prints.items():
        if doc is not None:
            least[root[p]] = doc if least[root[p]] is None else min(least[root[p]], doc)
    want = sorted(str((d, p, least[root[p]])) for (d, t), p in ((r[0:2], prints[r[0:2]]) for r in rows))
    assert sorted(str((r.doc_id, r.fp & (1 << 64) - 1, r.component_id)) for r in got) == want


def test_links_of_all_distances(spark, monkeypatch):
    """Random and planted fingerprints, dense and sparse, with small and large buckets."""
    rng = random.Random(4)
    prints = {0, (1 << 64) - 1}
    for _ in range(150):
        p = rng.getrandbits(64)
        prints.add(p)
        for d in range(1, 7):
            q = p
            for b in rng.sample(range(64), d):
                q ^= 1 << b
            prints.add(q)
    prints |= {rng.getrandbits(64) & 0xFF for _ in range(100)}
    signed = [(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(sorted(prints))]
    want = closed(sorted(prints))
    for bucket in (op9.BUCKET, 3):
        monkeypatch.setattr(op9, "BUCKET", bucket)
        got = op9.classes(spark.createDataFrame(signed, "fp long, doc_id long")).collect()
        by = defaultdict(set)
        for r in got:
            by[r.component_id].add(r.fp & (1 << 64) - 1)
        classes = defaultdict(set)
        for p, r in want.items():
            classes[r].add(p)
        assert sorted(map(sorted, by.values())) == sorted(map(sorted, classes.values()))


def test_keep_one(spark):
    rows = awkward()
    kept = op9.keep_one(with_clashes(frame(spark, rows)))
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and not ids[2] and not ids[10] and len(kept.columns) > 5 and max(ids.values()) <= 2
    assert op9.keep_one(frame(spark, [])).collect() == []


def test_keep_one_of_rows_without_id(spark):
    """Classes without any doc_id are told apart: each keeps one row."""
    rng = random.Random(12)
    texts = [words(rng, 60) for _ in range(20)]
    rows = [(None, t, "en", "a", 1) for t in texts + texts[:5]] + [(1, words(rng, 60), "en", "a", 1)]
    kept = op9.keep_one(frame(spark, rows)).collect()
    assert sorted(r.text for r in kept) == sorted({r[1] for r in rows})


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(90)] + [(500, 500), (7, 3), (7, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


ITEMS = [
    (1, "If John Smith has 12 apples and gives 5 km to Mary, how many apples does John keep at the end of day 12?"),
    (2, "what is it"),
    (3, "alpha beta gamma delta epsilon zeta"),
    (4, None),
    (5, "the quick brown fox jumps over the lazy dog near the old river bank while the moon is up"),
    (5, "the quick brown fox jumps over the lazy dog near the old river bank while the moon is up"),
    (6, "1 2 3 4 5 6 7 8 9 10 11 12"),
]


def test_decontamination(spark):
    rows = awkward() + [
        (300, "See. If Paul Jones has 99 apples and gives 7 km to Anna, how many apples does Paul keep at the end of day 99? So.", "en", "a", 1),
        (301, "If Paul Jones has 99 apples and gives 7 km to Anna, how many apples does Peter keep at the end of day 98?", "en", "a", 1),
        (302, "x Alpha beta\ngamma delta, epsilon zeta y", "en", "a", 1),
        (303, words(random.Random(1), 4000) + ". The quick brown fox jumps over the lazy dog near the old river bank. End", "en", "a", 1),
        (304, "the quick brown fox jumps over a dog", "en", "a", 1),
        (305, "12 11 10 9 8 7 6 5 4 3 2 1", "en", "a", 1),
        (303, "The quick brown fox jumps over the lazy dog near the old river bank while the moon is up", "en", "a", 1),
        (None, ITEMS[4][1].upper(), "en", "a", 1),
    ]
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = with_clashes(frame(spark, rows))
    got = op10.leaks(docs, bench).collect()
    assert sorted(str((r.doc_id, r.item_id)) for r in got) == sorted(map(str, [(300, 1), (302, 3), (303, 5), (303, 5), (None, 5)]))
    paul = next(r for r in got if r.doc_id == 300)
    assert paul.n_covered == paul.n_words == 24 and (paul.n_slots, paul.n_changed) == (8, 7)
    kept = op10.decontaminate(docs, bench)
    gone = Counter((r[0], r[1]) for r in rows) - Counter((r.doc_id, r.text) for r in kept.collect())
    assert sorted(str(d) for d, _ in gone) == ["300", "302", "303", "303", "None"]
    assert op10.leaks(frame(spark, []), bench).collect() == [] and op10.leaks(docs, bench.limit(0)).collect() == []


def test_names_that_start_sentences(spark):
    item = "Tom has 5 apples. Tom buys 3 more. Tom eats 2. Tom sells 4 apples. Tom keeps 1 apple."
    other = item.replace("Tom", "Eva").replace("5", "8")
    rows = [(1, other, "en", "a", 1), (2, other.replace("Eva buys", "Bob buys").replace("Eva sells", "Jim sells"), "en", "a", 1)]
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert op10.template_leaks(frame(spark, rows), bench).collect() == []
    assert [(r.doc_id, r.item_id) for r in op10.leaks(frame(spark, rows), bench).collect()] == [(1, 1)]


def test_verbatim_leaks(spark):
    """Short items, items of numbers and long passages are found word for word, in any case."""
    long = words(random.Random(21), 150)
    passage = " ".join(long.split()[40:100])
    items = [*ITEMS, (7, long)]
    rows = [
        (1, "Well, What is it? asked a fox", "en", "a", 1),
        (2, "so 1 2 3 4 5 6 7 8 9 10 11 12 go", "en", "a", 1),
        (3, "x " + passage.upper() + " y", "en", "a", 1),
        (4, ITEMS[0][1].lower(), "en", "a", 1),
        (5, "x " + " ".join(long.split()[40:52]) + " y", "en", "a", 1),
        (6, "what is the it", "en", "a", 1),
        (None, None, None, None, None),
    ]
    got = op10.leaks(with_clashes(frame(spark, rows)), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 2), (2, 6), (3, 7), (4, 1)]
    assert {r.doc_id: (r.n_words, r.n_covered) for r in got}[3] == (150, 60)


def test_templates_keep_places(spark):
    texts = ["At 5.5 km, Mr. Brown ran 3,000 m in 12 minutes.", "x1 12a 3% of $5 at 10:30", "\x01\x02\x03 7km É Ü", "Two hundred Days. two Days"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select(op10.template_words(df.text).alias("a"), op10.template_only(df.text).alias("b")).collect():
        assert len(r.a) == len(r.b) and [x.startswith("\x01") for x in r.a] == [x.startswith("\x01") for x in r.b]


def test_pipeline_against_its_parts(spark):
    """Stage by stage over a test table: each stage's result, and what the last returns."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "benchmark", "mixture", "shards"]
    whole = {r.doc_id: r.text for r in docs.collect()}

    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language"](spark, docs, sf_dir).cache()
    assert spoken.columns == names and spoken.count() >= 0.97 * len(whole)

    # The stage takes shingles of five words at a similarity of 0.8, not the 4 bits of query op9.
    spoken_texts = {r.doc_id: plain(r.text) for r in spoken.collect()}
    root = brute(sorted(set(spoken_texts.values())), only_candidates=True)
    first = {}
    for d in sorted(spoken_texts):
        first.setdefault(root[spoken_texts[d]], d)
    single = stages["near_duplicates"](spark, spoken, sf_dir).cache()
    assert single.columns == names and sorted(r.doc_id for r in single.collect()) == sorted(first.values())

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    flat = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    clean = stages["benchmark"](spark, single, sf_dir).cache()
    gone = {r.doc_id for r in single.collect()} - {r.doc_id for r in clean.collect()}
    assert clean.columns == names and gone == {d for d in first.values() if any(flat(i) in flat(whole[d]) for i in items)}

    mixed = stages["mixture"](spark, clean, sf_dir).cache()
    n = Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == names and set(n) <= {r.doc_id for r in clean.collect()} and max(n.values()) <= 2
    sharded = stages["shards"](spark, mixed, sf_dir)
    assert Counter(r.doc_id for r in sharded.collect()) == n
    assert Counter((r.doc_id, r.shard, r.slot) for r in corpus_pipeline.run(spark, sf_dir).collect()) == Counter(
        (r.doc_id, r.shard, r.slot) for r in sharded.collect()
    )


def test_pipeline_of_awkward_rows(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 10
    frame(spark, []).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
