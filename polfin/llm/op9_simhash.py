"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within 4 bits, cut into 3 segments: in one segment at least they differ
by a single bit or none. So each fingerprint is indexed under each segment with one
bit masked, 64 variants in all (the masked bit names the segment), and two that link
are equal in one variant. Variants meet by an equality shuffle and are verified.

Equal fingerprints are one entry. Within a bucket only a spanning forest is emitted,
not all pairs. Buckets beyond ``BUCKET`` entries are cut again: what differs by at most
4 bits outside the segment is equal in one of 5 parts there, so the same step runs on
finer keys. No bucket is dropped or capped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import fresh, partitions, stored, text_batches, text_key
from polfin.llm.components import components

SEED = 42
SHINGLE = 4
MAX_BITS = 4
# First bit of each segment, and the end: three segments serve distances up to 5 bits.
SEGMENTS = (0, 21, 42, 64)
BUCKET = 2048
_SHINGLES_AT_ONCE = 1 << 16
_FULL = (1 << 64) - 1


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is in over half the shingle hashes.

    ASCII letters are lower-cased; fewer words than a shingle are one shingle; no words: 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    of = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    hashes = np.fromiter((of(joined[a:b], seed) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        part = hashes[at : at + _SHINGLES_AT_ONCE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    return pd.Series(np.array([simhash(t) for t in text], np.uint64).view(np.int64))


def fingerprint_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _segment(bit: int) -> tuple[int, int]:
    return next((a, b) for a, b in zip(SEGMENTS, SEGMENTS[1:]) if a <= bit < b)


def _variants() -> Column:
    """Bucket numbers of a fingerprint: the segment without the masked bit, and which bit that is."""
    out = []
    for bit in range(64):
        low, high = _segment(bit)
        mask = ((1 << (high - low)) - 1) & ~(1 << (bit - low))
        kept = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit(mask).cast("long"))
        out.append(F.shiftleft(kept, 6).bitwiseOR(F.lit(bit).cast("long")))
    return F.array(*out)


def _rest_bits(bit: int, parts: int) -> list[int]:
    """Masks that cut the bits outside the segment of ``bit`` into ``parts`` parts."""
    low, high = _segment(bit)
    outside = [b for b in range(64) if not low <= b < high]
    return [sum(1 << b for b in part.tolist()) for part in np.array_split(np.array(outside), parts)]


def _close(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_bits


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is connected among distinct ``fps``; one per entry at most.

    Grows each component from its smallest entry; entries already reached are not
    compared again, so a dense bucket is done after few comparisons.
    """
    left, edges = np.sort(fps), []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = _close(left, at, max_bits)
            if near.any():
                reached = left[near]
                edges.append((np.full(len(reached), at), reached))
                todo.extend(reached)
                left = left[~near]
    return edges


def _links(limit: int | None, max_bits: int):
    """(u, v, bucket) from rows (bucket, fp) sorted by both.

    Linked fingerprints have a NULL bucket. Of a bucket beyond ``limit`` entries the
    rows come back instead, v NULL, for the finer step.
    """

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays (bucket, fp) that hold whole buckets; a bucket that goes on waits."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            k, f = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(k):
                continue
            if held and k[-1] == held[-1][0][-1]:
                held.append((k, f))
                continue
            cut = int(np.searchsorted(k, k[-1]))
            yield np.concatenate([*(h[0] for h in held), k[:cut]]), np.concatenate([*(h[1] for h in held), f[:cut]])
            held = [(k[cut:], f[cut:])]
        if held:
            yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, f in groups(batches):
            fps = f.view(np.uint64)
            new = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64)
            sizes = np.diff(np.append(new, len(k)))
            us, vs, big = [], [], []
            pairs = new[sizes == 2]
            linked = pairs[_close(fps[pairs], fps[pairs + 1], max_bits)]
            us.append(fps[linked])
            vs.append(fps[linked + 1])
            for at, m in zip(new[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if limit and m > limit:
                    big.append(slice(at, at + m))
                    continue
                for a, b in _forest(fps[at : at + m], max_bits):
                    us.append(a)
                    vs.append(b)
            u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
            yield _batch(u, v, np.zeros(len(u), np.int64), np.ones(len(u), bool))
            for s in big:
                yield _batch(f[s], np.zeros_like(f[s]), k[s], np.zeros(s.stop - s.start, bool))

    def _batch(u: np.ndarray, v: np.ndarray, bucket: np.ndarray, is_link: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(u), pa.array(v, mask=~is_link), pa.array(bucket, mask=is_link)], names=["u", "v", "bucket"]
        )

    return run


def _finer(max_bits: int):
    """Rows (bucket, fp) of large buckets, once per part of the bits outside the segment, under finer numbers."""
    count = max_bits + 1
    rest = np.array([_rest_bits(b, count) for b in range(64)], np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k, f = b.column(0).to_numpy(), b.column(1).to_numpy()
            parts = f.view(np.uint64)[:, None] & rest[(k & 63).astype(np.int64)]
            mixed = (k.view(np.uint64)[:, None] * np.uint64(count) + np.arange(count, dtype=np.uint64)) * np.uint64(
                0x9E3779B97F4A7C15
            ) ^ (parts * np.uint64(0xC2B2AE3D27D4EB4F))
            yield pa.RecordBatch.from_arrays(
                [pa.array(mixed.ravel().view(np.int64)), pa.array(np.repeat(f, count))], names=["bucket", "fp"]
            )

    return run


_LINK_SCHEMA = "u long, v long, bucket long"


def _meet(rows: DataFrame, limit: int | None, max_bits: int, label: str) -> DataFrame:
    return stored(
        rows.repartition(partitions(rows.sparkSession), "bucket")
        .sortWithinPartitions("bucket", "fp")
        .mapInArrow(_links(limit, max_bits), _LINK_SCHEMA),
        label,
    )


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) among distinct fingerprints ``fp`` that connect all within ``max_bits`` (at most 5) bits.

    Not every pair is listed, but every pair is connected. Mixed numbers of the finer step
    may fall together; that costs comparisons and changes nothing, since all are verified.
    """
    if max_bits >= 2 * (len(SEGMENTS) - 1):
        raise ValueError(f"{len(SEGMENTS) - 1} segments find at most {2 * len(SEGMENTS) - 3} bits, not {max_bits}")
    first = _meet(fps.select(F.explode(_variants()).alias("bucket"), "fp"), BUCKET, max_bits, "simhash-links")
    large = first.where("v IS NULL").select("bucket", F.col("u").alias("fp"))
    fine = _meet(large.mapInArrow(_finer(max_bits), "bucket long, fp long"), None, max_bits, "simhash-fine")
    return first.where("v IS NOT NULL").select("u", "v").unionByName(fine.select("u", "v")).distinct()


def classes(fingerprints: DataFrame) -> DataFrame:
    """(fp, root, component_id) from rows (doc_id, fp): of all reachable fingerprints the smallest
    (as a signed number), which names the class, and the smallest doc_id, NULL if there is none."""
    entries = stored(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "simhash-entries")
    roots = stored(components(links(entries)), "simhash-roots")
    in_class = roots.join(entries, roots["node"] == entries["fp"]).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = roots.join(in_class, "root").select(F.col("node").alias("fp"), "root", "component_id")
    return entries.join(of_node, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id), one row per row of ``docs``.

    ``fp`` is the fingerprint as a signed number, ``root`` the smallest of the class. Texts without words (also NULL) have
    fingerprint 0 and are linked like any other. Repeated rows share class and
    fingerprint. A class of NULL ids alone has a NULL component_id. Further columns are
    ignored.
    """
    text_batches(docs.sparkSession)
    prints = stored(
        docs.select("doc_id", text_key(F.col("text")).alias("text_key"), fingerprint("text").alias("fp")), "simhash-prints"
    )
    # Stored, so that the join is one of two plain shuffles, of which a fingerprint with many documents can be split.
    return prints.join(stored(classes(prints), "simhash-classes"), "fp").select(
        "doc_id", "text_key", "fp", "root", "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest doc_id (of equal ids, the
    smallest hash of the text). Rows repeated in full stay once. A class of NULL ids keeps one row."""
    found = near_duplicates(docs)
    chosen = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    (key, keep_id, keep_key) = fresh(docs.columns, "_key", "_id", "_tk")
    keep = chosen.select(F.col("first.doc_id").alias(keep_id), F.col("first.text_key").alias(keep_key))
    keyed = docs.withColumn(key, text_key(F.col("text")))
    same = keyed["doc_id"].eqNullSafe(keep[keep_id]) & (keyed[key] == keep[keep_key])
    return keyed.join(keep, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
