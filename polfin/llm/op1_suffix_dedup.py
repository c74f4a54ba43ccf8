"""Removal of long repeated strings with a run-length index.

A string of ``LENGTH`` bytes is named by its minimizer, the ``GRAM``-byte piece in it
with the smallest hash, so equal strings have equal minimizers, and strings that start
next to each other mostly share one. A document is thus a sequence of stretches, each
of up to ``LENGTH - GRAM + 1`` starts with one minimizer, its anchor. Only stretches
with the same anchor can repeat each other.

1. Where texts are read, stretches become rows (anchor, hash of the stretch, place).
   A stretch that comes again in the same batch is settled there.
2. Rows meet by anchor. Of equal stretches all but the first are repeats; first ones
   whose anchor has other stretches, too, go on.
3. Their bytes are fetched, and gathered by anchor into bounded groups. A group gets a
   run-length index (run-compressed Burrows-Wheeler transform with sampled run ends),
   through which its stretches are streamed in order of the corpus; where the matching
   statistic against earlier ones reaches ``LENGTH``, a string starts earlier.
   An anchor with more than ``INDEX_STRETCHES`` different stretches (many variants of
   one text) is too large for one index; its strings meet by their own hash instead,
   which spreads them, and all but the first are repeats.
4. Marks come together per document.

Bytes are only moved for stretches that differ from one with the same anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import fresh, partitions, stored, text_batches, text_key
from polfin.llm.run_index import RunIndex

LENGTH = 100
GRAM = 16
SPAN = LENGTH - GRAM + 1
INDEX_STRETCHES = 4096
INDEX_BYTES = 1 << 17
_AT_ONCE = 1 << 19  # starts of strings looked at together
_POSITION_BITS = np.uint64(22)
_NO_ID = -(1 << 63)  # stands for a NULL doc_id, which comes first

_M1, _M2, _M3 = (np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
# Prefix sums of byte hashes are weighted by powers of an odd number, which has an inverse modulo 2**64.
_BASE = 0x5851F42D4C957F2D
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _M3
    return x ^ (x >> np.uint64(29))


def stretches(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of ``data``: first start, number of starts, anchor, hash of all their bytes.

    ``valid`` says at which places a string of LENGTH bytes starts; behind the last such
    string the data goes on for 8 bytes at least.
    """
    n = len(data) - 7
    eight = np.ndarray((n,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,)).copy()
    gram = _mix(eight[:-8] * _M1 ^ (eight[8:] * _M2))
    places = np.arange(len(gram), dtype=np.uint64)
    low = (gram >> _POSITION_BITS << _POSITION_BITS) | places
    width = 1
    while 2 * width <= SPAN:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (SPAN - width)], low[SPAN - width :])
    at = np.flatnonzero(valid)
    if not len(at):
        none = np.empty(0, np.int64)
        return none, none, none, none
    place = (low[at] & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64)
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    first, anchor_at = at[begin], place[begin]
    up, down = _power_table(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(eight * _M2) * up[:n])])
    end = first + count + LENGTH - 1 - 7  # behind the last 8 bytes of the stretch
    body = (sums[end] - sums[first]) * down[first]
    shape = (count * SPAN + anchor_at - first).astype(np.uint64)
    return first, count, gram[anchor_at].view(np.int64), _mix(body + shape * _M1).view(np.int64)


def _joined(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs [first, first + count) with those that touch made one."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], (first + count)[order]
    new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]])) if len(first) else np.empty(0, np.int64)
    last = np.append(new[1:], len(first)) - 1 if len(first) else new
    return first[new], end[last] - first[new]


_ROW = "anchor long, body long, doc long, text_key long, at long, n long"
_NAMES = ["anchor", "body", "doc", "text_key", "at", "n"]


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and where each string starts; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None and o[-1] > o[0] else np.empty(0, np.uint8)), o - o[0]


def _stretch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of stretches; with a NULL anchor, runs of starts that repeat something earlier in the batch."""
    for b in batches:
        docs, keys = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        data, offsets = _raw(b.column(2))
        starts_left = np.zeros(len(data) + 1, np.int8)
        long = np.flatnonzero(np.diff(offsets) >= LENGTH)
        np.add.at(starts_left, offsets[long], 1)
        np.add.at(starts_left, offsets[long + 1] - LENGTH + 1, -1)
        valid = np.cumsum(starts_left[:-1], dtype=np.int8).astype(bool)
        padded = np.concatenate([data, np.zeros(LENGTH + 16, np.uint8)])
        for a in range(0, len(data), _AT_ONCE):
            part = valid[a : a + _AT_ONCE]
            first, count, anchor, body = stretches(padded[a : a + len(part) + LENGTH + 15], part)
            if not len(first):
                continue
            first = first + a
            of = np.searchsorted(offsets, first, "right") - 1
            local = first - offsets[of]
            order = np.lexsort((local, keys[of], docs[of], body, anchor))
            first, count, anchor, body, of, local = (x[order] for x in (first, count, anchor, body, of, local))
            again = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (body[1:] == body[:-1])])
            # A row that repeats another in full is the same document.
            same = np.concatenate([[False], (docs[of][1:] == docs[of][:-1]) & (keys[of][1:] == keys[of][:-1]) & (local[1:] == local[:-1])])
            new = ~again
            yield _batch(anchor[new], body[new], docs[of[new]], keys[of[new]], local[new], count[new])
            copies = again & ~same
            if copies.any():
                f, n = _joined(first[copies], count[copies])
                of = np.searchsorted(offsets, f, "right") - 1
                yield _batch(None, np.zeros_like(f), docs[of], keys[of], f - offsets[of], n)


def _batch(anchor, body, doc, key, at, n) -> pa.RecordBatch:
    anchors = pa.nulls(len(body), pa.int64()) if anchor is None else pa.array(anchor)
    return pa.RecordBatch.from_arrays([anchors, *(pa.array(np.asarray(x, np.int64)) for x in (body, doc, key, at, n))], names=_NAMES)


class _Previous:
    """The last row of the stream so far, and how many different stretches its anchor has had."""

    row: tuple | None = None
    different = 0


def _first_ones(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by anchor, stretch and place: repeats (NULL anchor), and first ones of anchors with
    several stretches, ``body`` then being the stretch's number within the anchor."""
    before = _Previous()
    waiting: tuple | None = None  # a first one whose anchor may have another; its number
    for b in batches:
        cols = [b.column(i) for i in range(6)]
        known = cols[0].is_valid().to_numpy(zero_copy_only=False)
        a, body, doc, key, at, n = (c.fill_null(0).to_numpy() for c in cols)
        if not known.all():
            yield _batch(None, *(x[~known] for x in (body, doc, key, at, n)))
            a, body, doc, key, at, n = (x[known] for x in (a, body, doc, key, at, n))
        if not len(a):
            continue
        last = before.row or (None,) * 5
        follows = lambda x, i: np.concatenate([[last[i] is not None and x[0] == last[i]], x[1:] == x[:-1]])
        same_anchor = follows(a, 0)
        again = same_anchor & follows(body, 1)
        repeated_row = again & follows(doc, 2) & follows(key, 3) & follows(at, 4)
        copies = again & ~repeated_row
        yield _batch(None, *(x[copies] for x in (body, doc, key, at, n)))

        # Numbers of first ones within their anchor.
        firsts = np.flatnonzero(~again)
        group = np.cumsum(~same_anchor)
        number = np.cumsum(~again)
        begin = np.flatnonzero(~same_anchor)
        base = np.zeros(group[-1] + 1, np.int64)
        base[1:] = number[begin] - 1
        base[0] = -before.different if same_anchor[0] else 0
        number = number - base[group]
        before.row = (a[-1], body[-1], doc[-1], key[-1], at[-1])
        before.different = int(number[-1])

        if len(firsts):
            rows = tuple(x[firsts] for x in (a, number, doc, key, at, n))
            if waiting is not None:
                rows = tuple(np.concatenate([[w], r]) for w, r in zip(waiting, rows))
            joins = rows[0][1:] == rows[0][:-1]
            shared = np.concatenate([joins, [False]]) | (rows[1] > 1)
            keep = shared[:-1]
            yield _batch(*(r[:-1][keep] for r in rows))
            waiting = tuple(r[-1] for r in rows)
    if waiting is not None and waiting[1] > 1:
        yield _batch(*(np.array([w]) for w in waiting))


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of wanted stretches; of anchors with too many, one row per string, named by its hash."""
    schema = pa.schema([("anchor", pa.int64()), ("body", pa.int64()), ("doc", pa.int64()), ("text_key", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("bytes", pa.binary())])
    for b in batches:
        out = []
        for doc, key, text, wanted in zip(*(b.column(i).to_pylist() for i in range(4))):
            raw = (text or "").encode()
            for w in wanted:
                at, n = w["at"], w["n"]
                if not w["crowded"]:
                    out.append((w["anchor"], None, doc, key, at, n, raw[at : at + n + LENGTH - 1]))
                    continue
                for s in range(at, at + n):
                    h = np.frombuffer(xxhash.xxh3_128_digest(raw[s : s + LENGTH]), np.int64)
                    out.append((int(h[0]), int(h[1]), doc, key, s, 1, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)] if out else [pa.array([], t) for t in schema.types], schema=schema)


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats (NULL anchor) among the rows of ``_fetch``, sorted by kind, anchor, body and place."""
    group: list[tuple] = []
    ready: list[tuple] = []
    size = 0
    single = _Previous()

    def index() -> pa.RecordBatch:
        marks = RunIndex([r[5] for r in ready], LENGTH).repeated()
        rows = []
        for (_, doc, key, at, _, _), starts in zip(ready, marks):
            f, n = _joined(starts, np.ones(len(starts), np.int64))
            rows += [(doc, key, at + int(x), int(y)) for x, y in zip(f, n)]
        ready.clear()
        doc, key, at, n = np.array(rows, np.int64).reshape(-1, 4).T
        return _batch(None, np.zeros_like(doc), doc, key, at, n)

    def strings(rows: list[tuple]) -> pa.RecordBatch:
        out = []
        for anchor, body, doc, key, at in rows:
            if single.row and single.row[:2] == (anchor, body) and single.row[2:] != (doc, key, at):
                out.append((doc, key, at))
            single.row = (anchor, body, doc, key, at)
        doc, key, at = np.array(out, np.int64).reshape(-1, 3).T
        return _batch(None, np.zeros_like(doc), doc, key, at, np.ones_like(doc))

    for b in batches:
        hashed = []
        for anchor, body, doc, key, at, n, raw in zip(*(b.column(i).to_pylist() for i in range(7))):
            if raw is None:
                hashed.append((anchor, body, doc, key, at))
                continue
            if group and group[-1][0] != anchor:
                ready += group
                group = []
                if size > INDEX_BYTES:
                    yield index()
                    size = 0
            if not group or group[-1][1:4] != (doc, key, at):
                group.append((anchor, doc, key, at, n, raw))
                size += len(raw)
        if hashed:
            yield strings(hashed)
    ready += group
    if ready:
        yield index()


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc, text_key, at, n): runs of starts of strings that also start earlier; ``doc`` is doc_id, or the
    smallest number for NULL. Runs of a document may touch and overlap."""
    named = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc"), text_key(F.col("text")).alias("text_key"), "text")
    text_batches(docs.sparkSession)
    p = partitions(docs.sparkSession)
    rows = named.mapInArrow(_stretch_rows, _ROW)
    met = stored(
        rows.repartition(p, F.coalesce("anchor", "doc"))
        .sortWithinPartitions("anchor", "body", "doc", "text_key", "at")
        .mapInArrow(_first_ones, _ROW),
        "repeats-met",
    )
    firsts = met.where(F.col("anchor").isNotNull())
    crowded = stored(
        firsts.where(F.col("body") == INDEX_STRETCHES + 1).select(F.col("anchor").alias("_anchor")), "repeats-crowded"
    )
    wanted = (
        firsts.join(crowded, F.col("anchor") == F.col("_anchor"), "left")
        .groupBy("doc", "text_key")
        .agg(F.collect_list(F.struct("anchor", "at", "n", F.col("_anchor").isNotNull().alias("crowded"))).alias("wanted"))
        .select(F.col("doc").alias("_doc"), F.col("text_key").alias("_key"), "wanted")
    )
    fetched = (
        named.join(wanted, (F.col("doc") == F.col("_doc")) & (F.col("text_key") == F.col("_key")))
        .select("doc", "text_key", "text", "wanted")
        .mapInArrow(_fetch, _ROW + ", bytes binary")
    )
    compared = (
        fetched.repartition(p, "anchor")
        .sortWithinPartitions(F.col("bytes").isNotNull(), "anchor", "body", "doc", "text_key", "at")
        .mapInArrow(_compare, _ROW)
    )
    marks = met.where(F.col("anchor").isNull()).unionByName(stored(compared, "repeats-compared"))
    return marks.select("doc", "text_key", "at", "n")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, runs) of documents with repeats; ``runs`` is a list of structs (at, n).

    A string of ``LENGTH`` UTF-8 bytes that starts at one of the ``n`` bytes from ``at``
    also starts earlier: in a document with a smaller doc_id (NULL before all; of equal
    ids, with a smaller hash of the text), or earlier in the same. Rows that repeat
    doc_id and text are one document. Further columns are ignored.
    """
    runs = repeated_runs(docs).groupBy("doc", "text_key").agg(F.collect_list(F.struct("at", "n")).alias("runs"))
    return runs.select(F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), "text_key", "runs")


def with_runs(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with a column ``runs`` added, NULL for texts without repeats."""
    key, doc, tk = fresh([*docs.columns, "runs"], "_k", "_d", "_t")
    found = found.select(F.col("doc_id").alias(doc), F.col("text_key").alias(tk), "runs")
    keyed = docs.drop("runs").withColumn(key, text_key(F.col("text")))
    return keyed.join(found, keyed["doc_id"].eqNullSafe(found[doc]) & (keyed[key] == found[tk]), "left").drop(key, doc, tk)


def kept_bytes(text: str | None, runs) -> tuple[bytes, int, int]:
    """What is left of a text, the number of bytes that go, and of maximal runs that go."""
    raw = (text or "").encode()
    first, n = _joined(np.array([r["at"] for r in runs], np.int64), np.array([r["n"] + LENGTH - 1 for r in runs], np.int64))
    first, n = _joined(first, n)
    pieces, done = [], 0
    for f, m in zip(first.tolist(), n.tolist()):
        pieces.append(raw[done:f])
        done = f + m
    pieces.append(raw[done:])
    return b"".join(pieces), int(n.sum()), len(first)


_REMOVED = T.StructType(
    [T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("sha", T.StringType())]
)


@F.pandas_udf(_REMOVED)
def _removed(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    rows = []
    for t, r in zip(text, runs):
        if r is None:
            rows.append((0, 0, None))
        else:
            kept, n, spans = kept_bytes(t, r)
            rows.append((n, spans, hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(rows, columns=["n_removed", "n_spans", "sha"]).astype({"n_removed": "int64", "n_spans": "int64"})


@F.pandas_udf(T.BinaryType())
def _kept(text: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series([(t or "").encode() if r is None else kept_bytes(t, r)[0] for t, r in zip(text, runs)], dtype=object)


def kept(text: Column, runs: Column) -> Column:
    """The bytes that stay; a cut may fall inside a character, so they are not text."""
    return _kept(text, runs)


def summary(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per row of ``docs``.

    NULL and empty texts have no bytes and lose none.
    """
    marked = with_runs(docs.select("doc_id", "text"), repeats(docs))
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    touched = F.when(F.col("runs").isNotNull(), F.col("text"))
    return marked.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("_whole"), _removed(touched, "runs").alias("r")).select(
        "doc_id", "n_bytes", "r.n_removed", "r.n_spans", F.coalesce("r.sha", "_whole").alias("kept_sha256")
    )
