"""Line deduplication over range-partitioned hashes.

Each document yields one row per distinct line key: a 128-bit hash, the document,
and the positions at which the key stands. Rows are range-partitioned by hash and
document, so a key that stands in a third of all documents is cut over many tasks,
and sorted by hash, document and position. One pass over the sorted stream finds
the first occurrence of each key and how many documents follow; only the first few
rows of a key are held back until it is known to be frequent. Keys that may go on
in a neighbouring range are settled afterwards from one count per range.

What comes back is a compressed keep bitmap per document, not its text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import BLANKS, fresh, partitions, stored, text_batches, text_key

_BLANKS = BLANKS.encode()
_DROP, _OPEN, _COUNT = 0, 1, 2
_KEYED = "hash binary, doc_id long, text_key long, positions binary"


def line_key(line: bytes) -> bytes:
    """Blanks stripped at both ends, ASCII letters lower-cased."""
    return line.strip(_BLANKS).lower()


def _keyed_lines(min_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, docs, texts, places = [], [], [], []
            for doc, tk, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                at: dict[bytes, list[int]] = {}
                for i, line in enumerate((text or "").encode().split(b"\n")):
                    at.setdefault(line_key(line), []).append(i)
                for key, positions in at.items():
                    if len(key.decode()) >= min_chars:
                        hashes.append(xxhash.xxh3_128_digest(key))
                        docs.append(doc)
                        texts.append(tk)
                        places.append(np.array(positions, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.binary()), pa.array(docs, pa.int64()), pa.array(texts, pa.int64()), pa.array(places, pa.binary())],
                names=["hash", "doc_id", "text_key", "positions"],
            )

    return run


def _stream(min_docs: int, keep_first: bool):
    """Rows (kind, hash, doc_id, text_key, positions, n) from one sorted range.

    kind _DROP: these lines go. kind _OPEN: decided by all ranges of the hash.
    kind _COUNT: documents of the hash in this range.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[tuple] = []  # rows of the current hash, until it is frequent
        current = last = None
        n, first_run = 0, True

        def give(row: tuple, kind: int) -> None:
            out.append((kind, *row, 0))

        def settle(edge: bool) -> None:
            """The hash ends here, or at an edge of the range, where its first row stays open."""
            if edge:
                out.append((_COUNT, current, None, None, None, n))
                for row in held:
                    give(row, _OPEN)

        def frequent(edge: bool) -> None:
            for i, row in enumerate(held):
                if i:
                    give(row, _DROP)
                elif edge:
                    give(row, _OPEN)
                elif not keep_first:
                    give(row, _DROP)
                elif len(row[3]) > 4:
                    give((*row[:3], row[3][4:]), _DROP)
            held.clear()

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 6
            out.clear()
            types = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names=["kind", "hash", "doc_id", "text_key", "positions", "n"]
            )

        pending: list[tuple] = []  # the first row of a hash that turned out frequent: open if the hash is the range's last
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if row[0] != current:
                    if current is not None:
                        if pending:
                            held[:] = pending
                            frequent(edge=first_run)
                            pending = []
                            if first_run:
                                out.append((_COUNT, current, None, None, None, n))
                        else:
                            settle(edge=first_run)
                        first_run = False
                    held.clear()
                    current, last, n = row[0], None, 0
                if row[1:3] == last:  # a repeated row of one document
                    continue
                last = row[1:3]
                n += 1
                if pending:
                    give(row, _DROP)
                    continue
                held.append(row)
                if n >= min_docs:
                    pending = [held[0]]
                    for later in held[1:]:
                        give(later, _DROP)
                    held.clear()
            yield batch()
        if current is not None:
            if pending:
                held[:] = pending
                frequent(edge=True)
                out.append((_COUNT, current, None, None, None, n))
            else:
                settle(edge=True)
            yield batch()

    return run


@F.pandas_udf(T.BinaryType())
def _bitmap(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    def one(n: int, parts) -> bytes:
        keep = np.ones(n, bool)
        if parts is not None:
            for p in parts:
                keep[np.frombuffer(p, "<u4")] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pd.Series([one(n, p) for n, p in zip(n_lines, dropped)], dtype=object)


@F.pandas_udf(T.LongType())
def _count_dropped(dropped: pd.Series) -> pd.Series:
    return pd.Series([0 if d is None else sum(len(p) // 4 for p in d) for d in dropped], dtype="int64")


def kept_lines(text: str | None, n_lines: int, bitmap: bytes) -> bytes:
    """The lines whose bit is set, joined as they were."""
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[:n_lines]
    return b"\n".join(line for line, k in zip((text or "").encode().split(b"\n"), keep) if k)


def dropped_lines(docs: DataFrame, min_docs: int, min_chars: int, keep_first: bool) -> DataFrame:
    """(doc_id, text_key, dropped): for documents that lose lines, their packed positions."""
    keyed = docs.select("doc_id", "text_key", "text").select("doc_id", "text_key", "text").mapInArrow(_keyed_lines(min_chars), _KEYED)
    ranges = keyed.repartitionByRange(partitions(docs.sparkSession), "hash", "doc_id", "text_key").sortWithinPartitions(
        "hash", "doc_id", "text_key"
    )
    found = stored(
        ranges.mapInArrow(
            _stream(min_docs, keep_first), "kind int, hash binary, doc_id long, text_key long, positions binary, n long"
        ),
        "line-ranges",
    )
    counts = found.where(F.col("kind") == _COUNT).groupBy("hash").agg(F.sum("n").alias("total")).where(F.col("total") >= min_docs)
    order = Window.partitionBy("hash").orderBy("doc_id", "text_key")
    open_rows = (
        found.where(F.col("kind") == _OPEN)
        .join(counts, "hash", "left_semi")
        .withColumn("nth", F.row_number().over(order) if keep_first else F.lit(2))
        .select(
            "doc_id",
            "text_key",
            F.when(F.col("nth") > 1, F.col("positions")).otherwise(F.expr("substring(positions, 5)")).alias("positions"),
        )
    )
    rows = found.where(F.col("kind") == _DROP).select("doc_id", "text_key", "positions").unionByName(open_rows)
    return rows.where(F.length("positions") > 0).groupBy("doc_id", "text_key").agg(F.collect_list("positions").alias("dropped"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_id, text_key, n_lines, n_dropped, keep): one row per document and distinct text.

    A key that stands in ``min_docs`` documents or more loses its lines everywhere, or
    everywhere but at its first occurrence (smallest doc_id and position) with
    ``keep_first``. ``keep`` is a deflated bitmap, first line in the highest bit. Keys
    shorter than ``min_chars`` code points stay. A NULL or empty text is one empty line.
    Rows that repeat doc_id and text are one document; rows that share only the doc_id
    are several. Further columns are ignored.
    """
    text_batches(docs.sparkSession)
    named = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    lines = named.select(
        "doc_id", "text_key", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines")
    )
    dropped = dropped_lines(named, min_docs, min_chars, keep_first).toDF("_doc", "_key", "dropped")
    per_doc = lines.groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"))
    both = per_doc["doc_id"].eqNullSafe(dropped["_doc"]) & (per_doc["text_key"] == dropped["_key"])
    return per_doc.join(dropped, both, "left").select(
        "doc_id",
        "text_key",
        "n_lines",
        _count_dropped("dropped").alias("n_dropped"),
        _bitmap("n_lines", "dropped").alias("keep"),
    )


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``lines`` (n_lines, n_dropped, keep) added to each row."""
    key, doc, tk = fresh([*docs.columns, "lines"], "_k", "_d", "_t")
    marks = bitmaps.select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(tk), F.struct("n_lines", "n_dropped", "keep").alias("lines")
    )
    keyed = docs.drop("lines").withColumn(key, text_key(F.col("text")))
    return keyed.join(marks, keyed["doc_id"].eqNullSafe(marks[doc]) & (keyed[key] == marks[tk])).drop(key, doc, tk)


@F.pandas_udf(T.StringType())
def _kept_sha(text: pd.Series, n_lines: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series(
        [None if k is None else hashlib.sha256(kept_lines(t, n, k)).hexdigest() for t, n, k in zip(text, n_lines, keep)],
        dtype=object,
    )


@F.pandas_udf(T.StringType())
def _kept_text(text: pd.Series, n_lines: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series([kept_lines(t, n, k).decode() for t, n, k in zip(text, n_lines, keep)], dtype=object)


def kept_text(text: Column, lines: Column) -> Column:
    return _kept_text(text, lines["n_lines"], lines["keep"])


def kept_sha256(text: Column, lines: Column) -> Column:
    """SHA-256 of the kept text; texts that lose nothing are hashed where they are."""
    loses = lines["n_dropped"] > 0
    touched = _kept_sha(F.when(loses, text), lines["n_lines"], F.when(loses, lines["keep"]))
    return F.coalesce(touched, F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256))
