"""Centroid clustering over a vector approximation file.

Vectors are stored once, as whole numbers, each beside its approximation: per dimension
the number of a cell, ``BITS`` bits, of that dimension's range. A round of Lloyd's method
scans that file. For every centroid a table, filled once per batch, gives for each
dimension and cell the least and the greatest squared distance that a value of the cell
can have; summed over the dimensions these are bounds of the distance of a vector. Where
one centroid's upper bound lies below all other lower bounds the vector is assigned by its
cells alone. Only where intervals overlap its full components are decoded and measured,
and only against the centroids that overlap.

A round needs no shuffle of vectors: tasks add up the components of each cluster exactly
and send one row per cluster. Centroids are the only state; the driver holds them
(``k`` times the dimensions), and a lost executor repeats the tasks it had.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polfin.llm.common import stored

DIMENSIONS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = "2:"
BITS = 6
# Vectors looked at together in a task.
BLOCK = 1024
# Components beyond this count as this, so that a squared distance fits 63 bits.
LARGEST = 1 << 27


@dataclass
class Cells:
    """Borders of the cells: cell j of dimension d holds whole numbers from edge[d, j] up to edge[d, j + 1] - 1."""

    edges: np.ndarray

    @staticmethod
    def between(low: np.ndarray, high: np.ndarray, bits: int) -> Cells:
        n = 1 << bits
        width = (high - low + n) // n  # the last cell ends at or behind ``high``
        return Cells(low[:, None] + width[:, None] * np.arange(n + 1)[None, :])

    def of(self, vectors: np.ndarray) -> np.ndarray:
        low, width = self.edges[:, 0], self.edges[:, 1] - self.edges[:, 0]
        return ((vectors - low) // width).astype(np.uint8)

    def tables(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance, by dimension, cell and centroid."""
        low, high = self.edges[:, :-1, None], self.edges[:, 1:, None] - 1
        at = centroids.T[:, None, :]
        least = np.maximum(np.maximum(low - at, at - high), 0)
        greatest = np.maximum(np.abs(low - at), np.abs(high - at))
        return least * least, greatest * greatest


def whole_vectors(vectors: DataFrame, dimensions: int) -> DataFrame:
    """(vec_id, components): the kept rows, components as whole numbers."""
    v = F.col("embedding")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    right = (F.size(v) == dimensions) & ~F.exists(v, bad)
    bounded = lambda x: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * SCALE)))
    kept = vectors.where(F.coalesce(right, F.lit(False)))
    return kept.select("vec_id", F.transform(v, bounded).cast("array<int>").alias("components"))


def _matrix(column: pa.Array, dtype: type, dimensions: int) -> np.ndarray:
    """Rows of equally long binary values."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(-1, dimensions)


def approximation_file(whole: DataFrame, dimensions: int, bits: int = BITS) -> tuple[DataFrame, Cells | None]:
    """(vec_id, cells, full) and the cells' borders, which span the values of each dimension; no rows, no borders."""
    ends = [f(F.get("components", F.lit(d))).alias(f"{name}{d}") for d in range(dimensions) for name, f in (("low", F.min), ("high", F.max))]
    span = whole.agg(*ends).first()
    if span is None or span["low0"] is None:
        return whole.select("vec_id", F.lit(None).cast("binary").alias("cells"), F.lit(None).cast("binary").alias("full")), None
    low, high = (np.array([span[f"{name}{d}"] for d in range(dimensions)], np.int64) for name in ("low", "high"))
    cells = Cells.between(low, high, bits)

    def approximated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            full = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, dimensions)
            columns = [b.column(0), [r.tobytes() for r in cells.of(full)], [r.tobytes() for r in full]]
            yield pa.RecordBatch.from_arrays([pa.array(x) if isinstance(x, list) else x for x in columns], names=["vec_id", "cells", "full"])

    id_type = whole.schema["vec_id"].dataType.simpleString()
    return stored(whole.mapInArrow(approximated, f"vec_id {id_type}, cells binary, full binary"), "va-file"), cells


def nearest(approx: np.ndarray, full: np.ndarray | list[bytes], centroids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """Number of the nearest centroid of each vector (ties: the smaller), and how many vectors were fetched for it."""
    n, d = approx.shape
    lower, upper = (np.zeros((n, len(centroids)), np.int64) for _ in range(2))
    for i in range(d):
        lower += tables[0][i][approx[:, i]]
        upper += tables[1][i][approx[:, i]]
    open_ = lower <= upper.min(axis=1, keepdims=True)
    out = open_.argmax(axis=1)
    undecided = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(undecided):
        fetched = np.frombuffer(b"".join([full[i] for i in undecided]), np.int32).reshape(-1, d).astype(np.int64)
        best = np.full(len(undecided), np.iinfo(np.int64).max)
        for c in range(len(centroids)):
            rows = np.flatnonzero(open_[undecided, c])
            if len(rows):
                off = fetched[rows] - centroids[c]
                far = (off * off).sum(axis=1)
                closer = far < best[rows]
                best[rows[closer]] = far[closer]
                out[undecided[rows[closer]]] = c
    return out, len(undecided)


def _blocks(batches: Iterable[pa.RecordBatch], centroids: np.ndarray, cells: Cells) -> Iterator[tuple[pa.Array, list[bytes], np.ndarray, int]]:
    tables = cells.tables(centroids)
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            full = part.column(2).to_pylist()
            yield part.column(0), full, *nearest(_matrix(part.column(1), np.uint8, centroids.shape[1]), full, centroids, tables)


def cluster_sums(file: DataFrame, centroids: np.ndarray, cells: Cells) -> tuple[np.ndarray, list[list[int]], int]:
    """Vectors and component sums of each cluster, and the number of vectors that were fetched to assign them."""

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        n, sums, fetched = np.zeros(k, np.int64), np.zeros((k, d), np.int64), 0
        for _, full, cluster, more in _blocks(batches, centroids, cells):
            vectors = np.frombuffer(b"".join(full), np.int32).reshape(-1, d)
            order = np.argsort(cluster, kind="stable")
            there, first = np.unique(cluster[order], return_index=True)
            sums[there] += np.add.reduceat(vectors[order].astype(np.int64), first, axis=0)
            n += np.bincount(cluster, minlength=k)
            fetched += more
        rows = [np.arange(k, dtype=np.int32), n, np.where(np.arange(k) == 0, fetched, 0)]
        columns = [*map(pa.array, rows), pa.array(list(sums), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "n", "fetched", "sums"])

    parts = file.mapInArrow(summed, "cluster int, n long, fetched long, sums array<bigint>")
    k, d = centroids.shape
    # Decimals, since sums over all rows may pass 63 bits.
    total = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("fetched").alias("fetched"), *total).collect()
    n, sums = np.zeros(k, np.int64), [[0] * d for _ in range(k)]
    for r in rows:
        n[r["cluster"]] = r["n"]
        sums[r["cluster"]] = [int(r[f"s{i}"]) for i in range(d)]
    return n, sums, sum(r["fetched"] for r in rows)


def first_centroids(whole: DataFrame, k: int) -> np.ndarray:
    """The ``k`` kept vectors with the smallest hash of their id; ties go by components."""
    named = F.concat(F.lit(SEED), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = whole.select(F.sha2(named, 256).alias("h"), "components").orderBy("h", "components").limit(k).collect()
    return np.array([r["components"] for r in chosen], np.int64)


@dataclass
class Clustering:
    """Centroids, and what it took: (vectors assigned, of these fetched in full) per round."""

    file: DataFrame
    cells: Cells | None
    centroids: np.ndarray
    work: list[tuple[int, int]]


def cluster(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, bits: int = BITS) -> Clustering:
    """Lloyd's rounds from the first centroids on; empty clusters keep theirs."""
    whole = stored(whole_vectors(vectors, dimensions), "vectors")
    file, cells = approximation_file(whole, dimensions, bits)
    if cells is None:
        return Clustering(file, None, np.empty((0, dimensions), np.int64), [])
    centroids, work = first_centroids(whole, k), []
    for _ in range(rounds):
        n, sums, fetched = cluster_sums(file, centroids, cells)
        work.append((int(n.sum()), fetched))
        centroids = np.array([[s // int(m) for s in row] if m else list(old) for m, row, old in zip(n, sums, centroids)], np.int64)
    return Clustering(file, cells, centroids, work)


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def assignments(found: Clustering) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept row.

    Rows whose vector is NULL, has another length, or a component that is NULL, NaN or
    infinite are left out. Components beyond ``LARGEST`` in size count as that. Repeated
    rows and ids, also NULL ones, are vectors of their own; with fewer rows than centroids
    each is one. No kept row: an empty result. Further columns are ignored.
    """
    id_type = found.file.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, cluster int, distance long"
    centroids, cells = found.centroids, found.cells

    def assigned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, full, cluster, _ in _blocks(batches, centroids, cells):
            vectors = np.frombuffer(b"".join(full), np.int32).reshape(len(cluster), -1).astype(np.int64)
            off = vectors - centroids[cluster]
            columns = [ids, pa.array(cluster.astype(np.int32)), pa.array((off * off).sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    spark = found.file.sparkSession
    each = stored(found.file.mapInArrow(assigned, schema), "va-assigned") if cells is not None else spark.createDataFrame([], schema)
    per = each.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # one row per centroid
    inertia = {r["cluster"]: r["cluster_inertia"] for r in per}
    facts = [(i, inertia[i], sum(inertia.values()), centroid_sha256(centroids[i])) for i in sorted(inertia)]
    rows = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return each.join(F.broadcast(rows), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
