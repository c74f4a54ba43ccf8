"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# The JVM compiles no method of more bytes than that; it interprets them for ever.
COMPILED_METHOD_BYTES = 8_000
_local_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the library relies on; cluster sizing is left alone."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for what is started inside; a stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


PIECES = "spark.sql.files.maxPartitionBytes"


def _piece(spark: SparkSession, most: int) -> str:
    return str(min(most, int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())))


def pieces_of(spark: SparkSession, most: int):
    """Reads files inside in pieces of ``most`` bytes, or of fewer if the session says so."""
    return settings(spark, {PIECES: _piece(spark, most)})


def read_small_pieces(spark: SparkSession, most: int) -> None:
    """The same for the rest of the session: a stream reads by its settings of the moment, not of its start."""
    spark.conf.set(PIECES, _piece(spark, most))


def cut_wide_methods(spark: SparkSession) -> None:
    """Lets Spark evaluate wide rows in several methods where one would be too long to be compiled.

    A setting of the session, since plans run later; stages with short methods stay as they are.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", COMPILED_METHOD_BYTES)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master without the setting gets a folder of its own, as in tests.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="polfin-")
    return _local_roots[app]


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/polfin/{label}-{uuid.uuid4().hex}"
