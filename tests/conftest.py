from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("polfin-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="polfin-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="polfin-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    return make_session()
