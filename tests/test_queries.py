"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from polfin.catalog.registry import ORACLES, QUERIES
from tests.check_queries import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

# Features too rare to show up in ten recipients.
EMPTY_WHEN_TINY = {"j01_ambiguous_recipients"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["cycle", "bonica.rid"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    problem = compare(spark, con, name, SF_DIR)
    if problem == "no rows on either side" and name in EMPTY_WHEN_TINY:
        return
    assert problem is None
