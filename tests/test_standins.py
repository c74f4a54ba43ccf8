"""Contributions are laid out by cycle without moving their wide rows."""

from __future__ import annotations

import contextlib
import io
from collections import Counter

from polfin.catalog import q_checks, q_groups, standins, stored  # noqa: F401
from polfin.catalog.registry import QUERIES
from polfin.functions.columns import cols

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def as_given(spark, sf_dir: str):
    """The rows as the SQL that they are checked against has them."""
    for name in ("lineitem", "orders", "customer", "supplier", "nation"):
        standins.table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(standins.STANDINS["contributions"].select("`"))


def test_same_rows_in_folders(spark):
    want = Counter(as_given(spark, SF).collect())
    names = list(standins.STANDINS["contributions"].expressions)
    assert Counter(standins.load(spark, SF, "contributions").collect()) == want
    assert Counter(spark.read.parquet(stored.contributions_root(spark, SF)).select(*cols(names)).collect()) == want


def test_no_shuffle_of_wide_rows(spark, monkeypatch):
    """Items and orders meet by their key (orders met customers); nothing is moved once columns are made, nor for the cycles."""
    seen = []
    monkeypatch.setattr(stored, "_written", {})
    monkeypatch.setattr(stored, "write_cycles", lambda df, path, **options: seen.append((df, options)))
    stored.contributions_root(spark, SF)
    (df, options), = seen
    assert options == {"gather": False}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(standins.contributions(spark, SF, by_cycle="cycle"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_orderkey" in text and "hashpartitioning(o_custkey" in text
    assert "hashpartitioning(l_suppkey" not in text and "rebalance" not in text.lower()


def test_linked_marts_read_files(spark):
    """The distinct marts go over their input several times, so it is no join of the given tables."""
    for name in ("m07_organizational_linked", "m09_raw_organizational", "m09_detail_report"):
        files = QUERIES[name](spark, SF).inputFiles()
        assert not [f for f in files if f.endswith(("lineitem.parquet", "orders.parquet"))], name
