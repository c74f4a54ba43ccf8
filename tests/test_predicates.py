from __future__ import annotations

import datetime as dt
from collections import namedtuple
from itertools import product

import pytest
from pyspark.sql import functions as F

from polfin.operators import predicates as p

SCHEMA = (
    "cycle int, amount double, date string, `contributor.state` string, `recipient.state` string, seat string"
)
Gift = namedtuple("Gift", "cycle amount date giver taker seat")
# Every combination of a few values of own choice, thinned out so that columns do not go together.
ROWS = [
    (cycle, amount, f"{cycle - i % 2}-{1 + (5 * i) % 12:02}-{1 + (7 * i) % 28:02}", giver, taker, seat)
    for i, (cycle, amount, giver, taker, seat) in enumerate(
        product(
            (2016, 2018, 2022),
            (12.5, 75.25, 301.5, 980.0, 4400.0),
            ("WI", "NM"),
            ("WI", "VT"),
            ("senate", "state:upper", "federal:house", "judicial"),
        )
    )
    if i % 7 in (0, 2, 3)
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.mark.parametrize(
    ("predicate", "rule"),
    [
        (p.CycleIn([2016, 2022]), lambda r: r.cycle in (2016, 2022)),
        (p.CycleIn([1998]), lambda r: False),
        (p.CycleBetween(2017, 2022), lambda r: 2017 <= r.cycle <= 2022),
        (p.StateIn(["WI"]), lambda r: r.giver == "WI"),
        (p.StateIn(["WI", "NM"]), lambda r: r.giver in ("WI", "NM")),
        (p.StateIn(["VT"], "recipient.state"), lambda r: r.taker == "VT"),
        (p.AmountBetween(low=301.5), lambda r: r.amount >= 301.5),
        (p.AmountBetween(high=301.5), lambda r: r.amount <= 301.5),
        (p.AmountBetween(75.25, 980), lambda r: 75.25 <= r.amount <= 980),
        (p.DateBetween(start=dt.date(2019, 7, 4)), lambda r: r.date >= "2019-07-04"),
        (p.DateBetween(end=dt.date(2021, 12, 24)), lambda r: r.date <= "2021-12-24"),
        (p.DateBetween(dt.date(2017, 3, 9), dt.date(2021, 12, 24)), lambda r: "2017-03-09" <= r.date <= "2021-12-24"),
        (p.AllOf([p.CycleIn([2022]), p.AmountBetween(low=301)]), lambda r: r.cycle == 2022 and r.amount >= 301),
        (p.CycleIn([2022]) & p.AmountBetween(low=301), lambda r: r.cycle == 2022 and r.amount >= 301),
        (p.CycleIn([2016]) | p.AmountBetween(high=80), lambda r: r.cycle == 2016 or r.amount <= 80),
        (p.AllOf([]), lambda r: True),
        (p.federal_races(), lambda r: r.seat.startswith(("federal:", "president", "senate", "house"))),
        (p.recent_cycles(), lambda r: 2018 <= r.cycle <= 2024),
        (p.large_donors(), lambda r: r.amount >= 1000),
        (p.single_state("wi"), lambda r: "WI" in (r.giver, r.taker)),
        (p.single_state("WI", include_recipients=False), lambda r: r.giver == "WI"),
    ],
)
def test_counts(rows, predicate, rule):
    assert p.where_all(rows, [predicate]).count() == sum(rule(Gift(*r)) for r in ROWS)


def test_unusable_values_never_pass(spark):
    rows = spark.createDataFrame(
        [(2024, None, d, None, None, s) for d, s in
         [("invalid", None), (None, ""), ("", "Federal:house"), ("2024-13-01", "mayor"), ("2024-1-3", None)]],
        SCHEMA,
    )
    for predicate in (
        p.AmountBetween(),
        p.AmountBetween(low=0),
        p.DateBetween(),
        p.DateBetween(start=dt.date(1900, 1, 1)),
        p.federal_races(),
        p.single_state("CA"),
        p.StateIn(["CA"]),
    ):
        assert p.where_all(rows, [predicate]).count() == 0


def test_timestamps_in_date_text_count_as_their_day(spark):
    rows = spark.createDataFrame([(2024, 1.0, "2024-01-15T10:00:00", "CA", "NY", "house:1")], SCHEMA)
    assert p.where_all(rows, [p.DateBetween(end=dt.date(2024, 1, 15))]).count() == 1
    assert p.where_all(rows, [p.DateBetween(start=dt.date(2024, 1, 16))]).count() == 0


def test_either_side_in_state(spark):
    rows = spark.createDataFrame(
        [(2024, 1.0, "", a, b, "") for a, b in [("CA", "NY"), ("NY", "CA"), (None, "CA"), ("NY", "NY"), (None, None)]],
        SCHEMA,
    )
    assert p.where_all(rows, [p.single_state("CA")]).count() == 3


def test_all_of_equals_filters_in_sequence(rows):
    parts = [p.CycleIn([2016, 2022]), p.AmountBetween(low=100), p.federal_races()]
    together = p.where_all(rows, [p.AllOf(parts)]).collect()
    step = rows
    for part in parts:
        step = p.where_all(step, [part])
    assert together == step.collect()


def test_cycle_rules(spark):
    assert [x for x in p.recent_cycles().cycles] == [2018, 2020, 2022, 2024]
    assert p.is_valid_cycle(1980) and p.is_valid_cycle(2024)
    assert not p.is_valid_cycle(1979) and not p.is_valid_cycle(2023) and not p.is_valid_cycle(2026)
    assert p.valid_cycles([1979, 1980]) == [1980]
    with pytest.raises(ValueError):
        p.valid_cycles([1980, 1981], strict=True)
    with pytest.raises(ValueError):
        p.valid_cycles([1979])
    years = spark.range(1970, 2035).withColumnRenamed("id", "cycle")
    kept = [r["cycle"] for r in years.where(p.valid_cycle_column()).collect()]
    assert kept == list(p.ALL_CYCLES)


def test_cycles_of_several_predicates_intersect():
    tests = [p.CycleIn([2020, 2022, 2024]), p.AllOf([p.CycleBetween(2021, 2030), p.AmountBetween(low=1)])]
    assert p.requested_cycles(tests) == [2022, 2024]
    assert p.requested_cycles([p.AmountBetween(low=1)]) is None


def test_open_ends(rows):
    assert p.where_all(rows, [p.DateBetween(end=dt.date.max)]).count() == p.where_all(rows, [p.DateBetween()]).count() > 0
    assert p.where_all(rows, [p.AnyOf([])]).count() == 0
    assert p.named_cycles([p.CycleBetween(2000, 2004)]) is None
    assert p.named_cycles([p.AllOf([p.CycleIn([1999, 2002])]), p.CycleBetween(2000, 2004)]) == [2002]


def test_predicates_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    spark.createDataFrame(ROWS, SCHEMA).write.partitionBy("cycle").parquet(path)
    tests = [p.CycleIn([2022]), p.AmountBetween(low=100), p.StateIn(["WI"]), p.DateBetween(start=dt.date(2021, 2, 1))]
    df = p.where_all(spark.read.parquet(path), tests).select(F.col("amount"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cycle" in plan and "(cycle" in plan.split("PartitionFilters")[1]
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(amount,100.0)" in pushed
    assert "EqualTo(`contributor.state`,WI)" in pushed or "EqualTo(contributor.state,WI)" in pushed
    assert "GreaterThanOrEqual(date,2021-02-01)" in pushed
    assert "seat" not in plan.split("ReadSchema")[1]
    kept = [r for r in map(Gift._make, ROWS) if r.cycle == 2022 and r.amount >= 100 and r.giver == "WI" and r.date >= "2021-02-01"]
    assert df.count() == len(kept) > 0
