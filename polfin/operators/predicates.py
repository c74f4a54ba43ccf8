"""Row predicates over contributions, each convertible to one ``Column``.

A predicate never touches data by itself: ``to_column`` builds an expression that
Catalyst can push into the Parquet scan (and, for the cycle, into partition
pruning). Subclass ``Predicate`` to add your own.
"""

from __future__ import annotations

import datetime as dt
from abc import ABC, abstractmethod
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polfin.functions.columns import c
from polfin.functions.scalars import FEDERAL_SEAT_PREFIXES, filled, iso_date, starts_with_any

# Fixed values.
MIN_CYCLE = 1980
MAX_CYCLE = 2024
INDIVIDUAL = "I"

ALL_CYCLES = tuple(range(MIN_CYCLE, MAX_CYCLE + 1, 2))


class Predicate(ABC):
    """A condition on rows; rows where it is NULL are dropped."""

    @abstractmethod
    def to_column(self) -> Column: ...

    def __and__(self, other: Predicate) -> Predicate:
        return AllOf([self, other])

    def __or__(self, other: Predicate) -> Predicate:
        return AnyOf([self, other])


@dataclass
class CycleIn(Predicate):
    cycles: Sequence[int]

    def to_column(self) -> Column:
        return F.col("cycle").isin(*self.cycles)


@dataclass
class CycleBetween(Predicate):
    first: int
    last: int

    def to_column(self) -> Column:
        return F.col("cycle").between(self.first, self.last)


@dataclass
class StateIn(Predicate):
    states: Sequence[str]
    column: str = "contributor.state"

    def to_column(self) -> Column:
        return c(self.column).isin(*self.states)


@dataclass
class AmountBetween(Predicate):
    """Inclusive range; an open side is unbounded and NULL never passes.

    NaN sorts above every number, so an upper bound removes it.
    """

    low: float | None = None
    high: float | None = None

    def to_column(self) -> Column:
        amount = F.col("amount")
        tests = [amount.isNotNull()]
        if self.low is not None:
            tests.append(amount >= self.low)
        if self.high is not None:
            tests.append(amount <= self.high)
        return reduce(and_, tests)


@dataclass
class DateBetween(Predicate):
    """Inclusive range on ISO date text; text that is no date never passes.

    The plain text comparisons follow from the parsed ones and change no result:
    they are there because only they can reach the Parquet statistics.
    """

    start: dt.date | None = None
    end: dt.date | None = None

    def to_column(self) -> Column:
        text = F.col("date")
        day = iso_date(text)
        tests = [day.isNotNull()]
        if self.start:
            tests += [text >= self.start.isoformat(), day >= F.lit(self.start)]
        if self.end:
            if self.end < dt.date.max:
                tests.append(text < (self.end + dt.timedelta(days=1)).isoformat())
            tests.append(day <= F.lit(self.end))
        return reduce(and_, tests)


@dataclass
class FederalSeat(Predicate):
    """Seats of federal races; the prefixes are case-sensitive."""

    column: str = "seat"

    def to_column(self) -> Column:
        return starts_with_any(c(self.column), FEDERAL_SEAT_PREFIXES)


@dataclass
class Filled(Predicate):
    """Neither NULL nor empty text, for every column named."""

    columns: Sequence[str]

    def to_column(self) -> Column:
        return reduce(and_, (filled(c(n)) for n in self.columns))


@dataclass
class Organizational(Predicate):
    """Contributor type is known and is not an individual."""

    column: str = "contributor.type"

    def to_column(self) -> Column:
        return c(self.column).isNotNull() & (c(self.column) != INDIVIDUAL)


@dataclass
class AllOf(Predicate):
    parts: Sequence[Predicate] = field(default_factory=list)

    def to_column(self) -> Column:
        return reduce(and_, (p.to_column() for p in self.parts), F.lit(True))


@dataclass
class AnyOf(Predicate):
    parts: Sequence[Predicate]

    def to_column(self) -> Column:
        return reduce(or_, (F.coalesce(p.to_column(), F.lit(False)) for p in self.parts), F.lit(False))


def recent_cycles(n: int = 4, latest: int = MAX_CYCLE) -> CycleIn:
    """The last ``n`` cycles up to and including ``latest``."""
    return CycleIn(list(range(latest - 2 * (n - 1), latest + 1, 2)))


def large_donors(minimum: float = 1000.0) -> AmountBetween:
    return AmountBetween(low=minimum)


def federal_races() -> FederalSeat:
    return FederalSeat()


def single_state(state: str, include_recipients: bool = True) -> Predicate:
    """Contributor in the state, or either side in it."""
    giver = StateIn([state.upper()])
    if not include_recipients:
        return giver
    return AnyOf([giver, StateIn([state.upper()], "recipient.state")])


def is_valid_cycle(cycle: int) -> bool:
    return cycle in ALL_CYCLES


def valid_cycle_column(name: str = "cycle") -> Column:
    """The same rule on data: an even year within the published range."""
    cycle = c(name)
    return (cycle % 2 == 0) & cycle.between(MIN_CYCLE, MAX_CYCLE)


def valid_cycles(cycles: Iterable[int], strict: bool = False) -> list[int]:
    """Requested cycles that exist; with ``strict`` an unknown one is an error."""
    wanted = list(cycles)
    known = [x for x in wanted if is_valid_cycle(x)]
    if strict and len(known) != len(wanted):
        raise ValueError(f"not an election cycle: {sorted(set(wanted) - set(known))}")
    if not known:
        raise ValueError("no valid election cycle given")
    return known


def requested_cycles(predicates: Iterable[Predicate]) -> list[int] | None:
    """Cycles every cycle predicate agrees on, or None when none restricts them.

    Whether there is data for them is another matter; a range stands for all its years.
    """
    chosen: set[int] | None = None
    for p in predicates:
        if isinstance(p, AllOf):
            found = requested_cycles(p.parts)
        elif isinstance(p, CycleIn):
            found = list(p.cycles)
        elif isinstance(p, CycleBetween):
            found = list(range(p.first, p.last + 1))
        else:
            found = None
        if found is not None:
            chosen = set(found) if chosen is None else chosen & set(found)
    return None if chosen is None else sorted(chosen)


def named_cycles(predicates: Iterable[Predicate]) -> list[int] | None:
    """Cycles the predicates list one by one and all agree on, or None when there is no list."""
    predicates = list(predicates)
    listed = any(
        isinstance(p, CycleIn) or (isinstance(p, AllOf) and named_cycles(p.parts) is not None) for p in predicates
    )
    return requested_cycles(predicates) if listed else None


def where_all(df: DataFrame, predicates: Iterable[Predicate]) -> DataFrame:
    """Keep the rows that satisfy every predicate."""
    return df.where(AllOf(list(predicates)).to_column())
