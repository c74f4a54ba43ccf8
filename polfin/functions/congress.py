"""Congress numbers as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
FIRST_CONGRESS_YEAR = 1789
MODERN_CONGRESS = 74
MODERN_CONGRESS_YEAR = 1935
DEFAULT_MIN_CONGRESS = 96


def congress_of(date: Column) -> Column:
    """Number of the Congress sitting on a date.

    Terms turn over on 3 January of odd years, so the first two days of an odd
    year belong to the year before. Both numbering rules step once every two
    years from an odd year, and they meet at the 74th Congress of 1935.
    """
    year = F.year(date)
    still_old = (F.month(date) == 1) & (F.dayofmonth(date) < 3) & (year % 2 != 0)
    sitting = F.when(still_old, year - 1).otherwise(year)
    modern = F.floor((sitting - MODERN_CONGRESS_YEAR) / 2) + MODERN_CONGRESS
    early = F.floor((sitting - FIRST_CONGRESS_YEAR) / 2) + 1
    return F.when(sitting >= MODERN_CONGRESS_YEAR, modern).otherwise(early).cast("int")


def congress_start_year(congress: Column) -> Column:
    modern = (congress - MODERN_CONGRESS) * 2 + MODERN_CONGRESS_YEAR
    early = (congress - 1) * 2 + FIRST_CONGRESS_YEAR
    return F.when(congress >= MODERN_CONGRESS, modern).otherwise(early).cast("int")


def congress_end_year(congress: Column) -> Column:
    return (congress_start_year(congress) + 2).cast("int")


def congress_years(congress: Column) -> Column:
    """Struct of the two calendar years a Congress covers."""
    start = (congress.cast("int") * 2 + 1787).cast("int")
    return F.struct(start.alias("start_year"), (start + 1).cast("int").alias("end_year"))
