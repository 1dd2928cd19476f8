"""Lookups in the yearly reference tables as expressions.

The tables have a handful of rows, so a lookup is a literal map inside the
projection: no join, no exchange, nothing that grows with the tape.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from polderbook.functions.derived import original_lti, vintage
from polderbook.sources.reference_tables import HRA_RATES, NHG_CAPS, NIBUD_LTI_PCT


def value_for_year(year: Column, table: dict[int, float]) -> Column:
    """The table value for a year: the first before the table starts, else the last if missing."""
    first, last = min(table), max(table)
    literal = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(table.items()))])
    return F.coalesce(
        F.when(year < first, F.lit(table[first])), literal[year], F.lit(table[last])
    )


def nhg_cap_for(year: Column, table: dict[int, float] = NHG_CAPS) -> Column:
    return value_for_year(year, table)


def hra_rate_for(year: Column, table: dict[int, float] = HRA_RATES) -> Column:
    return value_for_year(year, table)


def nibud_factor(
    year: Column, income: Column, table: dict[int, dict[float, float]] = NIBUD_LTI_PCT
) -> Column:
    """Loan-to-income factor of the highest band at or below the income.

    Incomes below the first band use the first band; years without a published
    table give null.
    """
    by_year = F
    for published, bands in sorted(table.items()):
        starts = sorted(bands, reverse=True)
        factor = F
        for start in starts[:-1]:
            factor = factor.when(income >= start, F.lit(bands[start] / 100.0))
        by_year = by_year.when(
            year == published, factor.otherwise(F.lit(bands[starts[-1]] / 100.0))
        )
    return by_year


def nibud_columns() -> dict[str, Column]:
    factor = nibud_factor(vintage(), F.col("gross_household_income"))
    return {
        "original_lti": original_lti(),
        "nibud_factor": factor,
        "exceeds_nibud": original_lti() > factor,
    }
