"""Keep an expensive expression from being evaluated more than once per row.

Catalyst inlines a projected expression into every filter and projection that mentions
it. That is right for cheap expressions, but a regular expression over a whole text is
then run once per mention.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, inside one expression."""
    return F.transform(F.array(value), body)[0]


def holds(value: Column, test: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and test it."""
    return F.exists(F.array(value), test)


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns through a generator of one row per row, which is never inlined.

    Filters on other columns still pass below it, down to the scan. The columns are
    computed even where a query does not use them, so this is for columns that a filter
    needs; a plain projection is not repeated by the projections above it.
    """
    values = F.array(F.struct(*(column.alias(name) for name, column in columns.items())))
    return df.select("*", F.inline(values))
