"""Filters over very many columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def opaque(predicate: Column) -> Column:
    """The same filter, kept out of constraint propagation.

    Where columns are renamed next to a filter, the optimizer derives the filter
    under every combination of old and new names: 2^n variants for one condition
    over n columns, which hangs planning for a test of a whole loan. It leaves a
    condition alone that is not deterministic, hence the comparison with a number
    in [0, 1): always below 1, never below 0.
    """
    return F.rand(0) < F.when(predicate, F.lit(1.0)).otherwise(F.lit(0.0))


def where_computed(frame: DataFrame, predicate: Column) -> DataFrame:
    """``frame`` where ``predicate`` is true, which then sees each column computed once per row.

    A filter moves below the projection that makes its columns and repeats their
    expressions wherever it names them, which is costly when they are parsed or printed
    values. It stays above a projection with a column that is not deterministic; the
    filter has to read that column, or it would be pruned.
    """
    drawn = frame.select("*", F.rand(0).alias("drawn"))
    return drawn.where(F.rand(0) < F.when(predicate, F.lit(1.0) + F.col("drawn")).otherwise(F.lit(0.0))).drop("drawn")
