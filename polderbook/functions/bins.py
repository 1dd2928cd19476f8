"""An order-preserving coarse key for doubles.

Ranks and cumulative counts over a large column need its values in order, and a
single sorted partition does not scale. ``order_bin`` maps a value to a bin such
that a larger value never gets a smaller bin. Work then splits in two: totals per
bin (few rows) are ordered globally, single values only inside their bin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bins per factor e: relative width 1/2048, at most some 20,000 bins over the
# four decades that loan amounts span.
_PER_E_FOLD = 2048.0
# Keeps the logarithm of the smallest positive double above zero.
_SHIFT = 750.0


def order_bin(value: Column) -> Column:
    """Monotone bin of a non-null, non-NaN double (infinities get their own bins).

    Declared non-null, so a join on the bin adds no null filter to one of its sides
    and both sides can share the shuffle below.
    """
    magnitude = F.floor((F.ln(F.abs(value)) + _SHIFT) * _PER_E_FOLD).cast("double")
    infinite = F.lit(float("inf"))
    bin_of = (
        F.when(value == 0, F.lit(0.0))
        .when(F.abs(value) == infinite, value)
        .otherwise(F.signum(value) * magnitude)
    )
    return F.coalesce(bin_of, F.lit(0.0))
