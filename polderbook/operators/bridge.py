"""Bridge from the base expected loss to the loss under several shocks at once.

Each shock has a step of its own, measured as if it came alone; what the shocks do
together beyond that is the interaction step. All amounts come from one aggregate of
one scan, as exact decimals, so that the order of loans does not matter.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import expected_loss, ratio_or_zero, stage_pd
from polderbook.operators.stress import clip_unit, loss_curve

_AMOUNT = "decimal(28,8)"
# Leaves room for a sum of two totals: at 38 digits Spark would give up decimals.
_TOTAL = "decimal(30,8)"


@dataclass(frozen=True)
class Shock:
    """What a shock does to a loan: ``value_factor`` scales the property, ``yearly_cost`` burdens the
    household and raises the PD by ``pd_response`` times the burden. None leaves a side as it is."""

    value_factor: Column | None = None
    yearly_cost: Column | None = None
    pd_response: float = 0.0


def _loss(*shocks: Shock) -> Column:
    """Expected loss of a loan under the shocks together: factors multiply, PD burdens add."""
    pd, lgd = stage_pd(), F.col("lgd")
    factors = [s.value_factor for s in shocks if s.value_factor is not None]
    if factors:
        value, balance = F.col("property_value_current"), F.col("current_balance")
        shocked = value
        for factor in factors:
            shocked = shocked * factor
        moved = lgd + loss_curve(ratio_or_zero(balance, shocked)) - loss_curve(ratio_or_zero(balance, value))
        lgd = F.when(F.col("nhg_flag"), lgd).otherwise(clip_unit(moved))
    burdens = [ratio_or_zero(s.yearly_cost, F.col("gross_household_income")) * s.pd_response
               for s in shocks if s.yearly_cost is not None]
    if burdens:
        rise = F.lit(1.0)
        for burden in burdens:
            rise = rise + burden
        pd = F.least(F.lit(1.0), pd * rise)
    return expected_loss(pd, lgd)


def _exact(value: Column) -> Column:
    """Decimal of a finite amount, else null."""
    return value.try_cast(_AMOUNT)


def loss_bridge(tape: DataFrame, shocks: Mapping[str, Shock], sanity_bound: float, tolerance: float = 1.0) -> DataFrame:
    """Rows ``position, step, amount, cumulative`` with the check's ``gap``, ``non_finite`` and ``status``.

    Steps are ``base``, every shock in order, ``interaction`` and ``stressed``. The interaction is
    summed per loan and the stressed total on its own, so ``gap`` (the stressed total less all steps
    before it) shows an error in any step. FAILED on a gap beyond ``tolerance`` EUR, on a loan whose
    loss is not a finite number (left out of all amounts), or on a rise beyond three times the
    sanity bound. Zeros for an empty tape.
    """
    names = list(shocks)
    taken = {"base", "interaction", "stressed"} & set(names)
    if taken:
        raise ValueError(f"names of steps are taken: {sorted(taken)}")
    losses = tape.select(
        _loss().alias("base"), _loss(*shocks.values()).alias("stressed"),
        *[_loss(shock).alias(f"alone_{i}") for i, shock in enumerate(shocks.values())])
    alone = [F.col(f"alone_{i}") - F.col("base") for i in range(len(names))]
    together = F.col("stressed") - F.col("base")
    for effect in alone:
        together = together - effect
    # A loan counts in all amounts or in none.
    whole = F.lit(True)
    for name in losses.columns:
        whole = whole & _exact(F.col(name)).isNotNull()
    steps = [F.col("base"), *alone, together, F.col("stressed")]
    sums = losses.select(whole.alias("whole"), *[_exact(s).alias(f"step_{i}") for i, s in enumerate(steps)]).agg(
        F.count_if(~F.col("whole")).alias("non_finite"),
        *[F.coalesce(F.sum(F.when(F.col("whole"), F.col(f"step_{i}"))), F.lit(0)).cast(_TOTAL).alias(f"step_{i}")
          for i in range(len(steps))])
    last = len(steps) - 1
    reached: list[Column] = []
    for i in range(last):
        reached.append((reached[-1] + F.col(f"step_{i}") if reached else F.col("step_0")).cast(_TOTAL))
    reached.append(F.col(f"step_{last}"))
    gap = F.abs(F.col(f"step_{last}") - reached[last - 1])
    rise = F.abs(F.col(f"step_{last}") - F.col("step_0"))
    bad = (F.col("non_finite") > 0) | (gap > tolerance) | (rise > 3 * sanity_bound)
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("step"), F.col(f"step_{i}").alias("amount"), reached[i].alias("cumulative"))
        for i, name in enumerate(["base", *names, "interaction", "stressed"])])
    return sums.select(
        F.inline(rows), gap.cast(_TOTAL).alias("gap"), "non_finite",
        F.when(bad, F.lit("FAILED")).otherwise(F.lit("OK")).alias("status"))
