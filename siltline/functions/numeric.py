"""Numeric expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Amounts are added in units of this part of one; a sum beyond 9 * 10^14 is an error.
UNIT = 10_000


def money_units(amount: Column) -> Column:
    """Amounts as whole numbers of units, whose sums do not depend on the order of addition.

    NULL for NaN and infinities.
    """
    finite = F.abs(amount.cast("double")) < float("inf")  # NaN is above all numbers
    return F.when(finite, F.round(amount * UNIT)).cast("bigint")


def not_finite(amount: Column) -> Column:
    """NaN and infinities; NULL for all other amounts."""
    number = amount.cast("double")
    return F.when(F.abs(number) >= float("inf"), number)


def money_of(units: Column) -> Column:
    """Sum of units, to the cent."""
    return F.round(units / UNIT, 2)


def money_sum(amount: Column) -> Column:
    """Sum to the cent, the same for any order and partitioning.

    It is NaN if an amount is, or if there are infinities of both signs; an infinity else if there is one.
    """
    return F.coalesce(F.sum(not_finite(amount)), money_of(F.sum(money_units(amount))))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def hashed_between(key: Column, salt: str, low: int, high: int) -> Column:
    """A whole number in [low, high] that depends on key and salt alone.

    Unlike ``rand(seed)`` it does not change with the partitioning, so a task that
    is run again writes the same rows.
    """
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return number % F.lit(high - low + 1).cast("bigint") + F.lit(low).cast("bigint")
