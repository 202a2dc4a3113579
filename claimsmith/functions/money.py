"""Exact money arithmetic in integer cents.

Doubles are only produced at the edge (``cents_to_double``); sums, splits
and rounding happen on whole cents (decimals of 38 digits, so amounts beyond
64 bits of cents are neither lost nor wrong), so results do not depend on
summation order or partitioning and agree bit-for-bit with a SQL engine doing
the same integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Type of whole cents.
CENTS = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_cents(c: Column | str) -> Column:
    """Money (double / decimal / text) -> whole cents, half-up on the cent.
    Null for what is no amount, and beyond 10^34."""
    dec = _col(c).try_cast("decimal(36,2)")
    return (dec * F.lit(100)).cast(CENTS)


def cents_to_double(c: Column | str) -> Column:
    return _col(c).cast("double") / F.lit(100.0)


def int_div(a: Column, b: Column) -> Column:
    """Truncating integer division (SQL ``div``), never via double."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def floor_div(a: Column, n: Column) -> Column:
    """floor(a / n) for positive n: a - pmod(a, n) is an exact multiple of n."""
    return int_div(a - F.pmod(a, n), n)


def floor_div_cents(a: Column, n: Column) -> Column:
    """floor(a / n) of whole cents for positive n: the quotient of an exact
    multiple has no fraction to round."""
    a, n = a.cast(CENTS), n.cast(CENTS)
    return ((a - F.pmod(a, n)) / n).cast(CENTS)


def half_even_unit(total_cents: Column, n: Column, div: Callable[[Column, Column], Column] = floor_div) -> Column:
    """round_half_even(total / n) in whole cents. ``div``: ``floor_div`` for
    bigint cents, ``floor_div_cents`` for decimal ones."""
    q = div(total_cents, n)
    r = F.pmod(total_cents, n)
    up = (r * 2 > n) | ((r * 2 == n) & (F.pmod(q, F.lit(2)) == 1))
    return F.when(up, q + 1).otherwise(q)


def allocate_cents(total_cents: Column, n: Column, seq: Column,
                   div: Callable[[Column, Column], Column] = floor_div) -> Column:
    """Rows 1..n-1 get the half-even unit, row n the exact remainder.

    The parts always sum to the total; the last part may be negative when
    the unit rounds up on many rows. Null total -> null parts.
    """
    unit = half_even_unit(total_cents, n, div)
    return F.when(seq < n, unit).otherwise(total_cents - unit * (n - 1))


def allocate_integer(total: Column, n: Column, seq: Column) -> Column:
    """Floor unit on rows 1..n-1, remainder on row n."""
    unit = floor_div(total.cast("bigint"), n)
    return F.when(seq < n, unit).otherwise(total - unit * (n - 1))


def cap_at(value: Column, cap: Column) -> Column:
    """Value if value <= cap, else cap (a null value stays null)."""
    return F.when(value > cap, cap).otherwise(value)


def round_half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """round_half_up(num / den, scale) as a double, exact on integer inputs.

    ``num`` and ``den`` are integers (e.g. cents); den = 0 or null -> null.
    Works in decimal(38,0) so that large sums cannot overflow.
    """
    factor = 10 ** scale
    a = F.abs(num).cast(CENTS)
    d = F.nullif(F.abs(den).cast(CENTS), F.lit(0))
    k = floor_div_cents(a * F.lit(2 * factor) + d, d * F.lit(2))
    negative = (num < 0) != (den < 0)
    signed = F.when(negative & (num != 0), -k).otherwise(k)
    return F.when(den != 0, signed.cast("double") / F.lit(float(factor)))


def round_half_up_cents_avg(sum_cents: Column, n: Column) -> Column:
    """Average of cents, rounded half-up to the cent, as a double amount."""
    return round_half_up_ratio(sum_cents, n, 0) / F.lit(100.0)
