"""Exact decimal arithmetic as Spark column expressions.

Money is DECIMAL(p, 2) end to end.  Rounding follows SQL ``ROUND`` on
NUMERIC: half away from zero, applied once to the exact value.

Spark's decimal division rounds its quotient to a scale of at least 6 digits
before any outer ``round``.  That double rounding can move a quotient whose
exact digits are ``...4999x`` across the half-way point, so ratios here are
computed on integers with a remainder instead: ``q = (a - a % b) / b`` is an
exact integer, and the half-up correction comes from ``2 * (a % b) >= b``.
Everything stays a JVM-side expression (whole-stage codegen, no UDF).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

INT38 = "decimal(38,0)"


def as_int(col: Column) -> Column:
    """Cast an integral-valued column to DECIMAL(38,0) (exact for integral values)."""
    return col.cast(INT38)


def half_up_quotient(a: Column, b: Column) -> Column:
    """ROUND(a / b) half away from zero, for integral a and b; NULL when b is 0 or NULL."""
    a = as_int(a)
    b = as_int(F.nullif(b, F.lit(0)))
    abs_a = F.abs(a)
    abs_b = F.abs(b)
    rem = abs_a % abs_b
    floor_q = as_int((abs_a - rem) / abs_b)
    mag = floor_q + F.when(rem * 2 >= abs_b, F.lit(1)).otherwise(F.lit(0))
    negative = (a < 0) != (b < 0)
    return as_int(F.when(negative, -mag).otherwise(mag))


def unscale(q: Column, scale: int, precision: int = 38) -> Column:
    """Turn an integral count of 10^-scale units back into DECIMAL(precision, scale)."""
    if scale == 0:
        return q.cast(f"decimal({precision},0)")
    step = F.lit(Decimal(1).scaleb(-scale))
    return (as_int(q) * step).cast(f"decimal({precision},{scale})")


def round_ratio(num_units: Column, den_units: Column, scale: int,
                precision: int = 38) -> Column:
    """ROUND(num / den, scale) exactly, given num and den as integral unit counts.

    Both operands must be expressed in the same unit (e.g. both in cents) so
    that their ratio is the intended one.
    """
    q = half_up_quotient(as_int(num_units) * F.lit(10 ** scale), den_units)
    return unscale(q, scale, precision)


def pct(part_units: Column, whole_units: Column, scale: int) -> Column:
    """ROUND(100 * part / NULLIF(whole, 0), scale) exactly (part, whole in one unit)."""
    return round_ratio(as_int(part_units) * F.lit(100), whole_units, scale)


def to_money(col: Column, precision: int = 14) -> Column:
    """Cast to DECIMAL(precision, 2)."""
    return col.cast(f"decimal({precision},2)")


# --- long-integer cents ------------------------------------------------------
#
# Per-row money arithmetic runs on BIGINT cents: Spark multiplies DECIMALs
# through java.math.BigDecimal, while BIGINT arithmetic stays in generated
# code.  With ANSI mode on, an overflow raises an error instead of wrapping,
# so results are exact or the job fails loudly.

def idiv(a: Column, b: Column | int) -> Column:
    """Integer division truncating toward zero (SQL ``div``)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def half_up_long(a: Column, b: int) -> Column:
    """round(a / b) half away from zero for BIGINT a and a positive constant b."""
    if b <= 0:
        raise ValueError("divisor must be positive")
    if b % 2 == 0:
        mag = idiv(F.abs(a) + F.lit(b // 2), b)
    else:
        mag = idiv(F.abs(a) * F.lit(2) + F.lit(b), 2 * b)
    return F.when(a < 0, -mag).otherwise(mag)


def round_half_up_double(x: Column) -> Column:
    """ROUND(x) for DOUBLE, half away from zero, without a BigDecimal per row."""
    return F.when(x < 0, -F.floor(-x + F.lit(0.5))).otherwise(F.floor(x + F.lit(0.5)))


def money_cents(col: Column) -> Column:
    """BIGINT cents of a DECIMAL(p, 2) column (or of a DOUBLE rounded to cents as a DECIMAL)."""
    return (col * F.lit(100)).cast("long")


def sum_cents(col: Column) -> Column:
    """Exact sum of BIGINT cents, accumulated as DECIMAL(38,0).

    Per-row values fit a BIGINT comfortably, but a total over a 100 TB fact
    (about 2e18 cents for all revenue) comes within a small factor of the
    BIGINT limit; a 38-digit accumulator removes that ceiling at the cost of
    one BigDecimal add per row in the partial aggregate.
    """
    return F.sum(col.cast("decimal(20,0)"))


def money_from_cents(c: Column, precision: int = 24) -> Column:
    """DECIMAL(precision, 2) from BIGINT cents."""
    return unscale(c, 2, precision)
