"""Exact decimal arithmetic helpers.

All money stays DECIMAL. Ratios are taken on operands trimmed to a width that
leaves at least twelve digits after the point, so one final half-up rounding is
the only rounding a reader can see. Wide decimal division is slow; where a quotient
in doubles is clearly nearer to one result than to any other, that result is taken.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(24,2)"
_LOW_BITS = 24
_NUMERATOR = "decimal(26,4)"
_DENOMINATOR = "decimal(24,4)"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_zero(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(0))


def total(c: Column | str) -> Column:
    """Sum of money, held at one width however often totals are summed again."""
    return F.sum(col(c)).cast(TOTAL)


def scaled(c: Column | str, digits: int, name: str) -> dict[str, Column]:
    """A decimal as a whole number of its last digit, cut into a high and a low part.

    A sum of parts stays exact for 2**39 rows, of 18 digits each for 2**27.
    """
    whole = (col(c) * F.lit(10**digits)).cast("bigint")
    return {
        f"{name}_high": F.shiftright(whole, _LOW_BITS),
        f"{name}_low": whole.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)),
    }


def unscaled(high: Column, low: Column, digits: int) -> Column:
    wide = high.cast("decimal(28,0)") * F.lit(Decimal(1 << _LOW_BITS)) + low.cast("decimal(28,0)")
    # most sums fit a long: 2**37 high parts and 2**61 in low ones stay below 2**62
    small = (F.abs(high) < 1 << 37) & (low < 1 << 61)
    long = F.shiftleft(high, _LOW_BITS) + low
    whole = F.when(small, long.cast("decimal(28,0)")).otherwise(wide)
    return (whole * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(24,{digits})")


def ratio(top: Column | str, bottom: Column | str, digits: int = 2, times: int = 1) -> Column:
    """``top / bottom * times`` rounded half-up; null when ``bottom`` is zero.

    Operands have up to four digits after the point.
    """
    kind = f"decimal(22,{digits})"
    step = Decimal(1).scaleb(-digits)
    # in doubles, off by less than 1e-4 steps below 1e11 of them
    steps = (
        col(top).cast("double") / F.nullif(col(bottom).cast("double"), F.lit(0.0))
        * F.lit(float(times / step))
    )
    nearest = F.rint(steps)
    sure = (F.abs(steps) < 1e11) & (F.abs(steps - nearest) < 0.4999)
    # the rare rest as a lambda: generated methods stay short, long ones are never compiled
    rest = F.transform(
        F.array(F.struct(col(top).alias("top"), col(bottom).alias("bottom"))),
        lambda pair: _exact_ratio(pair["top"], pair["bottom"], digits, times).cast(kind),
    )
    return F.when(
        sure, (nearest.cast("bigint").cast("decimal(11,0)") * F.lit(step)).cast(kind)
    ).otherwise(F.get(rest, F.lit(0)))


def _exact_ratio(top: Column, bottom: Column, digits: int, times: int) -> Column:
    bottom = F.nullif(bottom.cast(_DENOMINATOR), F.lit(0).cast(_DENOMINATOR))
    quotient = top.cast(_NUMERATOR) / bottom
    if times != 1:
        quotient = quotient * F.lit(times)
    return F.round(quotient, digits)


def pct(top: Column | str, bottom: Column | str, digits: int = 2) -> Column:
    return ratio(top, bottom, digits, times=100)


def change_pct(now: Column | str, before: Column | str) -> Column:
    return pct(col(now) - col(before), before)


def exact_avg(c: Column | str, digits: int = 2) -> Column:
    """Aggregate mean from sum and count.

    ``avg`` over a decimal is itself rounded to four extra digits, which would
    round twice; sum over count carries the full quotient.
    """
    return ratio(F.sum(col(c)), F.count(col(c)), digits)
