"""Sums that neither overflow on the way nor depend on the order of addition.

A value is split into limbs, whole numbers whose sums are exact; differences of such sums are exact
too. A frame's sum can so be taken as the difference of two running sums, whatever lies ahead.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

_WIDE = "decimal(38,0)"
_LOW_BITS = 32
# A double is a whole number of 62 bits, a second one for what is left, and counts of what is no number.
_LIMB_BITS = 62


def is_exact(kind: T.DataType) -> bool:
    """Whether sums of this type need no scale: whole numbers and decimals."""
    return isinstance(kind, (T.IntegralType, T.DecimalType))


def largest(rows: DataFrame, value: Column) -> float:
    """The largest finite magnitude, which sets the scale of doubles; 0 without one. Runs a Spark job."""
    magnitude = F.abs(value.cast("double"))
    found = rows.agg(F.max(F.when(~F.isnan(magnitude) & (magnitude < float("inf")), magnitude))).first()[0]
    return found or 0.0


def _factor(scale: float) -> float:
    """The power of two that lifts the largest magnitude just below 2^62."""
    bits = _LIMB_BITS - math.frexp(scale)[1] if scale else 0
    return math.ldexp(1.0, max(-1000, min(960, bits)))


def limbs(value: Column, kind: T.DataType, scale: float | None = None, wide: bool = False) -> list[Column]:
    """Limbs of ``value``, all zero for null. Doubles need ``scale``, the ``largest`` of all values.

    Whole numbers are two longs, of which 2^31 can be added, or with ``wide`` one decimal, for any number of
    rows. Of a double, bits below 2^-123 of the largest magnitude are dropped.
    """
    if isinstance(kind, T.IntegralType) and wide:
        return [F.coalesce(value.cast(_WIDE), F.lit(0).cast(_WIDE))]
    if isinstance(kind, T.IntegralType):
        value = value.cast("long")
        parts = [F.shiftright(value, _LOW_BITS), value.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))]
        return [F.coalesce(x, F.lit(0).cast("long")) for x in parts]
    if isinstance(kind, T.DecimalType):
        return [F.coalesce(value.cast(f"decimal(38,{kind.scale})"), F.lit(0).cast(f"decimal(38,{kind.scale})"))]
    value = value.cast("double")
    odd = [F.isnan(value), value == float("inf"), value == float("-inf")]
    raised = F.when(~(odd[0] | odd[1] | odd[2]), value * _factor(scale))
    whole = F.floor(raised)
    rest = F.floor((raised - whole.cast("double")) * 2.0**_LIMB_BITS)
    numbers = [F.coalesce(x.cast(_WIDE), F.lit(0).cast(_WIDE)) for x in (whole, rest)]
    return numbers + [F.coalesce(x.cast("long"), F.lit(0).cast("long")) for x in odd]


def joined(sums: list[Column], kind: T.DataType, scale: float | None = None) -> Column:
    """The sum that sums of limbs stand for, in the type that ``sum`` gives. A whole number beyond a long is an
    error with ANSI mode on or off."""
    if isinstance(kind, T.IntegralType):
        if len(sums) == 1:
            fits, whole = sums[0].between(-(1 << 63), (1 << 63) - 1), sums[0].try_cast("long")
        else:
            high, low = sums
            high = high + F.shiftright(low, _LOW_BITS)
            fits = high.between(-(1 << 63 - _LOW_BITS), (1 << 63 - _LOW_BITS) - 1)
            whole = F.shiftleft(high, _LOW_BITS).bitwiseOR(low.bitwiseAND(F.lit((1 << _LOW_BITS) - 1)))
        return F.when(fits, whole).otherwise(F.raise_error(F.lit("sum of a frame beyond 64 bits")).cast("long"))
    if isinstance(kind, T.DecimalType):
        return sums[0].cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})")
    whole, rest, nan, up, down = sums
    number = (whole.cast("double") + rest.cast("double") * 2.0**-_LIMB_BITS) / F.lit(_factor(scale))
    return (
        F.when((nan > 0) | ((up > 0) & (down > 0)), float("nan"))
        .when(up > 0, float("inf"))
        .when(down > 0, float("-inf"))
        .otherwise(number)
    )
