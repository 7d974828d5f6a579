"""Sums of amounts times copies that neither round nor raise, whatever their digits.

An amount of up to 38 digits is cut into two limbs of 19. A limb times a bigint has at most 38 digits and is exact; it is cut again,
so that a row adds less than 2 * 10^19 to each of three limbs and 10^18 rows stay within a decimal. The limbs are plain
sums: they combine before the exchange, can be kept, and are added to those of later runs in any order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB = 19
LIMBS = ("top", "middle", "low")


def _base() -> Column:
    return F.lit(str(10**LIMB)).cast("decimal(20,0)")


def _cut(number: Column, rest: Column) -> Column:
    """``(number - rest) / base`` for a ``rest`` that leaves a multiple of the base; the quotient is whole, so nothing is rounded."""
    return ((number - rest).cast("decimal(38,0)") / _base()).cast("decimal(20,0)")


def limb_sums(value: Column, copies: Column, kind: T.DecimalType) -> Column:
    """Aggregate: the sum of ``value`` (a decimal of type ``kind``) times ``copies`` (whole numbers) as limbs.

    Rows in which either is NULL count nothing; limbs are NULL when all do.
    """
    # The sign is read from the text too: Spark's negation and abs round decimals to 34 digits, and a comparison with 0 to 37 places.
    shown = F.format_number(value, kind.scale)
    digits = F.substring(F.concat(F.lit("0" * 2 * LIMB), F.translate(shown, ",.-", "")), -2 * LIMB, 2 * LIMB)
    whole = copies.cast("decimal(19,0)")
    factor = F.when(shown.startswith("-"), -whole).otherwise(whole)
    high, low = (F.substring(digits, at, LIMB).cast("decimal(19,0)") * factor for at in (1, LIMB + 1))
    high_rest, low_rest = high % _base(), low % _base()
    parts = (_cut(high, high_rest), high_rest + _cut(low, low_rest), low_rest)
    return F.struct(*(F.sum(p.cast("decimal(38,0)")).alias(n) for n, p in zip(LIMBS, parts, strict=True)))


def added_limbs(limbs: Column) -> Column:
    """Aggregate: the limbs of all rows that ``limbs`` sums up."""
    return F.struct(*(F.sum(limbs[n]).alias(n) for n in LIMBS))


def _carried(limbs: Column, sign: Column) -> tuple[Column, Column, Column]:
    """Limbs times the sign, the lower two brought into [0, base)."""
    top, middle, low = (limbs[n] * sign for n in LIMBS)
    low_rest = F.pmod(low.cast("decimal(38,0)"), _base())
    middle = (middle + _cut(low, low_rest)).cast("decimal(38,0)")
    middle_rest = F.pmod(middle, _base())
    return (top + _cut(middle, middle_rest)).cast("decimal(38,0)"), middle_rest, low_rest


def limbs_text(limbs: Column, kind: T.DecimalType) -> Column:
    """The sum as text with the scale of ``kind``, of up to 76 digits; a value of more would take over 10^18 rows."""
    negative = _carried(limbs, F.lit(1).cast("decimal(1,0)"))[0] < 0
    top, middle, low = _carried(limbs, F.when(negative, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)"))
    digits = F.concat(top.cast("string"), *(F.lpad(part.cast("string"), LIMB, "0") for part in (middle, low)))
    # A digit before the point stays, whatever the scale.
    digits = F.regexp_replace(digits, rf"^0+(?=\d{{{kind.scale + 1}}})", "")
    size = F.length(digits)
    text = digits if not kind.scale else F.concat(F.substr(digits, F.lit(1), size - kind.scale), F.lit("."), F.substr(digits, size - kind.scale + 1))
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), text)


def limbs_decimal(limbs: Column, kind: T.DecimalType) -> Column:
    """The sum as a decimal of 38 digits and the scale of ``kind``; NULL where it has more (``limbs_text`` has them)."""
    return limbs_text(limbs, kind).try_cast(T.DecimalType(38, kind.scale))
