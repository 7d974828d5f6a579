"""Division, growth and comparison with NULL in place of errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is 0 or either side is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def growth_rate(current: Column, prior: Column, kind: T.DataType | None = None) -> Column:
    """Relative change against ``prior``.

    ``kind`` is the type of both. Spark takes a digit off the scale of a widest decimal's
    difference; told that it is a decimal, the subtraction is exact, up to 37 digits (more raise an error).
    """
    if isinstance(kind, T.DecimalType):
        wide = T.DecimalType(37, kind.scale)
        return safe_divide(current.cast(wide) - prior.cast(wide), prior)
    return safe_divide(current - prior, prior)


def scaled(value: Column, copies: Column, kind: T.DataType) -> Column:
    """``value``, of type ``kind``, times a whole number of copies below a billion.

    A decimal keeps its scale: every digit of it, up to 28 in all (more raise an error), where the product with a
    bigint would be rounded. Other types are multiplied as they are.
    """
    if isinstance(kind, T.DecimalType):
        return value.cast(T.DecimalType(28, min(kind.scale, 28))) * copies.cast("decimal(9,0)")
    return value * copies


def least_strict(a: Column, b: Column) -> Column:
    """Smaller of two values; NULL when either is NULL (Spark's ``least`` skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))
