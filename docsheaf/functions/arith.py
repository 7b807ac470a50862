"""Arithmetic. Comparison is left to Column operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .convert import to_number

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def add(left: Column, right: Column, dtype: T.DataType | None = None) -> Column:
    """Sum of numbers; texts and lists are joined end to end.

    A number written in the program is added to the number that a text holds.
    """
    if isinstance(dtype, T.StringType) and isinstance(right, (int, float)):
        return to_number(left) + right
    if isinstance(dtype, (T.StringType, T.ArrayType)):
        return F.concat(left, right if isinstance(right, Column) else F.lit(right))
    return left + right


def subtract(left: Column, right: Column) -> Column:
    return left - right


def multiply(left: Column, right: Column) -> Column:
    return left * right


def floor_divide(left: Column, right: Column) -> Column:
    """Quotient rounded down, also for negative numbers; exact for whole ones.

    Floored division leaves a remainder with the sign of the divisor, so the
    truncated quotient of ``left - remainder`` is the floored one. Fractions
    take the way over ``floor``; the types tell which way a row goes.
    """
    whole = F.typeof(left).isin(*WHOLE_TYPES) & F.typeof(right).isin(*WHOLE_TYPES)
    a, b = left.try_cast("bigint"), right.try_cast("bigint")
    rest = F.try_mod(F.try_add(F.try_mod(a, b), b), b)
    exact = F.call_function("div", F.try_subtract(a, rest), F.nullif(b, F.lit(0)))
    return F.when(whole & (b != 0), exact).otherwise(F.floor(left / right))


def divide(left: Column, right: Column, lenient: bool = False) -> Column:
    """Quotient. Zero as divisor fails under ANSI mode, or is null if lenient."""
    return F.try_divide(left, right) if lenient else left / right
