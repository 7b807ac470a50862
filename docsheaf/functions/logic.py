"""Truth, emptiness and defaults as Column expressions.

There are two notions of "empty". The narrow one is null or a list without
elements, so an empty text and a zero are values. The wide one also counts an
empty text, zero and false as nothing. Each function says which it uses.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts that count as true.
TRUE_TEXTS = ("true", "t", "1")


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def is_empty(value: Column, dtype: T.DataType | None = None) -> Column:
    """Null, or a list or map without elements (narrow emptiness)."""
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return value.isNull() | (F.size(value) == 0)
    return value.isNull()


def is_truthy(value: Column, dtype: T.DataType) -> Column:
    """Wide truth by type; never null."""
    if isinstance(dtype, T.StringType):
        held = value != ""
    elif isinstance(dtype, T.BinaryType):
        held = F.length(value) > 0
    elif isinstance(dtype, T.BooleanType):
        held = value
    elif isinstance(dtype, T.NumericType):
        held = value != 0
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        held = F.size(value) > 0
    else:
        held = value.isNotNull()
    return F.coalesce(held, F.lit(False))


def first_present(*values: Column, dtype: T.DataType | None = None) -> Column:
    """First value that is not empty in the narrow sense; null if there is none."""
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        values = tuple(F.when(F.size(v) > 0, v) for v in values)
    return F.coalesce(*values)


def default_value(value: Column, fallback, dtype: T.DataType) -> Column:
    """``fallback`` where the value is nothing in the wide sense.

    A value that is no text meets a fallback of text as text.
    """
    if isinstance(fallback, str) and not isinstance(dtype, T.StringType):
        nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
        text = F.to_json(value) if nested else value.cast("string")
        return F.when(is_truthy(value, dtype), text).otherwise(F.lit(fallback))
    return F.when(is_truthy(value, dtype), value).otherwise(as_column(fallback))


def to_bool(value: Column) -> Column:
    """True for the texts in TRUE_TEXTS in any case; everything else is false."""
    return F.coalesce(F.lower(value.cast("string")).isin(*TRUE_TEXTS), F.lit(False))


def bool_to_int(value: Column) -> Column:
    return to_bool(value).cast("int")
