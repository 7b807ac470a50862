"""Rows from lists inside documents. All of these are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def child_rows(df: DataFrame, items: Column, name: str = "child") -> DataFrame:
    """One row per element, next to the document it came from."""
    return df.select("*", F.explode(items).alias(name))


def child_rows_at(df: DataFrame, items: Column, name: str = "child", position: str = "pos") -> DataFrame:
    """The same with the zero-based place of the element."""
    return df.select("*", F.posexplode(items).alias(position, name))


def child_or_root_rows(
    df: DataFrame, items: Column, name: str = "child", position: str = "pos"
) -> DataFrame:
    """One row per element, and one for a document that has none.

    On the latter ``position`` and the element are null: only fields of the
    document itself can be read, whatever the element's fields are called.
    """
    return df.select("*", F.posexplode_outer(items).alias(position, name))


def is_root_row(position: str = "pos") -> Column:
    return F.col(position).isNull()


def present_rows(df: DataFrame, items: Column, name: str, *steps: str) -> DataFrame:
    """One row per value at ``steps`` in the elements; elements without it give none."""
    value = F.col(name)
    for step in steps:
        value = value.getField(step)
    return child_rows(df, items, name).withColumn(name, value).where(F.col(name).isNotNull())


def named_scope(df: DataFrame, name: str) -> DataFrame:
    """All columns, and the whole row once more under a name."""
    return df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A name for a value that later columns can use."""
    return df.withColumn(name, value)
