"""Lookups in side tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cell_text, unwrap_single


def last_per_source(mapping: DataFrame, order: str) -> DataFrame:
    """A mapping (name, source, destination) with the last entry per source."""
    last = F.max(F.struct(F.col(order).alias("at"), "destination")).getField("destination")
    return mapping.groupBy("name", "source").agg(last.alias("destination"))


def map_values(df: DataFrame, mapping: DataFrame, name: str, column: str, out: str) -> DataFrame:
    """Replace values by a named mapping; what is not mapped stays as it is.

    An empty destination counts as not mapped. Of several entries for one
    source the last counts: by the column ``position`` if the mapping has one,
    else the greatest. So a row is never multiplied. A list of one is mapped
    as its element, a longer one stays the text of its cell.
    """
    entries = mapping.where(F.col("name") == name)
    order = "position" if "position" in mapping.columns else "destination"
    side = last_per_source(entries, order).select(
        F.col("source").cast("string").alias("__source"), F.nullif("destination", F.lit("")).alias("__to")
    )
    dtype = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(dtype, T.ArrayType):
        key, shown = unwrap_single(value).cast("string"), cell_text(value, dtype)
    else:
        key = shown = value.cast("string")
    joined = df.join(side, key == F.col("__source"), "left")
    return joined.select(*df.columns, F.coalesce("__to", shown).alias(out))


def look_up(df: DataFrame, side: DataFrame, key: Column, side_key: str, fields: dict[str, str]) -> DataFrame:
    """Left lookup of ``fields`` (side column → new column); null where absent.

    ``side`` holds one row per key.
    """
    picked = side.select(F.col(side_key).alias("__key"), *[F.col(c).alias(n) for c, n in fields.items()])
    joined = df.join(picked, key == F.col("__key"), "left")
    return joined.select(*df.columns, *fields.values())


def unknown_references(df: DataFrame, key: str, side: DataFrame, side_key: str) -> DataFrame:
    """How often each value of ``key`` that the side table lacks is referred to.

    Counting comes first, so a value that is missing everywhere costs one row
    per task.
    """
    used = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("unknown")).agg(
        F.count(F.lit(1)).alias("uses")
    )
    return used.join(side.select(F.col(side_key).alias("unknown")), "unknown", "left_anti")
