"""Merging a batch into a table by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .columntypes import align


def key_of(df: DataFrame, key: str) -> Column:
    """The key column; a row without a key fails the job instead of being lost."""
    value = F.col(f"`{key}`")
    failure = F.raise_error(F.lit(f"row without a key in {key}")).cast(df.schema[key].dataType)
    return F.coalesce(value, failure).alias(key)


def only_once(df: DataFrame, key: str) -> DataFrame:
    """The same rows; a key that occurs twice fails the job.

    Grouped by the key, as the join of a merge is, so it adds no shuffle there.
    """
    others = [F.first(F.col(f"`{c}`")).alias(c) for c in df.columns if c != key]
    counted = df.groupBy(F.col(f"`{key}`")).agg(*others, F.count("*").alias("__times"))
    failure = F.raise_error(F.concat(F.lit(f"rows share the {key} "), F.col(f"`{key}`").cast("string"))).cast("boolean")
    return counted.where(F.when(F.col("__times") > 1, failure).otherwise(F.lit(True))).select(*df.columns)


def orderable(dtype: T.DataType) -> bool:
    """Whether values of a type can be compared."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def last_value(value: Column, dtype: T.DataType, order: Column) -> Column:
    """Aggregate: the non-null value of the greatest order, ties by value."""
    if orderable(dtype):
        pair = F.struct(order.alias("o"), value.alias("v"))
        return F.max(F.when(value.isNotNull(), pair)).getField("v")
    return F.max_by(value, F.when(value.isNotNull(), F.struct(order, F.to_json(value))))


def collapse(batch: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key: in each column the last value that is not null.

    Equal orders are settled by the greater value, so the outcome is the same
    whichever way the rows are split. Tasks reduce their own rows first.
    """
    def last(name: str) -> Column:
        return last_value(F.col(f"`{name}`"), batch.schema[name].dataType, order).alias(name)

    others = [last(c) for c in batch.columns if c != key]
    if not others:
        return batch.select(key_of(batch, key)).distinct()
    return batch.groupBy(key_of(batch, key)).agg(*others).select(*batch.columns)


def upsert(
    target: DataFrame, batch: DataFrame, key: str, strict: bool = False, time: str | None = None
) -> DataFrame:
    """``target`` with ``batch`` merged in; nulls in the batch change nothing.

    Rows only the target has stay. Both sides hold one row per key, so no key
    of the join can be hot. Columns are added and widened as needed. With
    ``time`` a row of the batch that is older than the target's only fills
    nulls, so batches may arrive in any order.
    """
    held, new = align(target, batch, strict)
    new = new.withColumn(key, key_of(new, key))
    t, b = held.alias("t"), new.alias("b")
    on = F.col(f"t.`{key}`") == F.col(f"b.`{key}`")
    stale = F.lit(False)
    if time is not None:
        stale = F.coalesce(F.col(f"t.`{time}`") > F.col(f"b.`{time}`"), F.lit(False))

    def merged(name: str) -> Column:
        old, fresh = F.col(f"t.`{name}`"), F.col(f"b.`{name}`")
        if time is None:
            return F.coalesce(fresh, old).alias(name)
        return F.when(stale, F.coalesce(old, fresh)).otherwise(F.coalesce(fresh, old)).alias(name)

    return t.join(b, on, "full_outer").select(*[merged(c) for c in held.columns])


def append(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts; their column names must be the same."""
    out = parts[0]
    for part in parts[1:]:
        if part.columns != out.columns:
            raise ValueError(f"columns differ: {out.columns} and {part.columns}")
        out = out.unionByName(part)
    return out
