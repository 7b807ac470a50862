"""What a sink asks of a table, checked in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .org import RESERVED_TABLES

# Longest column name by target system.
NAME_LIMITS = {"postgres": 63, "mysql": 64, "mssql": 128, "oracle": 128}
# Fixed value: the column every keyed table must have.
REQUIRED = ("id",)


class ContractError(ValueError):
    """An export that a sink cannot take."""


def check_names(table: str, columns: list[str], target: str | None = None, required=REQUIRED) -> None:
    """Checks that need no data; raises ContractError."""
    if table in RESERVED_TABLES:
        raise ContractError(f"table name {table} is reserved")
    missing = [c for c in required if c not in columns]
    if missing:
        raise ContractError(f"table {table} lacks required columns: {', '.join(missing)}")
    if target:
        if target not in NAME_LIMITS:
            raise ContractError(f"unknown target {target}")
        long = [c for c in columns if len(c) > NAME_LIMITS[target]]
        if long:
            raise ContractError(
                f"table {table}: names over {NAME_LIMITS[target]} characters: {', '.join(long)}"
            )


def contract_report(df: DataFrame, key: str = "id", table: str = "", target: str = "postgres") -> DataFrame:
    """One row with what a sink may object to.

    Rows, null keys, keys used more than once, names that are too long for the
    target, and whether the table's name is reserved. Keys are counted inside
    tasks first.
    """
    per_key = df.groupBy(F.col(f"`{key}`").alias("k")).agg(F.count(F.lit(1)).alias("c"))
    zero = F.lit(0).cast("bigint")
    long = [c for c in df.columns if len(c) > NAME_LIMITS[target]]
    return per_key.agg(
        F.coalesce(F.sum("c"), zero).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("c"))), zero).alias("null_keys"),
        F.count_if(F.col("k").isNotNull() & (F.col("c") > 1)).alias("repeated_keys"),
    ).withColumns({
        "long_names": F.lit(len(long)).cast("bigint"), "reserved": F.lit(table in RESERVED_TABLES),
    })


def width_profile(df: DataFrame) -> DataFrame:
    """One row: the longest text in each column."""
    return df.agg(*[F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(c) for c in df.columns])
