"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir

SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, so that lost executors cost no recomputation of what was
    written, and several readers do not repeat the work.
    """
    path = fresh_dir(df.sparkSession, label)
    # Zstandard reuses its buffers; others hold native memory until the next garbage collection.
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; null for null."""
    return F.array_remove(F.split(text, SPACE), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(words(text)), F.lit(0)).cast("long")


def small_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Hand texts to Python in batches of at most ``rows``, so that long texts fit a worker."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def objects(values: list) -> pd.Series:
    """A column of lists or texts that keeps its kind when it is empty."""
    out = np.empty(len(values), object)
    for i, value in enumerate(values):
        out[i] = value
    return pd.Series(out, dtype=object)


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Ids as text: with a null among them, pandas would make whole numbers floating ones."""
    return df.withColumns({c: F.col(c).cast("string") for c in names})


def as_before(df: DataFrame, source: DataFrame, *names: str) -> DataFrame:
    """The types that the columns have in ``source``."""
    return df.withColumns({c: F.col(c).cast(source.schema[c].dataType) for c in names})


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text as DuckDB SQL, bit by bit."""
    byte = "list_reduce([xor(c, b)] || [0::BIGINT for _ in range(8)], lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"[ascii(c)::BIGINT for c in string_split({text}, '')]"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}), 4294967295)"
