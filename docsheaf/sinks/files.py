"""File sinks, and the relational one through Spark's JDBC writer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columntypes import as_text


def text_cells(df: DataFrame) -> DataFrame:
    """Every cell as the text a flat file shows."""
    return df.select(*[
        as_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields
    ])


def json_cells(df: DataFrame) -> DataFrame:
    """Cells as JSON keeps them: times and fractions become text."""
    as_texts = (T.TimestampNTZType, T.TimestampType, T.DateType, T.FractionalType)
    return df.select(*[
        (as_text(F.col(f"`{f.name}`"), f.dataType) if isinstance(f.dataType, as_texts)
         else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ])


def write_csv(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """One folder per table: header, rows, null as an empty field."""
    options = {"header": True, "nullValue": "", "emptyValue": '""', "escape": '"'}
    text_cells(df).write.mode(mode).options(**options).csv(folder)


def read_csv(spark, folder: str, schema: str) -> DataFrame:
    """Read a folder back with a declared schema."""
    options = {"header": True, "escape": '"', "multiLine": False}
    return spark.read.options(**options).schema(schema).csv(folder)


def write_json(df: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    json_cells(df).write.mode(mode).option("ignoreNullFields", False).json(folder)


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = 1_000, **options) -> None:
    """Append to a relational table; for a keyed update merge before writing.

    Each partition writes over its own connection, so ``numPartitions`` in
    ``options`` is what bounds the load on the database.
    """
    writer = df.write.format("jdbc").mode("append").options(url=url, dbtable=table, **options)
    writer.option("batchsize", batch_rows).save()
