"""A keyed Parquet table that is merged into, by Spark's own partition overwrite.

Rows lie in ``table_part=<n>`` folders by a hash of their key, so the table is
plain partitioned Parquet for anyone who reads it. A merge reads the parts that
its batch has keys for and overwrites just these (dynamic partition overwrite).
A merge may be repeated at will: it leads to the same rows.

What Spark's overwrite is, this is: there must be one writer at a time, readers
should wait for it, and a driver that dies while finished parts are moved in
place can leave a part in the staging folder. Where a catalog has tables that
support MERGE, ``DataFrame.mergeInto`` gives transactions; ``upsert`` needs
neither.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columntypes import align
from ..operators.merge import key_of, only_once, upsert
from ..session import fresh_dir

PART = "table_part"
PROPERTIES = "_properties"  # Spark's readers pass over names with an underscore


class StoredTable:
    """``parts`` is the number of hash parts by key; 1 keeps the table whole."""

    def __init__(self, spark: SparkSession, path: str, key: str = "id", parts: int = 1):
        if parts < 1:
            raise ValueError("a table has at least one part")
        self.spark, self.path, self.key, self.parts = spark, path.rstrip("/"), key, parts

    def _schema(self) -> T.StructType | None:
        """The table's columns; None where there is no table yet."""
        try:
            row = self.spark.read.text(f"{self.path}/{PROPERTIES}", wholetext=True).first()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        held = json.loads(row[0])
        if held["parts"] != self.parts:
            raise ValueError(f"{self.path} has {held['parts']} parts, not {self.parts}")
        return T.StructType.fromJson(held["schema"])

    def _keep(self, schema: T.StructType) -> None:
        text = json.dumps({"parts": self.parts, "schema": json.loads(schema.json())})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/{PROPERTIES}")

    def _part_of(self) -> Column:
        return F.pmod(F.xxhash64(F.col(f"`{self.key}`").cast("string")), F.lit(self.parts)).cast("int")

    def _scan(self, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(self.path)

    def _write(self, rows: DataFrame, whole: bool = False) -> None:
        # Adaptive execution sizes the files: big parts are split over tasks, small ones share a task.
        placed = rows.withColumn(PART, self._part_of()).hint("rebalance", PART)
        mode = "static" if whole else "dynamic"
        placed.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PART).parquet(self.path)

    def exists(self) -> bool:
        return self._schema() is not None

    def read(self) -> DataFrame:
        """All rows, in one scan."""
        schema = self._schema()
        if schema is None:
            raise FileNotFoundError(self.path)
        return self._scan(schema).drop(PART)

    def replace(self, rows: DataFrame) -> None:
        """Make ``rows``, which may come from the table itself, the whole content."""
        schema, path = rows.schema, fresh_dir(self.spark, "replace")
        rows.write.parquet(path)
        rows = self.spark.read.schema(schema).parquet(path)
        held = self._schema()
        left = _numbers(rows.select(self._part_of().alias(PART)))
        gone = held is not None and set(_numbers(self._scan(held).select(PART))) - set(left)
        self._write(rows, whole=bool(gone))
        self._keep(schema)

    def merge(self, batch: DataFrame, strict: bool = False, time: str | None = None, optional: list[str] = ()) -> None:
        """Merge a batch that holds one row per key; ``time`` is as for ``upsert``.

        A batch with two rows of one key, or a row without a key, fails before
        anything is touched. ``optional`` columns that the table lacks are added
        with the first batch that has a value for them.

        Only the parts with keys of the batch are read and rewritten, unless a
        column changes its type: that concerns every row of the table.
        """
        schema, found = self._schema(), Observation()
        path, kept = fresh_dir(self.spark, "batch"), batch.schema
        # Written once: its parts and its columns' values are counted on the way.
        batch = only_once(batch.withColumn(self.key, key_of(batch, self.key)), self.key)
        values = [F.count(F.col(f"`{c}`")).alias(f"v{n}") for n, c in enumerate(optional)]
        batch.observe(found, F.collect_set(self._part_of()).alias("parts"), *values).write.parquet(path)
        seen = found.get
        new = [c for n, c in enumerate(optional) if not seen[f"v{n}"] and (schema is None or c not in schema.names)]
        rows = batch = self.spark.read.schema(kept).parquet(path).drop(*new)
        if schema is not None:
            target = self._scan(schema)
            held, _ = align(target.drop(PART), batch, strict)
            if not any(_rewritten(f.dataType, held.schema[f.name].dataType) for f in schema.fields):
                target = target.where(F.col(PART).isin(seen["parts"]))
            rows = upsert(target.drop(PART), batch, self.key, strict, time)
        self._write(rows)
        if schema != rows.schema:
            self._keep(rows.schema)


def _rewritten(old: T.DataType, new: T.DataType) -> bool:
    """Whether files of the old type must be rewritten; a wider integer reads them."""
    return old != new and not (isinstance(old, T.IntegralType) and isinstance(new, T.IntegralType))


def _numbers(parts: DataFrame) -> list[int]:
    return [r[0] for r in parts.distinct().collect()]
