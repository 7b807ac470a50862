"""Documents without a date: which of them are new or changed since the last run.

No range of dates holds them, so their content tells. A log beside the tables
keeps a hash for each of them, as the last run that took them found them. A run
computes the hashes of the documents that have no date now and goes on with
those that the log lacks or has otherwise. The log is Parquet that is only
appended to, after the tables are merged: a run that dies takes its documents
again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from ..sources.ranges import progress_date
from ..sources.tables import DocTable

LOG = "id string, mark bigint, number bigint"


def content_hash(doc: DocTable, columns: list[str]) -> Column:
    """Changes whenever a member that is read does; null and absent members count in their place."""
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.xxhash64(F.to_json(whole, {"ignoreNullFields": "false"}))


def marks(doc: DocTable, dates: list[Column], columns: list[str]) -> DataFrame:
    """(id, mark) of the documents without a date.

    Rows of one document are reduced inside the tasks; equal rows count once.
    """
    rows = doc.df.where(progress_date(dates).isNull())
    rows = rows.select(doc.member(doc.id_field).cast("string").alias("id"), content_hash(doc, columns).alias("hash")).distinct()
    return rows.groupBy("id").agg(F.xxhash64(F.bit_xor("hash"), F.count("hash")).alias("mark"))


class UndatedLog:
    """The hashes of the undated documents that one set of tables holds."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        self.spark, self.path = spark, f"{folder}/undated/{name}"

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(LOG).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def fresh(self, found: DataFrame) -> DataFrame:
        """(id, mark, number) of documents whose last mark is another, written down for the run."""
        held = self.rows()
        last = held.groupBy("id").agg(F.max(F.struct("number", "mark")).alias("m")).select(F.col("id").alias("held"), "m.mark")
        same = F.col("held").eqNullSafe(F.col("id")) & (found["mark"] == last["mark"])
        number = (held.agg(F.max("number")).first()[0] or 0) + 1
        new = found.join(last, same, "left_anti").withColumn("number", F.lit(number).cast("bigint"))
        path = fresh_dir(self.spark, "undated")
        new.write.parquet(path)
        return self.spark.read.schema(LOG).parquet(path)

    def append(self, fresh: DataFrame) -> None:
        fresh.write.mode("append").parquet(self.path)


def with_fresh(doc: DocTable, dated: DataFrame, dates: list[Column], fresh: DataFrame) -> DataFrame:
    """The documents of a range of dates, and those without a date that ``fresh`` names."""
    key = doc.member(doc.id_field).cast("string")
    undated = doc.df.where(progress_date(dates).isNull())
    names = fresh.select(F.col("id").alias("__fresh"))
    return dated.unionAll(undated.join(names, key.eqNullSafe(F.col("__fresh")), "left_semi"))
