"""The register of queries, and the documents they are asked on.

Every query runs on whole tables. Its SQL, where there is one, states the same
result for DuckDB; columns have the same names on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import DocTable, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build
    return add


def documents(spark: SparkSession, d: str) -> DataFrame:
    """Text documents as nested ones: the lines of a text are its children.

    A list never exceeds its own row, so no rows are gathered to build it. A
    short line has no ``note``; a document of one short line has no ``remarks``.
    """
    line = lambda x: F.struct(
        x.alias("text"), F.length(x).alias("size"),
        F.when(F.length(x) > 60, F.substring(x, 1, 8)).alias("note"),
    )
    lines = F.transform(F.split("text", "\n"), line)
    attributes = F.struct(
        F.concat(F.lit("c"), "doc_id").alias("@case_id"), F.col("source").alias("#text")
    )
    return load(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("domain"),
        F.struct(F.col("lang").alias("name"), attributes.alias("case"), lines.alias("lines")).alias("form"),
        F.struct(F.concat(F.lit("u"), "n_chars").alias("userID")).alias("metadata"),
        F.filter(lines, lambda x: x.getField("size") > 100).alias("remarks"),
    )


def forms(spark: SparkSession, d: str, *root: str) -> DocTable:
    return DocTable(documents(spark, d), "form", root)


# The same lines for DuckDB: one row per line with its zero-based place.
LINES = """
lines AS (
  SELECT doc_id, lang, source, n_chars, pos, parts[pos + 1] AS line
  FROM (SELECT doc_id, lang, source, n_chars, string_split(text, chr(10)) AS parts,
               unnest(range(len(string_split(text, chr(10))))) AS pos
        FROM documents)
)"""


def types(spark: SparkSession, d: str) -> DataFrame:
    """Location types, as found in the tables of places."""
    def level(table, uri, code, name, parent):
        return load(spark, d, table).select(
            F.lit(uri).alias("resource_uri"), F.lit(code).alias("code"), F.lit(name).alias("name"),
            F.lit(parent).cast("string").alias("parent"), F.lit(code == "health-site").alias("administrative"),
        ).distinct()
    return (
        level("region", "t/1", "world-region", "Region", None)
        .unionByName(level("nation", "t/2", "country", "Country", "t/1"))
        .unionByName(level("supplier", "t/3", "health-site", "Site", "t/2"))
    )


def places(spark: SparkSession, d: str) -> DataFrame:
    """Locations: regions over nations over suppliers."""
    def level(table, key, letter, name, kind, parent):
        return load(spark, d, table).select(
            F.concat(F.lit(letter + "-"), key).alias("id"),
            F.concat(F.lit(letter + "/"), key).alias("resource_uri"),
            F.concat(F.lit(letter), key).alias("location_id"),
            F.col(name).alias("name"), F.lit(kind).alias("location_type"), parent.alias("parent"),
        )
    return (
        level("region", "r_regionkey", "r", "r_name", "t/1", F.lit(None).cast("string"))
        .unionByName(level("nation", "n_nationkey", "n", "n_name", "t/2", F.concat(F.lit("r/"), "n_regionkey")))
        .unionByName(level("supplier", "s_suppkey", "s", "s_name", "t/3", F.concat(F.lit("n/"), "s_nationkey")))
    )


PLACES = """
places AS (
  SELECT 'r-' || r_regionkey AS id, 'r/' || r_regionkey AS resource_uri, 'r' || r_regionkey AS location_id,
         r_name AS name, 't/1' AS location_type, CAST(NULL AS VARCHAR) AS parent FROM region
  UNION ALL SELECT 'n-' || n_nationkey, 'n/' || n_nationkey, 'n' || n_nationkey, n_name, 't/2',
         'r/' || n_regionkey FROM nation
  UNION ALL SELECT 's-' || s_suppkey, 's/' || s_suppkey, 's' || s_suppkey, s_name, 't/3',
         'n/' || s_nationkey FROM supplier
), types AS (
  SELECT DISTINCT 't/1' AS resource_uri, 'world-region' AS code, 'Region' AS name,
         CAST(NULL AS VARCHAR) AS parent, false AS administrative FROM region
  UNION ALL SELECT DISTINCT 't/2', 'country', 'Country', 't/1', false FROM nation
  UNION ALL SELECT DISTINCT 't/3', 'health-site', 'Site', 't/2', true FROM supplier
)"""
