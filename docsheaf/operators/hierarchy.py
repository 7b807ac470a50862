"""Trees of places: depths, ancestors and one column per level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

def clean_name(code: Column) -> Column:
    """A level code as a column name."""
    return F.regexp_replace(code, "-", "_")


def level_depths(types: DataFrame, key: str = "resource_uri", parent: str = "parent") -> DataFrame:
    """Each type with its depth below the top; a top level has depth 0.

    Types are few, as each becomes a column, so a recursive query holds them.
    A type that no top level leads to, be it in a cycle or below an unknown
    parent, has a null depth, so the query always ends.
    """
    return types.sparkSession.sql(f"""
        WITH RECURSIVE levels(uri, depth) AS (
            SELECT `{key}`, 0 FROM {{types}} WHERE `{parent}` IS NULL
            UNION ALL
            SELECT t.`{key}`, l.depth + 1 FROM levels l JOIN {{types}} t ON t.`{parent}` = l.uri
        )
        SELECT t.*, l.depth FROM {{types}} t LEFT JOIN levels l ON t.`{key}` = l.uri
    """, types=types)


def ordered_codes(types: DataFrame, code: str = "code") -> list[str]:
    """Level codes, deepest first. Each names a column, so they are as few as columns are."""
    rows = level_depths(types).select(code, "depth").collect()
    lost = [r[0] for r in rows if r["depth"] is None]
    if lost:
        raise ValueError(f"levels in a cycle or below an unknown one: {', '.join(map(str, lost))}")
    return [r[0] for r in sorted(rows, key=lambda r: (-r["depth"], r[0]))]


def ancestors(places: DataFrame, types: DataFrame) -> DataFrame:
    """(uri, code, ancestor_id, distance) for every place and each place above it.

    A place is its own ancestor at distance 0. The climb ends at a top place,
    at a parent that is not in the table and at a place of unknown type.

    The rows at distance 2^k are the jumps of round k: behind each ancestor at
    distance 1 to 2^k they add the one 2^k farther on. So one join doubles the
    reach, and a tree of a thousand levels takes eleven. A jump leads to one
    place, so rows are never multiplied, and adaptive execution splits an
    ancestor that many places share. Each round is written down, which bounds
    the plan; the first four levels, more than most trees have, are one round.
    A place that meets itself on its way up is in a cycle, and fails.
    """
    known = types.select(F.col("resource_uri").alias("__type"), F.col("code"))
    nodes = durable(places.join(known, F.col("location_type") == F.col("__type")).select(
        F.col("resource_uri").alias("uri"), F.col("parent").alias("__up"), "code",
        F.col("location_id").alias("ancestor_id"),
    ))
    own = nodes.select("uri", F.col("uri").alias("__at"), "code", "ancestor_id", F.lit(0).alias("distance"))
    parents = nodes.where(F.col("__up").isNotNull()).select("uri", F.col("__up").alias("__at"), F.lit(0).alias("distance"))
    one = _jumped(parents, own, 1)
    two = _jumped(one, one, 1)
    part = durable(one.unionByName(two).unionByName(_jumped(one.unionByName(two), two, 2)))
    closure, reach = own.unionByName(part), 4
    while part.agg(F.max("distance")).first()[0] == reach:
        part = durable(_jumped(closure.where("distance > 0"), part.where(F.col("distance") == reach), reach))
        closure, reach = closure.unionByName(part), 2 * reach
    return closure.drop("__at")


def _jumped(rows: DataFrame, jumps: DataFrame, span: int) -> DataFrame:
    """Each row's place ``__at`` replaced by the one that its jump leads to."""
    leads = jumps.select(F.col("uri").alias("__from"), F.col("__at").alias("__to"), "code", "ancestor_id")
    found = rows.select("uri", "__at", "distance").join(leads, F.col("__at") == F.col("__from"))
    failure = F.raise_error(F.concat(F.lit("places form a cycle at "), "uri")).cast("int")
    distance = F.when(F.col("uri") == F.col("__to"), failure).otherwise((F.col("distance") + span).cast("int"))
    return found.select("uri", F.col("__to").alias("__at"), "code", "ancestor_id", distance.alias("distance"))


def ancestor_columns(closure: DataFrame, codes: list[str]) -> DataFrame:
    """One row per place and one column per level with the ancestor's id.

    Of two ancestors on one level the farther one counts. One aggregate per
    level, so a single partial and final aggregation does it.
    """
    farthest = [
        F.max(F.when(F.col("code") == c, F.struct("distance", "ancestor_id")))
        .getField("ancestor_id").alias(c.replace("-", "_"))
        for c in codes
    ]
    return closure.groupBy("uri").agg(*farthest)
