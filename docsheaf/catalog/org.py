"""Queries over lookups, hierarchies and the organisation roll-up."""

from pyspark.sql import functions as F

from ..operators import (
    ancestor_columns, ancestors, last_per_source, level_depths, locations_table, look_up,
    map_values, ordered_codes, roll_up, unknown_references, users_table,
)
from ..operators.hierarchy import clean_name
from ..sources.tables import load
from .base import PLACES, places, query, types


@query("org_rollup", """
SELECT r_name, count(*) AS n FROM orders
LEFT JOIN (customer LEFT JOIN (nation LEFT JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey)
  ON o_custkey = c_custkey
GROUP BY r_name""")
def org_rollup(spark, d):
    nations = look_up(load(spark, d, "nation"), load(spark, d, "region"), F.col("n_regionkey"),
                      "r_regionkey", {"r_name": "r_name"})
    return roll_up(
        load(spark, d, "orders"), "o_custkey", load(spark, d, "customer"), "c_custkey", "c_nationkey",
        nations, "n_nationkey", "r_name",
    ).select("r_name", F.col("n").cast("bigint").alias("n"))


def mapping(spark, d):
    """Names for order states, made from the orders; the later entry per source counts."""
    states = load(spark, d, "orders").select(F.col("o_orderstatus").alias("source")).distinct()
    first = states.select(
        F.lit("status").alias("name"), "source", F.concat(F.lit("old "), "source").alias("destination"),
        F.lit(1).alias("row"))
    second = states.select(
        F.lit("status").alias("name"), "source",
        F.when(F.col("source") == "F", "finished").when(F.col("source") == "O", "").alias("destination"),
        F.lit(2).alias("row")).where(F.col("destination").isNotNull())
    return last_per_source(first.unionByName(second), "row")


@query("map_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'O'
       ELSE 'old ' || o_orderstatus END AS label FROM orders""")
def _(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return map_values(orders, mapping(spark, d), "status", "o_orderstatus", "label").select("o_orderkey", "label")


@query("type_lookup", f"""
WITH {PLACES}
SELECT p.resource_uri, t.code AS type_code, t.administrative FROM places p LEFT JOIN types t ON t.resource_uri = p.location_type""")
def _(spark, d):
    found = look_up(places(spark, d), types(spark, d), F.col("location_type"), "resource_uri",
                    {"code": "type_code", "administrative": "administrative"})
    return found.select("resource_uri", "type_code", "administrative")


@query("part_lookup", """
SELECT l_orderkey, l_linenumber, p_brand, p_retailprice FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def _(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    found = look_up(lines, load(spark, d, "part"), F.col("l_partkey"), "p_partkey",
                    {"p_brand": "p_brand", "p_retailprice": "p_retailprice"})
    return found.drop("l_partkey")


CLOSURE = f"""
WITH RECURSIVE {PLACES}, climb AS (
  SELECT p.resource_uri AS uri, t.code, p.location_id AS ancestor_id, 0 AS distance, p.parent AS up
  FROM places p JOIN types t ON t.resource_uri = p.location_type
  UNION ALL
  SELECT c.uri, t.code, p.location_id, c.distance + 1, p.parent
  FROM climb c JOIN places p ON p.resource_uri = c.up JOIN types t ON t.resource_uri = p.location_type)
"""


@query("ancestors", CLOSURE + "SELECT uri, code, ancestor_id, distance FROM climb")
def _(spark, d):
    return ancestors(places(spark, d), types(spark, d))


@query("ancestor_columns", CLOSURE + """
SELECT uri, max(ancestor_id) FILTER (code = 'health-site') AS health_site,
       max(ancestor_id) FILTER (code = 'country') AS country,
       max(ancestor_id) FILTER (code = 'world-region') AS world_region FROM climb GROUP BY uri""")
def _(spark, d):
    kinds = types(spark, d)
    return ancestor_columns(ancestors(places(spark, d), kinds), ordered_codes(kinds))


@query("level_depth", f"""
WITH RECURSIVE {PLACES}, climb AS (
  SELECT resource_uri, code, 0 AS depth FROM types WHERE parent IS NULL
  UNION ALL SELECT t.resource_uri, t.code, c.depth + 1 FROM types t JOIN climb c ON t.parent = c.resource_uri)
SELECT replace(c.code, '-', '_') AS level, c.depth, count(*) AS n_places
FROM climb c JOIN places p ON p.location_type = c.resource_uri GROUP BY 1, 2""")
def _(spark, d):
    depths = level_depths(types(spark, d)).select("resource_uri", clean_name(F.col("code")).alias("level"), "depth")
    per_type = places(spark, d).groupBy("location_type").agg(F.count(F.lit(1)).alias("n_places"))
    joined = per_type.join(depths, per_type.location_type == depths.resource_uri)
    return joined.select("level", "depth", "n_places")


@query("missing_refs", """
SELECT l_partkey AS unknown, count(*) AS uses FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#1') GROUP BY l_partkey""")
def _(spark, d):
    parts = load(spark, d, "part").where(F.col("p_brand") != "Brand#1")
    return unknown_references(load(spark, d, "lineitem"), "l_partkey", parts, "p_partkey")


@query("users_table", """
SELECT 'u' || c_custkey AS id, '0' || (100000 + c_custkey) AS default_phone_number,
       CASE WHEN c_custkey % 3 > 0 THEN lower(c_mktsegment) || c_custkey || '@example.org' END AS email,
       lower(c_mktsegment) AS first_name, 'g' || c_nationkey || ',' || 'g' || c_mktsegment AS groups,
       string_split(c_name, '#')[2] AS last_name, '0' || (100000 + c_custkey) || ',' || '0' || (200000 + c_custkey) AS phone_numbers,
       'user/' || c_custkey AS resource_uri, 'n' || c_nationkey AS location_id, 'n' || c_nationkey || ',' || 'm' || c_nationkey AS location_ids,
       CASE WHEN c_acctbal > 0 THEN 's' || c_nationkey END AS primary_case_sharing_id, c_mktsegment AS project, c_name AS username
FROM customer""")
def _(spark, d):
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    text = lambda prefix, value: F.concat(F.lit(prefix), value.cast("string"))
    phone = lambda start: text("0", start + key)
    docs = load(spark, d, "customer").select(
        text("u", key).alias("id"), phone(100000).alias("default_phone_number"),
        F.when(key % 3 > 0, F.concat(F.lower("c_mktsegment"), key.cast("string"), F.lit("@example.org"))).alias("email"),
        F.lower("c_mktsegment").alias("first_name"), F.array(text("g", nation), text("g", F.col("c_mktsegment"))).alias("groups"),
        F.get(F.split("c_name", "#"), F.lit(1)).alias("last_name"), F.array(phone(100000), phone(200000)).alias("phone_numbers"),
        text("user/", key).alias("resource_uri"), F.struct(
            text("n", nation).alias("location_id"), F.array(text("n", nation), text("m", nation)).alias("location_ids"),
            F.when(F.col("c_acctbal") > 0, text("s", nation)).alias("primary_case_sharing_id"),
            F.col("c_mktsegment").alias("project")).alias("user_data"),
        F.col("c_name").alias("username"),
    )
    return users_table(docs).withColumns({c: F.array_join(c, ",") for c in ("groups", "phone_numbers", "location_ids")})


@query("locations_table", CLOSURE + """
SELECT p.id, TIMESTAMP '2020-01-01 00:00:00' + INTERVAL 1 HOUR * length(p.id) AS created_at,
       CASE WHEN p.parent IS NOT NULL THEN 'd' || length(p.name) END AS domain, 'x-' || p.location_id AS external_id,
       TIMESTAMP '2021-06-01 12:30:00' + INTERVAL 1 DAY * length(p.name) AS last_modified,
       CAST(length(p.name) || '.25' AS VARCHAR) AS latitude, '{"p1":"' || p.name || '","n":' || length(p.id) || '}' AS location_data,
       p.location_id, p.location_type, '-' || length(p.id) || '.5' AS longitude,
       p.name, p.parent, p.resource_uri, lower(replace(p.name, ' ', '_')) AS site_code, t.administrative AS location_type_administrative,
       t.code AS location_type_code, t.name AS location_type_name, t.parent AS location_type_parent,
       a.health_site, a.country, a.world_region
FROM places p JOIN types t ON t.resource_uri = p.location_type
JOIN (SELECT uri, max(ancestor_id) FILTER (code = 'health-site') AS health_site,
             max(ancestor_id) FILTER (code = 'country') AS country,
             max(ancestor_id) FILTER (code = 'world-region') AS world_region FROM climb GROUP BY uri) a
  ON a.uri = p.resource_uri""")
def _(spark, d):
    long, wide = F.length("name"), F.length("id")
    moment = lambda start, unit, n: F.date_format(F.timestamp_add(unit, n, F.lit(start).cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = lambda value: value.cast("string")
    full = places(spark, d).withColumns({
        "created_at": moment("2020-01-01 00:00:00", "HOUR", wide), "last_modified": moment("2021-06-01 12:30:00", "DAY", long),
        "domain": F.when(F.col("parent").isNotNull(), F.concat(F.lit("d"), text(long))), "external_id": F.concat(F.lit("x-"), "location_id"),
        "latitude": F.concat(text(long), F.lit(".25")), "longitude": F.concat(F.lit("-"), text(wide), F.lit(".5")),
        "location_data": F.struct(F.col("name").alias("p1"), wide.alias("n")), "site_code": F.lower(F.replace("name", F.lit(" "), F.lit("_")))})
    return locations_table(full, types(spark, d))
