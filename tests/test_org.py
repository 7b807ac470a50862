"""Lookups, hierarchies and the organisation tables."""

import random

import pytest
from pyspark.sql import functions as F

from docsheaf.operators import (
    ancestor_columns, ancestors, last_per_source, level_depths, locations_table, map_values,
    ordered_codes, roll_up, unknown_references, users_table,
)
from test_paths import docs

TYPES = "resource_uri string, code string, parent string, name string, administrative boolean"
PLACES = "resource_uri string, location_id string, location_type string, parent string"


def types(spark):
    return spark.createDataFrame([
        ("t/1", "state", None, "State", True), ("t/2", "sub-county", "t/1", "Sub", True), ("t/3", "clinic", "t/2", "Clinic", False)], TYPES)


def tree(spark):
    return spark.createDataFrame([
        ("l/s", "S", "t/1", None), ("l/d", "D", "t/2", "l/s"), ("l/c", "C", "t/3", "l/d"),
        ("l/cc", "CC", "t/3", "l/c"), ("l/lost", "L", "t/3", "l/gone"), ("l/odd", "O", "t/9", "l/s"), ("l/under", "U", "t/3", "l/odd")], PLACES)


def test_depths(spark):
    assert {r["code"]: r["depth"] for r in level_depths(types(spark)).collect()} == {"state": 0, "sub-county": 1, "clinic": 2}
    assert ordered_codes(types(spark)) == ["clinic", "sub-county", "state"]
    looped = spark.createDataFrame([("a", "a", "b", "A", True), ("b", "b", "a", "B", True)], TYPES)
    with pytest.raises(ValueError, match="cycle"):
        ordered_codes(looped)


def test_closure(spark):
    closure = ancestors(tree(spark), types(spark))
    rows = sorted(tuple(r) for r in closure.where("uri in ('l/cc', 'l/lost', 'l/odd', 'l/under')").collect())
    assert rows == [
        ("l/cc", "clinic", "C", 1), ("l/cc", "clinic", "CC", 0), ("l/cc", "state", "S", 3), ("l/cc", "sub-county", "D", 2),
        ("l/lost", "clinic", "L", 0), ("l/under", "clinic", "U", 0)]
    wide = {r["uri"]: tuple(r)[1:] for r in ancestor_columns(closure, ["clinic", "sub-county", "state"]).collect()}
    assert wide["l/cc"] == ("C", "D", "S"), "of two ancestors on a level the farther counts"
    assert wide["l/lost"] == ("L", None, None) and "l/odd" not in wide


def test_cycle_of_places_fails(spark):
    looped = spark.createDataFrame([("a", "A", "t/1", "b"), ("b", "B", "t/1", "a")], PLACES)
    with pytest.raises(Exception, match="cycle"):
        ancestors(looped, types(spark)).collect()


def test_a_deep_tree(spark):
    rows = [(f"l/{i}", f"P{i}", "t/1", f"l/{i + 1}" if i < 69 else None) for i in range(70)]
    closure = ancestors(spark.createDataFrame(rows, PLACES), types(spark))
    assert closure.count() == 70 * 71 // 2 and closure.where("uri = 'l/0'").count() == 70


def test_closure_against_a_plain_walk(spark):
    random.seed(1)
    nodes = {f"n{i}": (f"n{random.randrange(i)}" if i and random.random() < 0.9 else None) for i in range(60)}
    df = spark.createDataFrame([(k, k.upper(), "t/1", p) for k, p in nodes.items()], PLACES)
    want = set()
    for k in nodes:
        at, n = k, 0
        while at is not None:
            want.add((k, "state", at.upper(), n))
            at, n = nodes[at], n + 1
    assert {tuple(r) for r in ancestors(df, types(spark)).collect()} == want


def test_locations(spark):
    places = docs(spark, "id string, created_at string, location_data struct<p1:string>, location_id string, "
                  "location_type string, name string, parent string, resource_uri string", {
        "id": "1", "created_at": "2020-04-01T21:57:26.403053Z", "location_data": {"p1": "x"}, "location_id": "S",
        "location_type": "t/1", "name": "state", "resource_uri": "l/s"}, {
        "id": "2", "location_id": "D", "location_type": "t/2", "name": "d", "parent": "l/s", "resource_uri": "l/d"})
    rows = {r["id"]: r for r in locations_table(places, types(spark)).collect()}
    assert str(rows["1"]["created_at"]) == "2020-04-01 21:57:26" and rows["1"]["location_data"] == '{"p1":"x"}'
    assert rows["2"]["state"] == "S" and rows["2"]["sub_county"] == "D" and rows["2"]["clinic"] is None
    assert rows["2"]["location_type_code"] == "sub-county" and rows["2"]["location_type_parent"] == "t/1"
    assert rows["2"]["site_code"] is None
    assert len(rows["1"].asDict()) == 18 + 3


def test_users(spark):
    users = docs(spark, "id string, username string, user_data struct<v_location_id:string,v_project:string>",
                 {"id": "u", "username": "n", "user_data": {"v_location_id": "L", "v_project": "P"}})
    out = users_table(users, prefix="v_")
    assert len(out.columns) == 13
    row = out.first()
    assert (row["id"], row["v_location_id"], row["v_project"], row["email"]) == ("u", "L", "P", None)


def test_mapping(spark):
    mapping = spark.createDataFrame(
        [("m", "a", "first", 1), ("m", "a", "last", 2), ("m", "b", None, 3), ("m", "1", "one", 4), ("other", "c", "no", 5)],
        "name string, source string, destination string, row int")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("1",)], "v string")
    out = map_values(df, last_per_source(mapping, "row"), "m", "v", "w")
    assert {r["v"]: r["w"] for r in out.collect()} == {"a": "last", "b": "b", "c": "c", None: None, "1": "one"}
    whole = map_values(spark.createDataFrame([(1,), (2,)], "v int"), last_per_source(mapping, "row"), "m", "v", "w")
    assert {r["v"]: r["w"] for r in whole.collect()} == {1: "one", 2: "2"}


def test_unknown_references(spark):
    df = spark.createDataFrame([("l/s",), ("l/x",), ("l/x",), (None,)], "parent string")
    assert [tuple(r) for r in unknown_references(df, "parent", tree(spark), "resource_uri").collect()] == [("l/x", 2)]


def test_roll_up(spark):
    facts = spark.createDataFrame([("u1",)] * 50 + [("u2",), ("u3",), ("nobody",), (None,)], "actor string")
    users = spark.createDataFrame([("u1", "S"), ("u2", "D"), ("u3", None)], "id string, place string")
    places = spark.createDataFrame([("S", "north"), ("D", "north")], "location_id string, region string")
    out = roll_up(facts, "actor", users, "id", "place", places, "location_id", "region")
    assert {r["region"]: r["n"] for r in out.collect()} == {"north": 51, None: 3}


def test_a_thousand_levels_take_eleven_rounds(spark, monkeypatch):
    from docsheaf.operators import hierarchy
    jumps = []
    plain = hierarchy._jumped
    monkeypatch.setattr(hierarchy, "_jumped", lambda rows, leads, span: jumps.append(span) or plain(rows, leads, span))
    rows = spark.range(1001).select(
        F.concat(F.lit("l/"), "id").alias("resource_uri"), F.concat(F.lit("p"), "id").alias("location_id"), F.lit("t/1").alias("location_type"),
        F.when(F.col("id") > 0, F.concat(F.lit("l/"), F.col("id") - 1)).alias("parent"))
    closure = ancestors(rows, types(spark))
    assert jumps == [1, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512]
    got = closure.agg(F.count("*").alias("n"), F.max("distance").alias("top"), F.countDistinct("uri", "distance").alias("pairs")).first()
    assert (got["n"], got["top"], got["pairs"]) == (1001 * 1002 // 2, 1000, 1001 * 1002 // 2)
    assert closure.where("cast(substring(uri, 3) as int) - cast(substring(ancestor_id, 2) as int) <> distance").isEmpty()


@pytest.mark.parametrize("length", [1, 2, 3, 5, 17])
def test_cycles_of_any_length_fail(spark, length):
    rows = [(f"l/{i}", f"P{i}", "t/1", f"l/{(i + 1) % length}") for i in range(length)] + [("l/below", "B", "t/1", "l/0"), ("l/top", "T", "t/1", None)]
    with pytest.raises(Exception, match="cycle"):
        ancestors(spark.createDataFrame(rows, PLACES), types(spark)).collect()
