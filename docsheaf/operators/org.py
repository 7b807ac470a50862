"""The organisation dimension: users, places and roll-ups over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import field_or_null, to_datetime, to_json_text
from ..session import durable
from .hierarchy import ancestor_columns, ancestors, ordered_codes
from .lookup import look_up

# The output columns of the two tables.
USER_COLUMNS = (
    "id", "default_phone_number", "email", "first_name", "groups", "last_name",
    "phone_numbers", "resource_uri",
)
USER_DATA_COLUMNS = ("location_id", "location_ids", "primary_case_sharing_id", "project")
LOCATION_COLUMNS = (
    "id", "created_at", "domain", "external_id", "last_modified", "latitude",
    "location_data", "location_id", "location_type", "longitude", "name", "parent",
    "resource_uri", "site_code",
)
LOCATION_TYPE_COLUMNS = ("administrative", "code", "name", "parent")
DATE_COLUMNS = ("created_at", "last_modified")

# Names no export may write to.
USERS_TABLE = "org_users"
LOCATIONS_TABLE = "org_locations"
RESERVED_TABLES = (USERS_TABLE, LOCATIONS_TABLE)


def users_table(users: DataFrame, prefix: str = "") -> DataFrame:
    """User documents as a flat table.

    ``prefix`` stands before the vendor's own fields in ``user_data`` and
    before the columns made from them. A field that is absent gives null.
    """
    schema = users.schema
    plain = [field_or_null(schema, c).alias(c) for c in USER_COLUMNS]
    own = [
        field_or_null(schema, "user_data", prefix + c).alias(prefix + c) for c in USER_DATA_COLUMNS
    ]
    return users.select(*plain, *own, field_or_null(schema, "username").alias("username"))


def locations_table(places: DataFrame, types: DataFrame) -> DataFrame:
    """Location documents with their type's details and one column per level."""
    types = durable(types)  # few rows, used three times
    schema = places.schema
    columns = []
    for name in LOCATION_COLUMNS:
        value = field_or_null(schema, name)
        if name in DATE_COLUMNS:
            value = to_datetime(value)
        elif name == "location_data":
            dtype = schema[name].dataType if name in schema.names else T.StringType()
            value = to_json_text(value, dtype)
        columns.append(value.alias(name))
    flat = places.select(*columns)
    described = look_up(
        flat, types, F.col("location_type"), "resource_uri",
        {c: f"location_type_{c}" for c in LOCATION_TYPE_COLUMNS},
    )
    levels = ancestor_columns(ancestors(places, types), ordered_codes(types))
    joined = described.join(levels, F.col("resource_uri") == F.col("uri"), "left")
    return joined.drop("uri")


def roll_up(
    facts: DataFrame, actor: str, users: DataFrame, user_key: str, user_place: str,
    places: DataFrame, place_key: str, level: str,
) -> DataFrame:
    """Count facts per level: facts LEFT JOIN (users LEFT JOIN places).

    The facts are counted per actor before any join. So the join moves one row
    per actor and task, not the facts, and an actor with a third of all facts
    weighs no more than any other.
    """
    per_actor = facts.groupBy(F.col(actor).alias("__actor")).agg(F.count(F.lit(1)).alias("__n"))
    placed = look_up(
        users.select(F.col(user_key).alias("__user"), F.col(user_place).alias("__place")),
        places, F.col("__place"), place_key, {level: level},
    )
    joined = per_actor.join(placed, F.col("__actor") == F.col("__user"), "left")
    return joined.groupBy(level).agg(F.sum("__n").alias("n"))
