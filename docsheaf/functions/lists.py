"""Functions over list cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


VARIANTS = T.ArrayType(T.VariantType())


def variant_key(value: Column) -> Column:
    """JSON text that is the same for equal variants: members by name, 1.0 as 1."""
    number = F.schema_of_variant(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    exact = F.regexp_replace(F.try_variant_get(value, "$", "decimal(38,18)").cast("string"), r"\.?0+$", "")
    return F.when(number, F.coalesce(exact, F.to_json(value))).otherwise(F.to_json(value))


def _variant_distinct(items: Column) -> Column:
    """Distinct variants: nulls, then booleans, numbers and texts in ascending order, then the rest by their JSON.

    Elements are compared by their keys, which are found equal by hashing.
    """
    first = lambda key: F.substring(key, 1, 1)
    rank = lambda key: (F.when(key == "null", 0).when(key.isin("false", "true"), 1).when(first(key).rlike("[0-9-]"), 2)
                        .when(first(key) == '"', 3).otherwise(4))
    keyed = lambda key: F.struct(
        rank(key).alias("rank"), F.when(rank(key) == 2, key.try_cast("double")).alias("number"),
        F.when(rank(key) == 3, F.try_variant_get(F.try_parse_json(key), "$", "string")).alias("text"), key.alias("key"))
    keys = F.array_sort(F.transform(F.array_distinct(F.transform(items, variant_key)), keyed))
    return F.transform(keys, lambda k: F.try_parse_json(k.getField("key")))


def distinct_items(value: Column, dtype: T.DataType | None = None) -> Column:
    """Distinct elements in ascending order; a scalar passes through.

    Of a variant each row tells whether it is a list.
    """
    if dtype == VARIANTS:
        return _variant_distinct(value)
    if isinstance(dtype, T.VariantType):
        items = F.try_variant_get(value, "$", "array<variant>")
        listed = F.schema_of_variant(value).startswith("ARRAY")
        return F.when(listed, _variant_distinct(items).cast("variant")).otherwise(value)
    if dtype is not None and not isinstance(dtype, T.ArrayType):
        return value.cast(dtype)
    return F.sort_array(F.array_distinct(value))


def length_of(value: Column, dtype: T.DataType) -> Column:
    """Number of elements of a list, members of an object or characters of a text."""
    if isinstance(dtype, T.VariantType):
        kind = F.schema_of_variant(value)
        return (F.when(kind.startswith("ARRAY"), F.size(F.try_variant_get(value, "$", "array<variant>")))
                .when(kind.startswith("OBJECT"), F.size(F.try_variant_get(value, "$", "map<string,variant>")))
                .when(~F.is_variant_null(value), F.length(F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.size(value)
    return F.length(value)


def join_items(value: Column, separator: str = ",") -> Column:
    """One text from all elements."""
    return F.array_join(F.transform(value, lambda x: x.cast("string")), separator)


def unwrap_single(value: Column) -> Column:
    """The element of a list of one; null for any other length."""
    return F.when(F.size(value) == 1, F.get(value, F.lit(0)))


def items_where(value: Column, test) -> Column:
    """Elements for which ``test(element)`` is true."""
    return F.filter(value, test)


def cell_text(value: Column, dtype: T.DataType, missing: str | None = None) -> Column:
    """A cell fit for a flat table.

    A list gives its elements joined with commas, nested lists likewise; an
    empty list, like an absent one, gives ``missing``. Scalars are unchanged.
    """
    if isinstance(dtype, T.ArrayType):
        inner = _flat_text(value, dtype)
        return F.when(F.size(value) > 0, inner).otherwise(F.lit(missing))
    if missing is None:
        return value
    if isinstance(dtype, T.StringType):
        return F.coalesce(value, F.lit(missing))
    return F.coalesce(value.cast("string"), F.lit(missing))


def _flat_text(value: Column, dtype: T.ArrayType) -> Column:
    item = dtype.elementType
    if isinstance(item, T.ArrayType):
        texts = F.transform(value, lambda x: _flat_text(x, item))
    elif isinstance(item, (T.StructType, T.MapType, T.VariantType)):
        texts = F.transform(value, lambda x: F.to_json(x))
    else:
        texts = F.transform(value, lambda x: x.cast("string"))
    return F.array_join(texts, ",")


def xml_text(value: Column, dtype: T.DataType) -> Column:
    """Unwrap what an XML element leaves behind in JSON.

    An object with ``#text`` gives that text. An object with nothing but
    ``id`` and ``@attribute`` members was an empty element and gives ``''``.
    Any other object is kept as JSON text. For a variant the members are
    looked at row by row, for a struct once from its type.
    """
    if isinstance(dtype, T.VariantType):
        return _variant_text(value)
    if not isinstance(dtype, T.StructType):
        return value
    names = dtype.fieldNames()
    if "#text" in names:
        text = value.getField("#text").cast("string")
        others = [n for n in names if n != "#text" and n != "id" and not n.startswith("@")]
        left = F.lit("") if not others else F.to_json(value)
        return F.when(value.isNull(), F.lit(None)).otherwise(F.coalesce(text, left))
    if all(n == "id" or n.startswith("@") for n in names):
        return F.when(value.isNotNull(), F.lit(""))
    return F.to_json(value)


def _variant_text(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    members = F.from_json(F.to_json(value), "map<string,string>")
    bare = F.size(F.filter(F.map_keys(members), lambda k: ~((k == "id") | k.startswith("@")))) == 0
    plain = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
    return (
        F.when(F.is_variant_null(value), F.lit(None))
        .when(~kind.startswith("OBJECT"), plain)
        .when(F.map_contains_key(members, "#text"), F.element_at(members, F.lit("#text")))
        .when(bare, F.lit(""))
        .otherwise(F.to_json(value))
    )


def variant_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text of a variant or a list of them; a text in it stays as it is."""
    if isinstance(dtype, T.ArrayType):
        return F.to_json(value)
    plain = F.schema_of_variant(value) == "STRING"
    return F.when(F.is_variant_null(value), F.lit(None)).when(
        plain, F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def variant_cell(value: Column, missing: str | None = None) -> Column:
    """A variant as a cell of text.

    What is missing, or an empty list, gives ``missing``; a stored null stays
    null. A list gives its elements joined with commas.
    """
    items = F.try_variant_get(value, "$", "array<variant>")
    return (
        F.when(value.isNull(), F.lit(missing))
        .when(items.isNull(), _variant_text(value))
        .when(F.size(items) == 0, F.lit(missing))
        .otherwise(F.array_join(F.transform(items, _variant_text), ","))
    )
