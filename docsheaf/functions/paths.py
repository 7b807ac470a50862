"""Column builders that reach into nested documents.

Steps are given as separate arguments, so names with ``#``, ``@``, ``:`` or
dots need no quoting. Over structs a builder returns plain field access, which
keeps nested column pruning; over variants it returns ``try_variant_get``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field(*steps: str) -> Column:
    """A field by its steps: ``field('form', 'case', '@case_id')``."""
    return F.col(".".join(f"`{s}`" for s in steps))


def each(list_column: Column, *steps: str) -> Column:
    """The value at ``steps`` in every element of a list."""
    out = list_column
    for step in steps:
        out = out.getField(step)
    return out


def each_present(list_column: Column, *steps: str) -> Column:
    """Like ``each`` without the elements that lack the value."""
    return F.filter(each(list_column, *steps), lambda v: v.isNotNull())


def index_at(list_column: Column, position: int) -> Column:
    """Zero-based element, counted from the end if negative; null if outside."""
    return F.try_element_at(list_column, F.lit(position + 1 if position >= 0 else position))


def index_range(list_column: Column, start: int, stop: int) -> Column:
    """Elements from ``start`` up to but without ``stop``, both zero-based."""
    return F.slice(list_column, start + 1, max(stop - start, 0))


def dynamic_field(members: Column, name: Column) -> Column:
    """The map entry whose name is itself a column."""
    return F.try_element_at(members, name)


def has_path(dtype: T.DataType, *steps: str) -> bool:
    """Whether the steps exist in the type."""
    for step in steps:
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if not isinstance(dtype, T.StructType) or step not in dtype.fieldNames():
            return False
        dtype = dtype[step].dataType
    return True


def field_or_null(schema: T.StructType, *steps: str) -> Column:
    """A field where the schema has it, else null: an absent path is no error."""
    return field(*steps) if has_path(schema, *steps) else F.lit(None)


def descendants(schema: T.StructType, name: str, *start: str) -> Column:
    """All values called ``name`` at any depth, as one array of text.

    The schema is walked while the plan is built; rows see only field access.
    Within one document the order is that of the schema, parents first.
    """
    dtype: T.DataType = schema
    for step in start:
        dtype = dtype[step].dataType
    return descendants_of(dtype, field(*start) if start else None, name)


def descendants_of(dtype: T.DataType, at: Column | None, name: str) -> Column:
    """The same below a value of a known type; None stands for the row."""
    found = list(_find(dtype, at, name))
    if not found:
        return F.array().cast("array<string>")
    return F.filter(F.concat(*found), lambda v: v.isNotNull())


def _find(dtype: T.DataType, at: Column | None, name: str):
    if isinstance(dtype, T.StructType):
        for child in dtype.fields:
            here = field(child.name) if at is None else at.getField(child.name)
            if child.name == name:
                yield _texts(child.dataType, here)
            yield from _find(child.dataType, here, name)
    elif isinstance(dtype, T.ArrayType):
        item = dtype.elementType
        for build in _find_in_items(item, name):
            nested = F.flatten(F.transform(at, build))
            yield F.coalesce(nested, F.array().cast("array<string>"))


def _find_in_items(item: T.DataType, name: str):
    """Builders from one element to an array of text, one per matching path."""
    if isinstance(item, T.StructType):
        for child in item.fields:
            if child.name == name:
                yield _member(child.name, lambda v, t=child.dataType: _texts(t, v))
            for deeper in _find_in_items(child.dataType, name):
                yield _member(child.name, deeper)
    elif isinstance(item, T.ArrayType):
        for deeper in _find_in_items(item.elementType, name):
            yield _over_items(deeper)


def _member(step: str, build):
    def texts(element: Column) -> Column:
        return build(element.getField(step))
    return texts


def _over_items(build):
    def texts(element: Column) -> Column:
        return F.coalesce(F.flatten(F.transform(element, build)), F.array().cast("array<string>"))
    return texts


def _texts(dtype: T.DataType, value: Column) -> Column:
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.array(F.to_json(value))
    return F.array(value.cast("string"))


def variant_field(document: Column, *steps: str, as_type: str = "string") -> Column:
    """A value in a variant; null where the path is missing or of another kind."""
    route = "$" + "".join("['" + s.replace("'", "\\'") + "']" for s in steps)
    return F.try_variant_get(document, route, as_type)


def variant_missing(document: Column, *steps: str) -> Column:
    """True only where the path does not exist; a stored null does exist."""
    return variant_field(document, *steps, as_type="variant").isNull()


def bound(value: Column, build) -> Column:
    """``build(value)``, with the value worked out once however often it is used there."""
    return F.get(F.transform(F.array(value), lambda x: build(x)), F.lit(0))


def variant_items(value: Column) -> Column:
    """The elements of a variant that is a list; null for any other. Only the list itself is looked at."""
    return F.try_variant_get(value, "$", "array<variant>")


def variant_list(value: Column) -> Column:
    """A variant as a list: a list stays, a lone value becomes a list of one."""
    return F.coalesce(variant_items(value), F.when(value.isNotNull(), F.array(value)))


def variant_descendants(value: Column, name: str) -> Column:
    """All members called ``name`` at any depth of a variant, as an array of variants.

    The row is gone down level by level, all objects and lists of a level at
    once, each replaced in its place by what it holds; single values are left
    behind. A JSON text is never deeper than half its length, which bounds the
    rounds; those behind the last level do nothing. Members of an object come
    before those below it; objects are gone through in the order of their names,
    lists in their own.
    """
    members_type = "array<struct<key:string,value:variant>>"
    nodes_type = f"array<struct<hit:variant,members:{members_type},items:array<variant>>>"
    none = F.lit(None)

    def node(hit: Column, members: Column, items: Column) -> Column:
        return F.struct(hit.cast("variant").alias("hit"), members.cast(members_type).alias("members"), items.cast("array<variant>").alias("items"))

    opened = lambda v: node(none, F.map_entries(F.try_variant_get(v, "$", "map<string,variant>")), variant_items(v))
    holds = lambda x: x.getField("members").isNotNull() | x.getField("items").isNotNull()
    less = lambda a, b: F.when(a.getField("key") < b.getField("key"), -1).when(a.getField("key") > b.getField("key"), 1).otherwise(0)

    def below(x: Column) -> Column:
        members = x.getField("members")
        own = F.transform(F.filter(members, lambda m: m.getField("key") == name), lambda m: node(m.getField("value"), none, none))
        keyed = F.transform(members, lambda m: F.struct(m.getField("key").alias("key"), opened(m.getField("value")).alias("node")))
        inner = F.transform(F.array_sort(F.filter(keyed, lambda k: holds(k.getField("node"))), less), lambda k: k.getField("node"))
        listed = F.filter(F.transform(x.getField("items"), opened), holds)
        return F.when(x.getField("hit").isNotNull(), F.array(x)).when(members.isNotNull(), F.concat(own, inner)).otherwise(listed)

    def state(nodes: Column) -> Column:
        return F.struct(nodes.alias("nodes"), F.exists(nodes, holds).alias("more"))

    def level(s: Column, _: Column) -> Column:
        return F.when(s.getField("more"), bound(F.flatten(F.transform(s.getField("nodes"), below)).cast(nodes_type), state)).otherwise(s)

    top = bound(F.filter(F.array(opened(value)), holds).cast(nodes_type), state)
    # As many rounds of as many levels each as together are no fewer than half the bytes of the text.
    half = F.octet_length(F.to_json(value)) / 2
    width = F.coalesce(F.ceil(F.sqrt(half)).cast("int"), F.lit(1))

    def down(n: Column) -> Column:
        levels = F.sequence(F.lit(1), n)
        some = lambda s, _: F.when(s.getField("more"), F.aggregate(levels, s, level)).otherwise(s)
        return F.aggregate(levels, top, some, lambda s: F.transform(s.getField("nodes"), lambda x: x.getField("hit")))

    return bound(width, down)


def auto_id(root_id: Column, path: str, position: Column, own_id: Column | None = None) -> Column:
    """Stable id of a child: root, path, then its own id or its place."""
    place = F.concat(F.lit("["), position.cast("string"), F.lit("]"))
    tail = place if own_id is None else F.coalesce(own_id.cast("string"), place)
    return F.concat_ws(".", root_id.cast("string"), F.lit(path), tail)
