"""Exports: what a table is made of, as plain data, and the plan made from it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    LIST_FUNCTIONS, attachment_url, attachment_urls, auto_id, bound, cell_text, descendants_of, doc_url, first_present, variant_cell, variant_descendants,
    variant_field, variant_json, variant_list, via, xml_text,
)
from ..functions import field as struct_field
from ..operators.contract import check_names
from ..operators.columntypes import as_text, spark_type
from ..operators.lookup import map_values
from ..operators.unnest import child_or_root_rows, child_rows_at
from ..sources.ranges import match_filters
from ..sources.tables import DocTable
from .nested import at_place, lists_on, placed_items

ROOT = "$"
THIS = "`this`"
CHILD, POS, PLACE = "__child", "__pos", "__place"
VARIANTS = T.ArrayType(T.VariantType())

# Where a document names the user who made it.
ACTOR_PATHS = {"form": (ROOT, "metadata", "userID"), "case": (ROOT, "user_id")}
ACTOR_COLUMN = "actor_id"
# Names of the address functions, and the kind of page of each.
URL_STEPS = {"form_url": "form", "case_url": "case", "attachment_url": "attachment"}


@dataclass(frozen=True)
class ColumnSpec:
    """One output column.

    ``path`` is a tuple of steps. It starts at the row, or at the document if
    its first step is ``$``; ``(THIS,)`` is the row itself. ``alternates`` are
    further paths tried where the ones before are empty. ``map_via`` and
    ``format_via`` are (function name, arguments…) and apply in that order,
    then ``mapping`` replaces values by a named value mapping. An argument of
    ``template`` that is a tuple is a path of its own. The address functions
    take no arguments: they use the document's domain and id.
    """

    name: str
    path: tuple[str, ...]
    alternates: tuple[tuple[str, ...], ...] = ()
    map_via: tuple | None = None
    format_via: tuple | None = None
    mapping: str | None = None
    data_type: str | None = None


@dataclass(frozen=True)
class ExportSpec:
    """One output table."""

    table: str
    resource: str
    columns: tuple[ColumnSpec, ...]
    root: tuple[str, ...] = ()
    filters: tuple[tuple[str, str], ...] = ()
    missing_value: str | None = None
    value_or_root: bool = False
    base_url: str = ""

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "ExportSpec":
        data = json.loads(text)
        columns = tuple(ColumnSpec(**{k: _frozen(v) for k, v in c.items()}) for c in data.pop("columns"))
        return ExportSpec(columns=columns, **{k: _frozen(v) for k, v in data.items()})

    def fingerprint(self) -> str:
        """Changes whenever the spec does."""
        return hashlib.md5(self.to_json().encode()).hexdigest()


def _frozen(value):
    return tuple(_frozen(v) for v in value) if isinstance(value, list) else value


def with_actor(spec: ExportSpec) -> ExportSpec:
    """Add the column that joins facts to users, unless it is there already."""
    path = ACTOR_PATHS.get(spec.resource)
    if path is None:
        return spec
    for column in spec.columns:
        if column.name == ACTOR_COLUMN:
            if column.path == path and not (column.alternates or column.map_via or column.format_via):
                return spec
            raise ValueError(f"column {ACTOR_COLUMN} has a meaning of its own and cannot be redefined")
    return replace(spec, columns=spec.columns + (ColumnSpec(ACTOR_COLUMN, path),))


def walk(at: Column | None, dtype: T.DataType, steps: tuple[str, ...]):
    """(value, type) at the steps, or None if the type has no such path.

    A step into a list goes to every element; elements without the field are
    left out and lists of lists are flattened. ``[n]`` is one element, from the
    end if negative, ``[a:b:c]`` a stretch of a list, its ends open if left out,
    ``..name`` all members of that name at any depth below, as texts where a type
    is known. A name leads into a map as well.
    """
    for n, step in enumerate(steps):
        if isinstance(dtype, T.VariantType) or dtype == VARIANTS:
            return _walk_variant(at, dtype, steps[n:])
        if step == "[*]":
            continue
        if place := at_place(at, dtype, step):
            at, dtype = place
            continue
        if step.startswith(".."):
            at, dtype = descendants_of(dtype, at, step[2:]), T.ArrayType(T.StringType())
            continue
        if isinstance(dtype, T.MapType):
            at, dtype = F.try_element_at(at, F.lit(step)), dtype.valueType
            continue
        wrapped = isinstance(dtype, T.ArrayType)
        inner = dtype.elementType if wrapped else dtype
        if not isinstance(inner, T.StructType) or step not in inner.fieldNames():
            return None
        found = inner[step].dataType
        at = struct_field(step) if at is None else at.getField(step)
        if wrapped:
            # One null among lists would make the whole flattened list null.
            at = F.array_compact(at)
        if wrapped and isinstance(found, T.ArrayType):
            at, dtype = F.flatten(at), found
        else:
            dtype = T.ArrayType(found) if wrapped else found
    return at, dtype


def _walk_variant(at: Column, dtype: T.DataType, steps: tuple[str, ...]):
    """The same in documents without a schema; a lone value is a list of one."""
    for step in steps:
        many = dtype == VARIANTS
        if step.startswith(".."):
            below = lambda x, name=step[2:]: variant_descendants(x, name)
            at, dtype = F.flatten(F.transform(at, below)) if many else below(at), VARIANTS
        elif place := at_place(at if many else variant_list(at), VARIANTS, step):
            at, dtype = place
        elif step == "[*]":
            at = F.flatten(F.transform(at, variant_list)) if many else variant_list(at)
            dtype = VARIANTS
        elif many:
            at = F.filter(F.transform(at, _member(step)), lambda x: x.isNotNull())
        else:
            at = variant_field(at, step, as_type="variant")
    return at, dtype


def _member(step: str):
    return lambda x: variant_field(x, step, as_type="variant")


def _start(doc: DocTable):
    """Where paths from the document start, and of what type that is."""
    if doc.variant:
        return F.col(f"`{doc.variant}`"), T.VariantType()
    return None, doc.df.schema


def _id_of(doc: DocTable) -> Column:
    if doc.variant:
        return variant_field(F.col(f"`{doc.variant}`"), doc.id_field)
    return F.col(f"`{doc.id_field}`")


def _items(doc: DocTable) -> Column:
    """The list a table's rows come from.

    An object there counts as a list of one, and as an empty list if it has no
    members.
    """
    found = walk(*_start(doc), doc.root)
    if found is None:
        raise ValueError(f"no such path: {'.'.join(doc.root)}")
    value, dtype = found
    if isinstance(dtype, T.ArrayType):
        return value
    if isinstance(dtype, T.VariantType):
        nothing = F.is_variant_null(value) | (F.to_json(value) == "{}")
        return F.when(nothing, F.lit(None)).otherwise(variant_list(value))
    filled = value.isNotNull()
    if isinstance(dtype, T.StructType):
        filled = F.coalesce(*[F.when(value.getField(n).isNotNull(), True) for n in dtype.fieldNames()])
    return F.when(filled, F.array(value))


def row_items(doc: DocTable, spec: ExportSpec) -> tuple[Column, bool]:
    """(the list a table's rows come from, whether its elements are (place, item)).

    Items of lists in lists carry their place on every level.
    """
    at, dtype = _start(doc)
    if lists_on(dtype, doc.root) < 2:
        return _items(doc), False
    named = any(("id",) in (c.path, *c.alternates, *_step_paths(c)) for c in spec.columns)
    found = placed_items(at, dtype, doc.root, named)
    if found is None:
        raise ValueError(f"no such path: {'.'.join(doc.root)}")
    return found[0], True


def _child_rows(doc: DocTable, spec: ExportSpec) -> DataFrame:
    unnest = child_or_root_rows if spec.value_or_root else child_rows_at
    items, placed = row_items(doc, spec)
    rows = unnest(doc.df, items, CHILD, POS)
    if not placed:
        return rows
    item = F.col(CHILD)
    return rows.withColumns({PLACE: item.getField("place"), CHILD: item.getField("item")})


def _heads(doc: DocTable, spec: ExportSpec) -> tuple[DocTable, dict]:
    """The document's own values that rows of its items need, looked up before there are rows.

    A row then holds these instead of the whole document, which would make a long
    list cost its square. Over structs Spark prunes the document itself.
    """
    if not doc.variant:
        return doc, {}
    paths = [p for c in spec.columns for p in (c.path, *c.alternates, *_step_paths(c)) if p[:1] == (ROOT,) and len(p) > 1]
    heads = {None: (_id_of(doc), T.StringType())}
    heads.update((p, walk(*_start(doc), p[1:])) for p in paths)
    named = {p: (f"__head{n}", v, t) for n, (p, (v, t)) in enumerate(heads.items())}
    df = doc.df.select("*", *[v.alias(name) for name, v, _ in named.values()])
    return replace(doc, df=df), {p: (F.col(name), t) for p, (name, _, t) in named.items()}


def _repeated(doc: DocTable, spec: ExportSpec, rows: DataFrame, resolve: Callable) -> tuple[DataFrame, dict]:
    """What several columns ask a document without a schema for, looked up once for all of them."""
    if not doc.variant:
        return rows, {}
    paths = [p for c in spec.columns for p in (c.path, *c.alternates, *_step_paths(c)) if p and p != (THIS,)]
    found = {p: resolve(p) for p in sorted({p for p in paths if paths.count(p) > 1})}
    named = {p: (f"__path{n}", *f) for n, (p, f) in enumerate((p, f) for p, f in found.items() if f)}
    rows = rows.select("*", *[v.alias(name) for name, v, _ in named.values()])
    return rows, {p: (F.col(name), t) for p, (name, _, t) in named.items()}


def resolver(doc: DocTable, rows: DataFrame, child: str = CHILD, pos: str = POS, place: str = PLACE, heads: dict | None = None) -> Callable:
    """Looks up paths in ``rows``, whose items lie in the named columns; ``heads`` are values that need no more looking up."""
    start, heads = _start(doc), heads or {}
    doc_id = heads[None][0] if None in heads else _id_of(doc)

    def resolve(path: tuple[str, ...]):
        if path in heads:
            return heads[path]
        if path[:1] == (ROOT,):
            return walk(*start, path[1:])
        if not doc.root:
            if path == (THIS,):
                whole = F.struct(*[F.col(f"`{c}`") for c in doc.df.columns])
                return start if doc.variant else (whole, doc.df.schema)
            return walk(*start, path)
        item = rows.schema[child].dataType
        if path == (THIS,):
            return F.col(child), item
        if path == ("id",):
            own = walk(F.col(child), item, path)
            if own and isinstance(own[1], T.VariantType):
                own = F.try_variant_get(own[0], "$", "string"), T.StringType()
            if place in rows.columns:
                named = F.concat_ws(".", doc_id.cast("string"), F.col(place))
            else:
                named = auto_id(doc_id, ".".join(doc.root), F.col(pos), own and own[0])
            return F.when(F.col(pos).isNull(), doc_id.cast("string")).otherwise(named), T.StringType()
        return walk(F.col(child), item, path)

    return resolve


def column_value(spec: ColumnSpec, resolve: Callable, base_url: str, rows: DataFrame) -> Column:
    """The value before cell coercion; null text where no path exists.

    Each step works on what the one before it gave, value and type. A step for
    single values gets a list as the text of its cell, so a list of one is its
    element, alike in documents with and without a schema. Numbers read from
    text are doubles in a column without a declared type; a declared one, or a
    step that follows, gets whole numbers as they are.
    """
    value, dtype = _meet([f for f in (resolve(p) for p in (spec.path, *spec.alternates)) if f is not None])
    steps = [s for s in (spec.map_via, spec.format_via) if s]
    for n, step in enumerate(steps):
        if step[0] == "str2num" and (spec.data_type or n + 1 < len(steps)):
            step = ("str2num-exact", *step[1:])
        value, dtype = _for_step(step[0], value, dtype)
        value = _step(step, dtype, resolve, base_url)(value)
        dtype = rows.select(value.alias("v")).schema["v"].dataType
    return value


def _for_step(name: str, value: Column, dtype: T.DataType):
    """(value, type) as the named function takes it."""
    if _untyped(dtype):
        if name in ("len", "unique"):
            return value, dtype
        if name == "json2str":
            return variant_json(value, dtype), T.StringType()
        return plain_text(value, dtype), T.StringType()
    if name in LIST_FUNCTIONS or name == "attachment_url":
        return value, dtype
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return plain_text(value, dtype), T.StringType()
    return value, dtype


def _meet(found: list):
    """First value present among paths; paths of different types meet as text."""
    if not found:
        return F.lit(None).cast("string"), T.StringType()
    if len(found) == 1:
        return found[0]
    if len({t.simpleString() for _, t in found}) == 1 and not _untyped(found[0][1]):
        return first_present(*[v for v, _ in found], dtype=found[0][1]), found[0][1]
    return F.coalesce(*[plain_text(v, t) for v, t in found]), T.StringType()


def _step(step: tuple, dtype: T.DataType, resolve: Callable, base_url: str) -> Callable[[Column], Column]:
    """One formatting step, with paths among its arguments looked up."""
    name, args = step[0], step[1:]

    def text(path: tuple[str, ...]) -> Column:
        return plain_text(*_meet([f for f in [resolve(path)] if f is not None]))

    if name in URL_STEPS:
        domain, key = text((ROOT, "domain")), text((ROOT, "id"))
        if name == "attachment_url":
            build = attachment_urls if isinstance(dtype, T.ArrayType) else attachment_url
            return lambda value: build(base_url, domain, key, value)
        return lambda value: doc_url(URL_STEPS[name], base_url, domain, key)
    return via(name, *[text(a) if isinstance(a, tuple) else a for a in args], dtype=dtype)


def _step_paths(column: ColumnSpec):
    """Paths a column's formatting steps read."""
    for step in (column.map_via, column.format_via):
        if step and step[0] in URL_STEPS:
            yield from ((ROOT, "domain"), (ROOT, "id"))
        yield from (a for a in (step or ())[1:] if isinstance(a, tuple))


def _untyped(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.VariantType) or dtype == VARIANTS


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """The text of any value, as its cell would have it."""
    if dtype == VARIANTS:
        return bound(F.transform(value, lambda x: variant_cell(x)), lambda texts: cell_text(texts, T.ArrayType(T.StringType())))
    if isinstance(dtype, T.VariantType):
        return variant_cell(value)
    return cell_text(xml_text(value, dtype), _after_xml(dtype)).cast("string")


def _after_xml(dtype: T.DataType) -> T.DataType:
    return T.StringType() if isinstance(dtype, (T.StructType, T.VariantType)) else dtype


def export(
    doc: DocTable, spec: ExportSpec, mappings: DataFrame | None = None, carry: dict[str, Column] | None = None,
) -> DataFrame:
    """The table a spec describes, as a DataFrame.

    Paths become plain field access on the source, so the scan reads only the
    fields the spec names. ``carry`` adds columns of the source as they are,
    with no cell coercion.
    """
    carry = carry or {}
    if doc.resource != spec.resource:
        raise ValueError(f"spec {spec.table} reads {spec.resource}, not {doc.resource}")
    doc = replace(doc.rooted(*(spec.root or doc.root)), df=match_filters(doc.df, spec.filters, doc.member))
    rows, heads = doc.df, {}
    if doc.root:
        doc, heads = _heads(doc, spec)
        rows = _child_rows(doc, spec)
    rows, shared = _repeated(doc, spec, rows, resolver(doc, rows, heads=heads))
    resolve = resolver(doc, rows, heads={**heads, **shared})
    out = rows.select(
        *[column_value(c, resolve, spec.base_url, rows).alias(c.name) for c in spec.columns],
        *[value.alias(name) for name, value in carry.items()])
    for column in spec.columns:
        if column.mapping:
            if mappings is None:
                raise ValueError(f"column {column.name} needs the mapping {column.mapping}")
            mapped = map_values(out, mappings, column.mapping, column.name, "__mapped")
            out = mapped.withColumn(column.name, F.col("__mapped")).drop("__mapped")
    types = out.schema
    return out.select(*[column_cell(c, types[c.name].dataType, spec.missing_value) for c in spec.columns], *carry)


def column_cell(column: ColumnSpec, dtype: T.DataType, missing: str | None) -> Column:
    """The cell of the column that holds its value."""
    value = F.col(f"`{column.name}`")
    goal = spark_type(column.data_type) if column.data_type else None
    if goal == "variant":
        text = isinstance(dtype, T.StringType)
        return (F.try_parse_json(value) if text else value.cast("variant")).alias(column.name)
    if _untyped(dtype):
        kept = missing if goal in (None, "string") else None
        if dtype == VARIANTS:
            value = F.coalesce(plain_text(value, dtype), F.lit(kept))
        else:
            value = variant_cell(value, kept)
        return (value.try_cast(goal) if goal else value).alias(column.name)
    value = xml_text(value, dtype)
    dtype = _after_xml(dtype)
    if goal and goal != "string":
        return cell_text(value, dtype).try_cast(goal).alias(column.name)
    if goal and not isinstance(dtype, (T.StringType, T.ArrayType)):
        value, dtype = as_text(value, dtype), T.StringType()
    return cell_text(value, dtype, missing).alias(column.name)


def columns_read(specs: list[ExportSpec], doc: DocTable) -> list[str]:
    """Top-level source columns that any of the specs touches."""
    if doc.variant:
        return doc.df.columns
    wanted = {doc.id_field, *doc.root[:1]}
    for spec in specs:
        wanted.update(spec.root[:1])
        wanted.update(name for name, _ in spec.filters)
        rooted = bool(spec.root or doc.root)
        for column in spec.columns:
            for path in (column.path, *column.alternates, *_step_paths(column)):
                if path == (THIS,) and not rooted:
                    return doc.df.columns
                if path[:1] == (ROOT,):
                    wanted.update(path[1:2])
                elif not rooted:
                    wanted.update(path[:1])
    return [c for c in doc.df.columns if c in wanted]


def export_many(
    doc: DocTable, specs: list[ExportSpec], write: Callable[[str, DataFrame], None],
    mappings: DataFrame | None = None, target: str | None = None, keep: bool = False,
) -> None:
    """Write several tables from one source.

    All names are checked before anything is written. Each table scans the
    fields it needs, which suits columnar sources. ``keep=True`` scans the
    columns of all tables once and keeps them on the executors, on disk where
    memory is short, for small sources that are costly to read.
    """
    for spec in specs:
        check_names(spec.table, [c.name for c in spec.columns], target)
    keep = keep and len(specs) > 1
    df = doc.df.select(*[F.col(f"`{c}`") for c in columns_read(specs, doc)])
    shared = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
    try:
        for spec in specs:
            write(spec.table, export(replace(doc, df=shared), spec, mappings))
    finally:
        if keep:
            shared.unpersist()
