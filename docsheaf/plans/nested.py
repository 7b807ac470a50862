"""Items of lists in lists, each with its place on every level.

The place of an item is the path to it, with its number in each list it lies
in: ``visits.[2].items.[0]``. An element that has an id of its own is called by
that instead of its number. So a place depends only on the lists above the item,
and an item put into one list changes no place in another.

Everything is a column expression: rows do not move and nothing is exploded on
the way down.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bound, descendants_of, field, index_at, variant_descendants, variant_field, variant_items, variant_list

INDEX = re.compile(r"\[(-?\d+)\]")
SLICE = re.compile(r"\[(-?\d+)?:(-?\d+)?(?::(-?\d+)?)?\]")


def slice_bounds(step: str) -> tuple[int | None, int | None, int] | None:
    """(start, stop, by) of a step like ``[1:]`` or ``[::2]``; None if it is no such step."""
    found = SLICE.fullmatch(step)
    if not found:
        return None
    start, stop, by = (int(n) if n else None for n in found.groups())
    if by == 0:
        raise ValueError(f"{step} does not move")
    return start, stop, by or 1


def stretch(items: Column, start: int | None, stop: int | None, by: int = 1) -> tuple[Column, Callable[[Column], Column]]:
    """The elements of a stretch, and the place in the whole list of its nth one.

    Ends may be open or counted from the back, and ``by`` may go backwards, as
    in any JSON path.
    """
    size, back = F.size(items), by < 0
    low, high = (-1, size - 1) if back else (0, size)

    def bound(n: int | None, unset) -> Column:
        if n is None:
            return F.lit(unset) if isinstance(unset, int) else unset
        at = F.lit(n) if n >= 0 else size + n
        return F.least(F.greatest(at, F.lit(low)), high if isinstance(high, Column) else F.lit(high))

    begin, end = (bound(start, high), bound(stop, low)) if back else (bound(start, low), bound(stop, high))
    if by == 1:
        part = F.slice(items, begin + 1, F.greatest(end - begin, F.lit(0)))
    else:
        inside = lambda i: (i <= begin) & (i > end) if back else (i >= begin) & (i < end)
        part = F.filter(items, lambda x, i: inside(i) & (F.abs(i - begin) % abs(by) == 0))
        part = F.reverse(part) if back else part
    return part, lambda n: begin + n * by


def at_place(at: Column, dtype: T.DataType, step: str) -> tuple[Column, T.DataType] | None:
    """(value, type) at a step like ``[2]`` or ``[1:]``; None if it is no such step. A lone value is a list of one."""
    number, bounds = INDEX.fullmatch(step), slice_bounds(step)
    if not number and not bounds:
        return None
    if not isinstance(dtype, T.ArrayType):
        at, dtype = F.when(at.isNotNull(), F.array(at)), T.ArrayType(dtype)
    if number:
        return index_at(at, int(number[1])), dtype.elementType
    return stretch(at, *bounds)[0], dtype


def lists_on(dtype: T.DataType, steps: tuple[str, ...]) -> int:
    """How many lists a path goes through, the one it ends at included."""
    n = 0
    for step in (*steps, None):
        while isinstance(dtype, T.ArrayType):
            dtype, n = dtype.elementType, n + 1
        if step is None:
            return n
        if isinstance(dtype, T.VariantType):
            return n + len(steps)
        if isinstance(dtype, T.MapType):
            dtype = dtype.valueType
        elif isinstance(dtype, T.StructType) and step in dtype.fieldNames():
            dtype = dtype[step].dataType
    return n


def placed_items(at: Column | None, dtype: T.DataType, steps: tuple[str, ...], named: bool = True) -> tuple[Column, T.DataType] | None:
    """(array of (place, item), item type) at the steps, or None if the type has no such path.

    ``named=False`` leaves the places null, for tables that do not use them.
    """
    return _Spread(named).down(at, dtype, steps, None)


class _Spread:
    """One way down; ``place`` is the text so far, or None where nothing is above."""

    def __init__(self, named: bool):
        self.named = named

    def _then(self, place: Column | None, piece: Column | str) -> Column:
        if not self.named:
            return F.lit(None).cast("string")
        piece = F.lit(piece) if isinstance(piece, str) else piece
        return piece if place is None else F.concat(place, F.lit("."), piece)

    def _element(self, item: Column, dtype: T.DataType, number: Column) -> Column:
        """What an element is called in its list."""
        counted = F.concat(F.lit("["), number.cast("string"), F.lit("]"))
        if isinstance(dtype, T.VariantType):
            return F.coalesce(variant_field(item, "id"), counted)
        if isinstance(dtype, T.StructType) and "id" in dtype.fieldNames():
            return F.coalesce(item.getField("id").cast("string"), counted)
        return counted

    def _one(self, item: Column, place: Column) -> Column:
        return F.struct(place.alias("place"), item.alias("item"))

    def _each(self, items: Column, dtype: T.DataType, steps: tuple[str, ...], place: Column | None, number=lambda i: i):
        """Through all elements of a list, which is the end of the path if no steps are left."""
        called = lambda x, i: self._then(place, self._element(x, dtype, number(i)))
        if not steps and not isinstance(dtype, T.ArrayType):
            return F.transform(items, lambda x, i: self._one(x, called(x, i))), dtype
        found: list[T.DataType] = []

        def below(x: Column, i: Column) -> Column:
            lower = self.down(x, dtype, steps, called(x, i))
            if lower is None:
                return F.array()
            found.append(lower[1])
            return F.coalesce(lower[0], F.array())

        spread = F.flatten(F.transform(items, below))
        return (spread, found[0]) if found else None

    def down(self, at: Column | None, dtype: T.DataType, steps: tuple[str, ...], place: Column | None):
        if isinstance(dtype, T.VariantType):
            return self._down_variant(at, steps, place)
        if isinstance(dtype, T.ArrayType):
            if steps and (number := INDEX.fullmatch(steps[0])):
                return self._down_index(at, dtype.elementType, int(number[1]), steps[1:], place)
            if steps and (bounds := slice_bounds(steps[0])):
                part, number = stretch(at, *bounds)
                return self._each(part, dtype.elementType, steps[1:], place, number)
            return self._each(at, dtype.elementType, steps[1:] if steps[:1] == ("[*]",) else steps, place)
        if not steps:
            return F.when(at.isNotNull(), F.array(self._one(at, place))), dtype
        step, rest = steps[0], steps[1:]
        if step.startswith(".."):
            texts = descendants_of(dtype, at, step[2:])
            return self._each(texts, T.StringType(), rest, self._then(place, step))
        if isinstance(dtype, T.MapType):
            return self.down(F.try_element_at(at, F.lit(step)), dtype.valueType, rest, self._then(place, step))
        if isinstance(dtype, T.StructType) and step in dtype.fieldNames():
            inner = field(step) if at is None else at.getField(step)
            return self.down(inner, dtype[step].dataType, rest, self._then(place, step))
        return None

    def _down_index(self, items: Column, dtype: T.DataType, number: int, steps: tuple[str, ...], place: Column | None):
        item = index_at(items, number)
        where = F.lit(number) if number >= 0 else F.size(items) + number
        return self.down(item, dtype, steps, self._then(place, self._element(item, dtype, where)))

    def _down_variant(self, at: Column, steps: tuple[str, ...], place: Column | None):
        """Where no type tells lists from lone values, each row does.

        What a list is told by, its elements and the place above them are worked
        out once for the list, not again for each of its elements.
        """
        kind = T.VariantType()
        if steps and (number := INDEX.fullmatch(steps[0])):
            return bound(variant_list(at), lambda items: self._down_index(items, kind, int(number[1]), steps[1:], place)[0]), kind
        if steps and (bounds := slice_bounds(steps[0])):
            def part_of(items: Column) -> Column:
                part, number = stretch(items, *bounds)
                return self._each(part, kind, steps[1:], place, number)[0]
            return bound(variant_list(at), part_of), kind
        if steps[:1] == ("[*]",):
            steps = steps[1:]
        return bound(at, lambda value: bound(variant_items(value), lambda items: self._through(value, items, steps, place))), kind

    def _through(self, at: Column, elements: Column, steps: tuple[str, ...], place: Column | None) -> Column:
        """All elements of a variant, which are null if it is no list and counts as its only one."""
        kind, listed = T.VariantType(), elements.isNotNull()
        items = F.coalesce(elements, F.when(at.isNotNull(), F.array(at)))
        if place is None:
            called = lambda x, i: F.lit(None).cast("string")
        else:
            called = lambda x, i: F.when(listed, self._then(place, self._element(x, kind, i))).otherwise(place)
        if not steps:
            nothing = ~listed & (F.is_variant_null(at) | (F.to_json(at) == "{}"))
            return F.when(~nothing, F.transform(items, lambda x, i: self._one(x, called(x, i))))
        step, rest = steps[0], steps[1:]

        def lower(x: Column, here: Column) -> Column:
            if step.startswith(".."):
                return self._each(variant_descendants(x, step[2:]), kind, rest, here)[0]
            return self._down_variant(variant_field(x, step, as_type="variant"), rest, here)[0]

        def below(x: Column, i: Column) -> Column:
            here = self._then(None if place is None else called(x, i), step)
            return F.coalesce(bound(here, lambda h: lower(x, h)), F.array())

        return F.flatten(F.transform(items, below))
