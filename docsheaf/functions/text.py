"""Text functions: space-separated choices, slices, joins and templates."""

from __future__ import annotations

import re
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from .logic import as_column

# Texts that stand in the cell when a function is misused.
INDEX_ERROR = "Error: index must be an integer"
INDEX_CALL_ERROR = "Error: selected-at index must be an integer: {call}"
TEMPLATE_CALL_ERROR = "Error: template function requires the format template: {call}"
SUBSTR_CALL_ERROR = "Error: both substr arguments must be non-negative integers: {call}"

# Any Unicode white space, and the four separator control characters. The
# property class is the fastest of the equivalent patterns measured.
SPACES = r"[\p{IsWhite_Space}\x1c-\x1f]+"


def words(value: Column) -> Column:
    """Words between white space; blank text has none."""
    return F.array_remove(F.split(value.cast("string"), SPACES), "")


def _held(value: Column) -> Column:
    return value.cast("string") != ""


def selected_at(value: Column, index) -> Column:
    """The word at a zero-based position, counted from the end if negative."""
    if isinstance(index, Column):
        position = index.try_cast("int")
        found = F.try_element_at(
            words(value), F.when(position >= 0, position + 1).otherwise(position)
        )
        bad = index.isNotNull() & position.isNull()
        return F.when(_held(value), F.when(bad, F.lit(INDEX_ERROR)).otherwise(found))
    try:
        number = int(index)
    except ValueError:
        return F.when(_held(value), F.lit(INDEX_ERROR))
    at = F.lit(number + 1 if number >= 0 else number)
    return F.when(_held(value), F.try_element_at(words(value), at))


def selected(value: Column, word) -> Column:
    """Whether a whole word is among the words; null for an empty text."""
    return F.when(_held(value), F.array_contains(words(value), as_column(word)))


def count_selected(value: Column) -> Column:
    """How many words; null for an empty text."""
    return F.when(_held(value), F.size(words(value)))


def substr_range(value: Column, start, end) -> Column:
    """Characters from ``start`` up to but without ``end``, both zero-based."""
    text = value.cast("string")
    first, stop = as_column(start), as_column(end)
    piece = F.substring(text, first + 1, F.greatest(stop - first, F.lit(0)))
    return F.when((text != "") & (first >= 0) & (stop >= 0), piece)


def join_text(separator: str, *parts: Column) -> Column:
    """Parts with the separator between them; nulls are left out."""
    return F.concat_ws(separator, *[p.cast("string") for p in parts])


def template(layout: str, *parts: Column) -> Column:
    """Fill the places of the layout; null if any part used is null.

    Places are ``{}`` in turn, or ``{0}`` by number; ``{:>4}`` and the like set
    a fill character, an alignment (``<`` or ``>``) and a width. ``{{`` and
    ``}}`` stand for braces. The layout is read while the plan is built, so
    rows only concatenate; a place that cannot be stated so is refused.
    """
    out, turn = [F.lit("")], 0
    for literal, name, form, conversion in string.Formatter().parse(layout):
        out.append(F.lit(literal))
        if name is None:
            continue
        if conversion or not (name == "" or name.isdigit()):
            raise ValueError(f"cannot fill {{{name}}}: {layout}")
        at = turn if name == "" else int(name)
        turn += name == ""
        if at >= len(parts):
            raise IndexError(f"place {at} but {len(parts)} values: {layout}")
        out.append(_aligned(parts[at].cast("string"), form, layout))
    return F.concat(*out)


def _aligned(text: Column, form: str, layout: str) -> Column:
    """A text padded as a format such as ``*>8`` says; never cut."""
    if not form:
        return text
    parts = re.fullmatch(r"(?:(.)?([<>]))?(\d+)s?", form)
    if not parts:
        raise ValueError(f"cannot format as {form!r}: {layout}")
    fill, side, width = parts[1] or " ", parts[2] or "<", int(parts[3])
    pad = F.repeat(F.lit(fill), F.greatest(F.lit(width) - F.length(text), F.lit(0)))
    return F.concat(pad, text) if side == ">" else F.concat(text, pad)
