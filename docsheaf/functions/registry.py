"""Functions by name, and the two-step column formatting built on them.

A registered function takes Columns and returns a Column. Row functions that
no Column expression can state are added as Pandas UDFs, so they run on Arrow
batches inside the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arith, convert, lists, logic, text

FUNCTIONS: dict[str, Callable[..., Column]] = {
    "+": arith.add,
    "-": arith.subtract,
    "*": arith.multiply,
    "//": arith.floor_divide,
    "/": arith.divide,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "len": lambda v, dtype=T.ArrayType(T.StringType()): lists.length_of(v, dtype),
    "bool": lambda v, dtype=T.StringType(): logic.is_truthy(v, dtype),
    "str2bool": logic.to_bool,
    "bool2int": logic.bool_to_int,
    "str2num": convert.to_number,
    "str2num-exact": convert.to_exact_number,
    "str2date": convert.to_datetime,
    "json2str": lambda v, dtype=None: convert.to_json_text(v, dtype),
    "format-uuid": convert.format_uuid,
    "sha1": convert.sha1_text,
    "selected": text.selected,
    "selected-at": text.selected_at,
    "count-selected": text.count_selected,
    "substr": text.substr_range,
    "join": text.join_text,
    "template": text.template,
    "default": lambda v, d, dtype=T.StringType(): logic.default_value(v, d, dtype),
    "or": logic.first_present,
    "filter_empty": logic.is_empty,
    "unique": lists.distinct_items,
}

# Functions that look at lists as such; all others take single values.
LIST_FUNCTIONS = frozenset(["len", "bool", "json2str", "default", "or", "filter_empty", "unique"])
# Functions that need to know the type of their first argument.
TYPED = frozenset(["+", "len", "bool", "json2str", "default", "filter_empty", "unique"])


def register(name: str, function: Callable[..., Column]) -> None:
    """Add a Column function under a new name."""
    if name in FUNCTIONS:
        raise ValueError(f"{name} is already registered")
    FUNCTIONS[name] = function


def register_row_function(name: str, function: Callable, returns: str) -> None:
    """Add ``function(pandas.Series, …) -> pandas.Series`` under a new name."""
    register(name, F.pandas_udf(function, returns))


def call(name: str, *args, **named) -> Column:
    if name not in FUNCTIONS:
        raise KeyError(f"no function named {name!r}")
    return FUNCTIONS[name](*args, **named)


def via(name: str, *args, dtype: T.DataType | None = None) -> Callable[[Column], Column]:
    """A formatting step for one column, such as ``via('selected-at', 3)``.

    Misuse puts a message in the cell instead of failing the whole export.
    ``dtype`` is the type of the value, for the functions that ask for it.
    """
    shown = f"{name}({', '.join(_shown(a) for a in args)})"
    if name == "selected-at" and not re.fullmatch(r"[+-]?\d+", str(args[0]).strip()):
        message = text.INDEX_CALL_ERROR.format(call=shown)
    elif name == "substr" and not all(re.fullmatch(r"\d+", str(a)) for a in args):
        message = text.SUBSTR_CALL_ERROR.format(call=shown)
    elif name == "template" and not (args and args[0]):
        message = text.TEMPLATE_CALL_ERROR.format(call=shown)
    else:
        return _step(name, args, dtype)
    return lambda value: F.lit(message)


def _shown(arg) -> str:
    return "" if isinstance(arg, Column) else str(arg)


def _step(name: str, args: tuple, dtype: T.DataType | None) -> Callable[[Column], Column]:
    if name == "template":
        return lambda value: text.template(args[0], *(args[1:] or (value,)))
    if name in ("selected-at", "substr"):
        return lambda value: call(name, value, *[int(a) for a in args])
    named = {"dtype": dtype} if dtype is not None and name in TYPED else {}
    return lambda value: call(name, value, *args, **named)
