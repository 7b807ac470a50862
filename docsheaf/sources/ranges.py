"""Filters and ranges over a source; all are plain predicates, so they push down."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the date field whose upper bound is exclusive.
EXCLUSIVE_UNTIL = "date_last_activity"
# Rows in one page, for cursor sources and for all others.
CURSOR_PAGE_ROWS = 10_000
PAGE_ROWS = 1_000


def match_filters(df: DataFrame, filters: Iterable[tuple[str, object]], member=None) -> DataFrame:
    """Names must all match; values given for one name are alternatives.

    ``member`` turns a name into a Column, by default into that of the name.
    From documents without a schema it gives text, so values are compared as text.
    """
    for test in filter_tests(df, filters, member):
        df = df.where(test)
    return df


def filter_tests(df: DataFrame, filters: Iterable[tuple[str, object]], member=None) -> list[Column]:
    """The same as predicates, one for each name."""
    wanted: dict[str, list] = {}
    for name, value in filters:
        wanted.setdefault(name, []).append(value)
    tests = []
    for name, values in wanted.items():
        column = member(name) if member else F.col(name)
        same = [v if isinstance(v, str) else json.dumps(v) for v in values] if member and is_text(df, column) else values
        tests.append(column.isin(same))
    return tests


def is_text(df: DataFrame, column: Column) -> bool:
    return df.select(column.alias("v")).schema["v"].dataType.simpleString() == "string"


def bound(value) -> Column:
    """A literal to compare with; a time without zone stays one."""
    if isinstance(value, datetime.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return value if isinstance(value, Column) else F.lit(value)


def in_range(
    df: DataFrame, at: Column, since=None, until=None, until_inclusive: bool = True
) -> DataFrame:
    """Rows from ``since`` (inclusive) to ``until``; an open side is None."""
    if since is not None:
        df = df.where(at >= bound(since))
    if until is not None:
        df = df.where(at <= bound(until) if until_inclusive else at < bound(until))
    return df


def since_until(df: DataFrame, date_field: str, since=None, until=None) -> DataFrame:
    """Range over one date field, with that field's own rule for the upper bound."""
    return in_range(df, F.col(date_field), since, until, date_field != EXCLUSIVE_UNTIL)


def since_until_fallback(df: DataFrame, fields: list[Column], since=None, until=None) -> DataFrame:
    """Range over the first of several dates that is present.

    Written per alternative, not on a coalesce, so each branch is a predicate
    on a bare column that files can be skipped by.
    """
    if since is None and until is None:
        return df
    test = F.lit(False)
    absent = F.lit(True)
    for at in fields:
        here = F.lit(True)
        if since is not None:
            here = here & (at >= bound(since))
        if until is not None:
            here = here & (at <= bound(until))
        test = test | (absent & here)
        absent = absent & at.isNull()
    return df.where(test)


def progress_date(fields: list[Column]) -> Column:
    """The date a row counts as progress up to: the first one present."""
    return F.coalesce(*fields)


def keyset_page(df: DataFrame, key: str, after=None, rows: int = CURSOR_PAGE_ROWS) -> DataFrame:
    """The next page by key. The limit is the page size the caller asks for."""
    if after is not None:
        df = df.where(F.col(key) > bound(after))
    return df.orderBy(key).limit(rows)


def next_cursor(page: DataFrame, key: str):
    """Where the following page starts; None when the page is empty."""
    return page.agg(F.max(key).alias("k")).first()["k"]
