"""One incremental run: resume, scan a bounded range, merge, then record progress."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import to_datetime
from ..operators.contract import check_names
from ..operators.merge import collapse
from ..sinks.store import StoredTable
from ..sources.ranges import EXCLUSIVE_UNTIL, in_range, progress_date, since_until_fallback
from ..sources.tables import DocTable
from .export import ExportSpec, columns_read, export
from .ledger import CURSOR_MODE, Ledger, Run, ledger_used, scan_mode, start_point
from .undated import UndatedLog, marks, with_fresh

ORDER = "__order"


@dataclass(frozen=True)
class Progress:
    """How a run went: where it started and how far it got."""

    since: object
    until: object
    mode: str


def run_export(
    doc: DocTable, specs: list[ExportSpec], folder: str, run: Run, date_fields: list[str],
    ledger: Ledger | None = None, since=None, until=None, start_over: bool = False,
    mappings: DataFrame | None = None, parts: int = 1, strict: bool = False,
    mode_fields: dict[str, list[str]] | None = None,
) -> Progress:
    """Export what is new in a source to one stored table per spec.

    The range starts where the ledger says the tables have got, inclusive. An
    upper bound is there only if the caller asks for one, so a first run takes
    every document, with or without a date. Rows on the boundary are read again
    next time, which the merge by id makes harmless. How far the run got, the
    newest date and the id that has it, is observed while the first table is
    written, and recorded after all merges are committed: a run that dies is
    simply repeated. Where no document has a date nothing is recorded, and the
    next run takes everything again.

    Documents without a date are in no range. A run that goes by the ledger
    takes those that are new or whose content has changed since the last such
    run, see ``undated``; one with bounds of the caller's own takes none.

    ``date_fields`` are tried in order; in cursor mode the first one is the key
    of the cursor. ``mode_fields`` names other fields for some modes: a resumed
    run keeps its mode and so goes on along the fields it began with.
    """
    for spec in specs:
        check_names(spec.table, [c.name for c in spec.columns])
    use = ledger is not None and ledger_used(since, until)
    row = ledger.resume(run) if use and not start_over else None
    mode = scan_mode(row, run, start_over, since)
    fields = (mode_fields or {}).get(mode, date_fields)
    start = start_point(row, run, start_over, since)
    dates = [doc.member(f) for f in fields]
    at = progress_date(dates)
    start = _typed(doc.df, dates[0], start)
    in_bounds = _range(doc.df, fields, dates, start, until)
    fresh = log = None
    if use:
        log = UndatedLog(doc.df.sparkSession, folder, _log_name(run))
        fresh = log.fresh(marks(doc, dates, columns_read(specs, doc)))
        if start is not None:
            in_bounds = with_fresh(doc, in_bounds, dates, fresh)
    bounded = replace(doc, df=in_bounds)
    id_of = doc.member(doc.id_field).cast("string")
    reached = Observation()
    seen = bounded.df.observe(reached, F.max(F.struct(at.alias("at"), id_of.alias("id"))).alias("last"))
    for n, spec in enumerate(specs):
        source = replace(bounded, df=seen) if n == 0 else bounded
        rows = export(source, spec, mappings, carry={ORDER: at})
        merged = collapse(rows, "id", F.col(ORDER)).drop(ORDER)
        # A column without a declared type comes into being with its first value.
        late = [c.name for c in spec.columns if not c.data_type and c.name != "id"]
        StoredTable(doc.df.sparkSession, f"{folder}/{spec.table}", "id", parts).merge(merged, strict, optional=late)
    if log is not None:
        log.append(fresh)
    last = reached.get["last"] if specs else None
    newest = last["at"] if last is not None else None
    end = until if until is not None else newest
    if use and newest is not None:
        cursor = str(newest) if mode == CURSOR_MODE else None
        ledger.record(run, _text(newest), mode, final=True, last_doc_id=last["id"], cursor=cursor)
    return Progress(start, end, mode)


def _log_name(run: Run) -> str:
    """What the ledger tells runs apart by, but for the spec: another one reads other members, so its hashes differ."""
    return hashlib.md5(repr((run.key, run.project, run.server, run.tables)).encode()).hexdigest()


def _range(df: DataFrame, fields: list[str], dates: list[Column], since, until) -> DataFrame:
    if len(dates) > 1:
        return since_until_fallback(df, dates, since, until)
    return in_range(df, dates[0], since, until, fields[0] != EXCLUSIVE_UNTIL)


def _text(value) -> str:
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def _typed(df: DataFrame, column: Column, value):
    """A recorded bound in the type of its column, so that the filter pushes down."""
    if not isinstance(value, str):
        return value
    dtype = df.select(column.alias("v")).schema["v"].dataType.simpleString()
    if dtype == "string":
        return value
    bound = to_datetime(F.lit(value)) if dtype.startswith("timestamp") and value.endswith("Z") else F.lit(value)
    return df.sparkSession.range(1).select(bound.cast(dtype).alias("v")).first()["v"]
