"""The progress ledger: how far each output table has got.

The functions take and return DataFrames; ``Ledger`` keeps one in a
StoredTable. Rows of a table are reduced inside the tasks before any shuffle,
so one table with most of the rows does no harm.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.merge import upsert
from ..sinks.store import StoredTable

SCHEMA = (
    "id string, spec_name string, spec_md5 string, table_name string, key string, "
    "project string, server string, since_param string, time_of_run string, final boolean, "
    "data_source string, last_doc_id string, pagination_mode string, cursor string"
)
# Names of the scan modes.
LEGACY_MODE, DATE_MODE, CURSOR_MODE = "date_modified", "date_indexed", "cursor"
CURSOR_SOURCE = "ucr"
GROUP = ("project", "server", "spec_md5", "table_name")
HISTORY_ROWS = 20


def newest(ledger: DataFrame, by: Iterable[str], time: str = "time_of_run", tie: str = "id") -> DataFrame:
    """The newest row per group; equal times are settled by ``tie``."""
    by = list(by)
    rest = [c for c in ledger.columns if c not in (*by, time, tie)]
    best = F.max(F.struct(time, tie, *rest)).alias("m")
    return ledger.groupBy(*by).agg(best).select(*by, "m.*").select(*ledger.columns)


def newest_by_rank(ledger: DataFrame, by: Iterable[str], time: str = "time_of_run", tie: str = "id") -> DataFrame:
    """The same by row number. Spark cuts each group to its first row before the shuffle."""
    w = Window.partitionBy(*by).orderBy(F.desc(time), F.desc(tie))
    return ledger.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def newest_by_join(ledger: DataFrame, by: Iterable[str] = GROUP, time: str = "time_of_run") -> DataFrame:
    """All rows that carry the greatest time of their group; no table, no group."""
    by = list(by)
    ledger = ledger.where(F.col("table_name").isNotNull())
    top = ledger.groupBy(*by).agg(F.max(time).alias(time))
    return ledger.join(top, [*by, time]).select(*ledger.columns)


def same(column: str, value) -> Column:
    """Equality in which None matches null."""
    return F.col(column).eqNullSafe(F.lit(value))


def history(ledger: DataFrame, rows: int = HISTORY_ROWS, **filters) -> DataFrame:
    """The newest rows under the filters that are set; a bounded listing."""
    for column, value in filters.items():
        if value:
            ledger = ledger.where(F.col(column) == value)
    return ledger.orderBy(F.desc("time_of_run"), F.desc("id")).limit(rows)


@dataclass(frozen=True)
class Run:
    """What identifies an export run in the ledger."""

    spec_name: str
    spec_md5: str
    tables: tuple[str, ...]
    data_source: str
    project: str | None = None
    server: str | None = None
    key: str | None = None


def candidates(ledger: DataFrame, run: Run) -> DataFrame:
    """Rows a run may resume from, with their ``priority``.

    0: rows of the run's tables, found by key or else by fingerprint.
    1: rows from before tables were recorded.
    2: rows from before project and server were recorded.
    """
    own = same("spec_md5", run.spec_md5) & same("key", run.key)
    by_key = same("key", run.key) if run.key else own
    placed = same("project", run.project) & same("server", run.server)
    bare = same("project", None) & same("server", None)
    no_table = F.col("table_name").isNull()
    priority = (
        F.when(by_key & placed & F.col("table_name").isin(*run.tables), 0)
        .when(own & placed & no_table, 1)
        .when(own & bare & no_table, 2)
    )
    return ledger.withColumn("priority", priority).where(F.col("priority").isNotNull())


def resume_row(ledger: DataFrame, run: Run) -> DataFrame:
    """The row to resume from: of the newest per table, the oldest. At most one row."""
    latest = newest(candidates(ledger, run), ["priority", "table_name"])
    first = F.min(F.struct("priority", "time_of_run", "id", *[
        c for c in ledger.columns if c not in ("time_of_run", "id")
    ])).alias("m")
    picked = latest.agg(first).where(F.col("m").isNotNull())
    return picked.select("m.*").select(*ledger.columns, "priority")


def earliest_of_latest(ledger: DataFrame, by: str = "table_name", time: str = "time_of_run") -> DataFrame:
    """Per table the newest row, then the oldest of those."""
    latest = newest(ledger, [by], time)
    rest = [c for c in ledger.columns if c not in (time, "id")]
    return latest.agg(F.min(F.struct(time, "id", *rest)).alias("m")).select("m.*").select(*ledger.columns)


def without_unfinished(ledger: DataFrame, run: Run) -> DataFrame:
    """The ledger without the non-final rows of this run's tables."""
    stale = (
        ~F.coalesce("final", F.lit(False)) & same("spec_md5", run.spec_md5)
        & same("project", run.project) & same("server", run.server)
        & F.coalesce(F.col("table_name").isin(*run.tables), F.lit(False))
    )
    return ledger.where(~stale)


def with_key(ledger: DataFrame, key: str, **filters) -> DataFrame:
    """The ledger with ``key`` set on the newest row of each table under the filters."""
    chosen = ledger.where(F.col("table_name").isNotNull())
    for column, value in filters.items():
        chosen = chosen.where(same(column, value))
    marked = newest(chosen, GROUP).select("id", F.lit(key).alias("key"))
    return upsert(ledger, marked, "id")


def spec_changed(row: Column | None, run: Run, name: str = "spec_name", md5: str = "spec_md5") -> Column:
    """Whether a stored row was written by another spec."""
    return ~same(md5, run.spec_md5) | ~same(name, run.spec_name)


def start_point(row: Row | None, run: Run, start_over: bool = False, since: str | None = None):
    """Where to start: nothing, what the caller says, a cursor or a date, in that order."""
    if start_over:
        return None
    if since:
        return since
    if row is None:
        return None
    return row["cursor"] if run.data_source == CURSOR_SOURCE else row["since_param"]


def scan_mode(row: Row | None, run: Run, start_over: bool = False, since: str | None = None) -> str:
    """A resumed run keeps its mode; rows without one are from the legacy mode."""
    if start_over or since or row is None:
        return CURSOR_MODE if run.data_source == CURSOR_SOURCE else DATE_MODE
    return row["pagination_mode"] or LEGACY_MODE


def ledger_used(since: str | None, until: str | None) -> bool:
    """A run with bounds of its own neither reads nor moves the ledger."""
    return since is None and until is None


class Ledger:
    """A stored ledger. Record progress only after the table's merge is committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.store = StoredTable(spark, path)

    def rows(self) -> DataFrame:
        if self.store.exists():
            return self.store.read()
        return self.spark.createDataFrame([], SCHEMA)

    def record(
        self, run: Run, since: str, mode: str, final: bool = False, last_doc_id: str | None = None,
        cursor: str | None = None, time_of_run: str | None = None,
    ) -> None:
        """One row per output table; a final one also removes the unfinished."""
        if not since:
            raise ValueError("progress needs a time")
        if not run.tables:
            raise ValueError("progress needs at least one table")
        now = time_of_run or datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None).isoformat()
        new = self.spark.createDataFrame([
            (uuid.uuid4().hex, run.spec_name, run.spec_md5, t, run.key, run.project, run.server,
             since, now, final, run.data_source, last_doc_id, mode, cursor)
            for t in run.tables
        ], SCHEMA)
        held = self.rows()
        self.store.replace(without_unfinished(held, run).unionByName(new) if final else held.unionByName(new))

    def resume(self, run: Run) -> Row | None:
        """The row to resume from; a legacy one is first copied to each table."""
        row = resume_row(self.rows(), run).first()
        if row is not None and row["priority"] > 0:
            self.record(run, row["since_param"], LEGACY_MODE, bool(row["final"]), time_of_run=row["time_of_run"])
            row = resume_row(self.rows(), run).first()
        return row

    def assign_key(self, key: str, **filters) -> None:
        self.store.replace(with_key(self.rows(), key, **filters))
