"""A stream of documents into several tables, with its progress in the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import collapse
from ..plans.export import ExportSpec, export
from ..plans.ledger import DATE_MODE, Ledger, Run, resume_row
from ..session import fresh_dir
from ..sinks.store import StoredTable
from ..sources.tables import DocTable

CHANGED = "changed_on"


def batch_done(ledger: Ledger, run: Run) -> int:
    """The number of the last batch that all tables of the run have; -1 before the first."""
    row = resume_row(ledger.rows(), run).first()
    return -1 if row is None or row["cursor"] is None else int(row["cursor"])


def export_batch(
    docs: DocTable, number: int, specs: list[ExportSpec], folder: str, run: Run, time: str, ledger: Ledger,
    parts: int = 1, mappings: DataFrame | None = None,
) -> bool:
    """Merge one batch into the table of each spec, then record its number; False if it was there before.

    Every table keeps the date of its rows' documents as ``changed_on``: a row
    that comes late only fills nulls. The batch is written down once, for all
    tables. A run that dies between two tables repeats its batch, which changes
    nothing where it is merged already.
    """
    if number <= batch_done(ledger, run):
        return False
    spark, path = docs.df.sparkSession, fresh_dir(docs.df.sparkSession, "landed")
    docs.df.write.parquet(path)
    held = DocTable(spark.read.schema(docs.df.schema).parquet(path), docs.resource, docs.root, docs.id_field, docs.variant)
    at = held.member(time)
    for spec in specs:
        rows = collapse(export(held, spec, mappings, carry={CHANGED: at}), "id", F.col(CHANGED))
        StoredTable(spark, f"{folder}/{spec.table}", "id", parts).merge(rows, time=CHANGED)
    last = held.df.agg(F.max(F.struct(at.alias("at"), held.member(held.id_field).cast("string").alias("id"))).alias("m")).first()["m"]
    if last is not None:
        newest = last["at"]
        since = newest.isoformat() if hasattr(newest, "isoformat") else str(newest)
        before = resume_row(ledger.rows(), run).first()
        late = before is not None and before["since_param"] > since
        ledger.record(run, before["since_param"] if late else since, DATE_MODE, final=True,
                      last_doc_id=before["last_doc_id"] if late else last["id"], cursor=str(number))
    return True


def stream_specs(
    stream: DataFrame, resource: str, specs: list[ExportSpec], folder: str, run: Run, time: str, ledger: Ledger,
    checkpoint: str, id_field: str = "id", variant: str | None = None, parts: int = 1, mappings: DataFrame | None = None,
) -> StreamingQuery:
    """Export everything that has landed to all tables, and stop.

    A batch that the checkpoint replays, because the stream died before it was
    marked as done there, is recognised by its number in the ledger. ``run``
    belongs to one checkpoint: numbers start again with a new one, so give the
    new stream a key of its own.
    """
    def one_batch(batch: DataFrame, number: int) -> None:
        export_batch(DocTable(batch, resource, (), id_field, variant), number, specs, folder, run, time, ledger, parts, mappings)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(one_batch).start()
