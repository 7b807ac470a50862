"""Many tables, and what they reject, from one pass over their source.

Each document gives one array of tagged rows, with the rows of all tables that
are read from it. The array is exploded once, the cells of a row are computed
for its own table only, and one write deals the rows to a folder for each table.
So the source is scanned once, nothing is kept or shuffled, and a table costs no
job of its own. Counts, nulls and rejected cells are observed in that write.

On disk each table has its columns in a struct of its own, which is the only
part a reader of that table touches. Cells whose declared type does not fit lie
beside their row as (column, value).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columntypes import spark_type
from ..operators.contract import check_names
from ..operators.lookup import map_values
from ..sources.ranges import filter_tests, progress_date
from ..sources.tables import DocTable
from .export import ExportSpec, column_cell, column_value, columns_read, plain_text, resolver, row_items

TABLE, REJECTS, DOC = "table", "rejects", "doc"
REJECT = "array<struct<column:string,value:string>>"


@dataclass(frozen=True)
class TableCounts:
    """What one table got: rows, null cells per column, rejected cells, and the newest date of a row's document."""

    rows: int
    nulls: dict[str, int]
    rejected: int
    newest: object = None

    def born(self, spec: ExportSpec) -> list[str]:
        """Columns with a value or a declared type; the others need not exist yet."""
        return [c.name for c in spec.columns if c.data_type or self.nulls[c.name] < self.rows]


def _tagged(doc: DocTable, specs: list[ExportSpec]) -> tuple[DataFrame, list[DocTable]]:
    """One row for each row of each table: its number as ``__tag``, and its item where its table has its own columns."""
    docs, lists = [], []
    for spec in specs:
        own = doc.rooted(*(spec.root or doc.root))
        items, placed = row_items(own, spec) if own.root else (None, False)
        docs.append(own)
        lists.append((items, placed))
    looked = doc.df.select(*[i.alias(f"i{k}") for k, (i, _) in enumerate(lists) if i is not None]).schema
    fields = []
    for k, (items, placed) in enumerate(lists):
        if items is not None:
            item = looked[f"i{k}"].dataType.elementType
            fields.append((f"__child{k}", item["item"].dataType if placed else item))
            if placed:
                fields.append((f"__place{k}", T.StringType()))

    def entry(k: int, pos: Column, found: dict[str, Column]) -> Column:
        return F.struct(F.lit(k).alias("__tag"), pos.cast("int").alias("__pos"), *[
            found.get(name, F.lit(None)).cast(dtype).alias(name) for name, dtype in fields])

    arrays = []
    for k, (spec, (items, placed)) in enumerate(zip(specs, lists)):
        lone = F.array(entry(k, F.lit(None), {}))
        if items is None:
            rows = lone
        else:
            own = (lambda x: {f"__child{k}": x.getField("item"), f"__place{k}": x.getField("place")}) if placed else (lambda x: {f"__child{k}": x})
            rows = F.transform(items, lambda x, i: entry(k, i, own(x)))
            if spec.value_or_root:
                rows = F.when(F.size(items) > 0, rows).otherwise(lone)
        for test in filter_tests(doc.df, spec.filters, doc.member):
            rows = F.when(test, rows)
        arrays.append(F.coalesce(rows, F.array().cast(T.ArrayType(
            T.StructType([T.StructField("__tag", T.IntegerType()), T.StructField("__pos", T.IntegerType()), *[T.StructField(n, t) for n, t in fields]])))))
    tagged = doc.df.select("*", F.explode(F.concat(*arrays)).alias("__row"))
    return tagged.select(*[F.col(f"`{c}`") for c in doc.df.columns], "__row.*"), docs


def route(doc: DocTable, specs: list[ExportSpec], mappings: DataFrame | None = None, dates: list[str] = ()) -> DataFrame:
    """(table, doc, c0, c1, …, rejects): the rows of all tables, each in its table's struct."""
    names = [s.table for s in specs]
    if len(set(names)) < len(names):
        raise ValueError(f"two specs for one table: {', '.join(names)}")
    for spec in specs:
        check_names(spec.table, [c.name for c in spec.columns])
        if doc.resource != spec.resource:
            raise ValueError(f"spec {spec.table} reads {spec.resource}, not {doc.resource}")
    wanted = doc.df.columns if doc.variant else {*columns_read(specs, doc), *dates}
    doc = replace(doc, df=doc.df.select(*[F.col(f"`{c}`") for c in doc.df.columns if c in wanted]))
    rows, docs = _tagged(doc, specs)
    values, columns = [], []
    for k, (spec, own) in enumerate(zip(specs, docs)):
        resolve = resolver(own, rows, f"__child{k}", "__pos", f"__place{k}")
        here = F.col("__tag") == k
        for j, column in enumerate(spec.columns):
            value = column_value(column, resolve, spec.base_url, rows)
            values.append(F.when(here, value).alias(f"v{k}_{j}"))
            columns.append((k, spec, replace(column, name=f"v{k}_{j}"), column.name))
    newest = progress_date([doc.member(d) for d in dates]) if dates else F.lit(None).cast("string")
    rows = rows.select("__tag", doc.member(doc.id_field).cast("string").alias(DOC), newest.alias("__at"), *values)
    for _, _, column, name in columns:
        if column.mapping:
            if mappings is None:
                raise ValueError(f"column {name} needs the mapping {column.mapping}")
            mapped = map_values(rows, mappings, column.mapping, column.name, "__mapped")
            rows = mapped.withColumn(column.name, F.col("__mapped")).drop("__mapped")
    types = rows.schema
    cells, failed = {}, []
    for k, spec, column, name in columns:
        dtype = types[column.name].dataType
        # A missing value stands in the rows of its own table only.
        cell = F.when(F.col("__tag") == k, column_cell(column, dtype, spec.missing_value))
        cells.setdefault(k, []).append(cell.alias(name))
        if column.data_type and spark_type(column.data_type) != "string":
            text = plain_text(F.col(column.name), dtype)
            failed.append(F.struct(F.lit(name).alias("column"), text.alias("value"), (text.isNotNull() & cell.isNull()).alias("failed")))
    rejects = F.array().cast(REJECT)
    if failed:
        hits = F.filter(F.array(*failed), lambda x: x.getField("failed"))
        rejects = F.transform(hits, lambda x: F.struct(x.getField("column").alias("column"), x.getField("value").alias("value")))
    table = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("__tag") + 1)
    structs = [F.when(F.col("__tag") == k, F.struct(*cells[k])).alias(f"c{k}") for k in range(len(specs))]
    return rows.select(table.alias(TABLE), DOC, "__at", *structs, rejects.alias(REJECTS))


class RoutedTables:
    """The tables that one routed write has filled."""

    def __init__(self, spark: SparkSession, folder: str, specs: list[ExportSpec], schema: T.StructType):
        self.spark, self.folder, self.specs, self.schema = spark, folder, list(specs), schema

    def _all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder)

    def table(self, name: str) -> DataFrame:
        """One table; its files hold nothing that is not read."""
        number = [s.table for s in self.specs].index(name)
        return self._all().where(F.col(TABLE) == name).select(f"c{number}.*")

    def rejects(self) -> DataFrame:
        """(table, id, column, value) of every cell that does not fit its declared type; ``id`` is the document's."""
        return self._all().select(TABLE, F.col(DOC).alias("id"), F.explode(REJECTS).alias("r")).select(TABLE, "id", "r.column", "r.value")


def export_routed(
    doc: DocTable, specs: list[ExportSpec], folder: str, mappings: DataFrame | None = None, dates: list[str] = (),
) -> tuple[RoutedTables, dict[str, TableCounts]]:
    """Write all tables of one source in one pass, and say what each of them got.

    ``dates`` are tried in order for the date of a document, for the newest one
    of each table.
    """
    rows = route(doc, specs, mappings, dates)
    schema = rows.drop("__at").schema
    seen = {}
    for k, spec in enumerate(specs):
        here = F.col(TABLE) == spec.table
        nulls = [F.count_if(here & F.col(f"c{k}.`{c.name}`").isNull()).alias(f"n{j}") for j, c in enumerate(spec.columns)]
        seen[spec.table] = Observation()
        rows = rows.observe(
            seen[spec.table], F.count_if(here).alias("rows"), F.sum(F.when(here, F.size(REJECTS))).alias("rejected"),
            F.max(F.when(here, F.col("__at"))).alias("newest"), *nulls)
    rows.drop("__at").write.partitionBy(TABLE).parquet(folder)
    counts = {}
    for spec in specs:
        got = seen[spec.table].get
        nulls = {c.name: got[f"n{j}"] for j, c in enumerate(spec.columns)}
        counts[spec.table] = TableCounts(got["rows"], nulls, got["rejected"] or 0, got["newest"])
    return RoutedTables(doc.df.sparkSession, folder, specs, schema), counts
