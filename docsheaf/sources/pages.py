"""Landed API pages: one JSON envelope per line, documents in ``objects``."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import key_of, last_value

# Times without a zone, with or without microseconds. Read times that carry a
# zone as text and turn them with to_datetime.
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}
META = "struct<next:string,previous:string,offset:bigint,limit:bigint,total_count:bigint>"


def envelope_schema(document: T.StructType | str) -> str:
    text = document if isinstance(document, str) else document.simpleString()
    return f"meta {META}, objects array<{text}>"


def documents_of(envelopes: DataFrame) -> DataFrame:
    """One row per document, with the document's fields as columns."""
    return envelopes.select(F.explode("objects").alias("doc")).select("doc.*")


def read_pages(spark: SparkSession, folder: str, document: T.StructType | str) -> DataFrame:
    """All pages of a folder, read in parallel with a declared schema."""
    return documents_of(spark.read.schema(envelope_schema(document)).options(**JSON_TIMES).json(folder))


def read_pages_untyped(spark: SparkSession, folder: str) -> DataFrame:
    """All documents of a folder as one variant column ``doc``."""
    pages = spark.read.schema("meta variant, objects array<variant>").json(folder)
    return pages.select(F.explode("objects").alias("doc"))


def variant_schema(df: DataFrame, column: str = "doc") -> str:
    """The type all documents of a variant column share, seen from every row.

    A member whose values are of different kinds stays a variant, one that is
    always null is text. Members become fields, so this is for documents whose
    names are a vocabulary, not data.
    """
    found = df.agg(F.schema_of_variant_agg(column)).first()[0]
    return found.replace("OBJECT<", "STRUCT<").replace(": VOID", ": STRING")


def typed_documents(df: DataFrame, column: str = "doc", schema: str | None = None) -> DataFrame:
    """Schema-free documents with their members as columns."""
    schema = schema or variant_schema(df, column)
    return df.select(F.try_variant_get(column, "$", schema).alias("d")).select("d.*")


def stream_pages(
    spark: SparkSession, folder: str, document: T.StructType | str, files_per_batch: int = 1000
) -> DataFrame:
    """The same as a stream of newly landed files."""
    reader = spark.readStream.schema(envelope_schema(document)).options(**JSON_TIMES)
    return documents_of(reader.option("maxFilesPerTrigger", files_per_batch).json(folder))


def one_per_id(df: DataFrame, id_columns: list[str], order: Column | None = None) -> DataFrame:
    """One document per id, however often pages overlap.

    With ``order`` the greatest is kept, otherwise the greatest by content, so
    the outcome does not depend on which task sees which copy. Each task
    reduces its own copies first, so a much repeated id costs one row per task
    in the shuffle. A document without an id fails the job; it cannot be told
    apart from others.
    """
    df = df.withColumns({c: key_of(df, c) for c in id_columns})
    others = [c for c in df.columns if c not in id_columns]
    if not others:
        return df.distinct()
    content = F.struct(*[F.col(f"`{c}`") for c in others])
    dtype = T.StructType([df.schema[c] for c in others])
    kept = last_value(content, dtype, F.lit(0) if order is None else order)
    return df.groupBy(*id_columns).agg(kept.alias("r")).select(*id_columns, "r.*").select(*df.columns)


def write_pages(df: DataFrame, folder: str, rows_per_page: int = 1000) -> None:
    """Land documents as pages of a bounded size; test input for the readers above.

    Each task makes pages of its own rows as they come, so nothing is shuffled
    and no group is gathered.
    """
    def to_pages(batches):
        for batch in batches:
            docs = batch["doc"]
            for at in range(0, len(docs), rows_per_page):
                page = docs.iloc[at:at + rows_per_page]
                meta = f'{{"limit":{rows_per_page},"offset":{at}}}'
                yield pd.DataFrame({"value": [f'{{"meta":{meta},"objects":[{",".join(page)}]}}']})

    docs = df.select(F.to_json(F.struct("*"), JSON_TIMES).alias("doc"))
    docs.mapInPandas(to_pages, "value string").write.text(folder)
