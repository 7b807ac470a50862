"""Document tables: a DataFrame, what it holds and where its rows start."""

from __future__ import annotations

from dataclasses import dataclass, field as dc_field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variant_field

# The collections a document can come from.
RESOURCES = (
    "form", "case", "user", "location", "application", "web-user",
    "messaging-event", "ucr",
)


@dataclass
class DocTable:
    """One collection of documents.

    ``root`` names the steps to the list whose elements become rows; without
    it every document is one row. ``id_field`` identifies a document.
    ``variant`` names the column that holds the whole document as a variant,
    for documents without a declared schema.
    """

    df: DataFrame
    resource: str
    root: tuple[str, ...] = dc_field(default_factory=tuple)
    id_field: str = "id"
    variant: str | None = None

    def __post_init__(self) -> None:
        if self.resource not in RESOURCES:
            raise ValueError(f"unknown resource {self.resource!r}; known: {', '.join(RESOURCES)}")

    def member(self, name: str) -> Column:
        """A top-level member of the documents: a column, or text from the variant."""
        if self.variant:
            return variant_field(F.col(f"`{self.variant}`"), name)
        return F.col(f"`{name}`")

    def rooted(self, *steps: str) -> "DocTable":
        """The same documents read from a list inside them."""
        return replace(self, root=tuple(s for s in steps if s != "[*]"))


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small constant table written out in the program."""
    return spark.createDataFrame(rows, schema)
