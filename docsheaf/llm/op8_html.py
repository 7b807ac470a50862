"""Main text of web pages: site templates found by recurring subtrees, then removed.

Each element subtree of a page that could be text (not in a menu, header, form,
advert, comment and the like, which the markup itself tells) is hashed. Spark
counts per host on how many different main texts each hash stands; copies of
one article count once. Subtrees on many of a host's texts are its template:
they are deleted, wherever they are, and the rest is the text.

Hot hosts: counts are taken over (host, hash, main text) first and per (host,
hash) after partial sums. The templates found are written down and joined back
to (page, hash) rows, so that each page learns only of its own.

Cases: null or empty html gives an empty text. A null url, or one without a
host, belongs to the host ''. Broken markup is read as far as it goes: unclosed
elements end with what is around them, an unclosed comment or tag ends the
page. Repeated rows give repeated results. Further columns are ignored. ``br``
counts as white space. Deeply nested pages are read without recursion.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_before, as_text, objects, small_batches, staged, table
from .markup import Page, candidates, main_text

# A subtree is a template's if at least MIN_TEXTS different texts of the host hold it, and this share of all.
MIN_TEXTS = 8
MIN_SHARE = 0.5


def host(url: Column) -> Column:
    name = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(F.lower(name), F.lit(""))


def keyed(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", host(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("page_key"))


def subtrees(rows: DataFrame) -> DataFrame:
    """(page_key, host, body, hashes): subtree hashes per page, and that of its main text."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [candidates(Page(html)) for html in batch["html"]]
            yield pd.DataFrame({"page_key": batch["page_key"], "host": batch["host"],
                                "body": [b for _, b in found], "hashes": objects([h for h, _ in found])})

    return rows.select("page_key", "host", "html").mapInPandas(read, "page_key bigint, host string, body bigint, hashes array<bigint>")


def page_templates(found: DataFrame, min_texts: int = MIN_TEXTS, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_key, templates): the template hashes on each page that has any."""
    texts = found.groupBy("host").agg(F.countDistinct("body").alias("of")).filter(F.col("of") >= min_texts)
    each = found.select("page_key", "host", "body", F.explode("hashes").alias("hash"))
    counts = each.groupBy("host", "hash").agg(F.countDistinct("body").alias("n")).filter(F.col("n") >= min_texts)
    many = counts.join(texts, "host").filter(F.col("n") >= F.lit(min_share) * F.col("of"))
    many = staged(many.select(F.col("host").alias("h"), F.col("hash").alias("x")), "templates")
    hits = each.join(many, (F.col("host") == F.col("h")) & (F.col("hash") == F.col("x")))
    return hits.groupBy("page_key").agg(F.collect_set("hash").alias("templates"))


def extract(pages: DataFrame, min_texts: int = MIN_TEXTS, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text) for every row of ``pages``."""
    small_batches(pages.sparkSession, 256)
    rows = keyed(pages)
    found = staged(subtrees(rows), "subtrees")
    rows = rows.join(page_templates(found, min_texts, min_share), "page_key", "left")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(Page(html), set(t)) for html, t in zip(batch["html"], batch["templates"])]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})

    templates = F.coalesce("templates", F.array().cast("array<bigint>")).alias("templates")
    rows = as_text(rows.select("page_id", "url", "html", templates), "page_id")
    return as_before(rows.mapInPandas(read, "page_id string, url string, text string"), pages, "page_id")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
