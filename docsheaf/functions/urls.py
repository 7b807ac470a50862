"""Web addresses of documents and their attachments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import template

# The address layouts. The places are base, domain, document id
# and, for an attachment, its file name.
DOC_LAYOUTS = {
    "form": "{}/a/{}/reports/form_data/{}/",
    "case": "{}/a/{}/reports/case_data/{}/",
}
ATTACHMENT_LAYOUT = "{}/a/{}/api/form/attachment/{}/{}"


def doc_url(kind: str, base: str, domain: Column, doc_id: Column) -> Column:
    return template(DOC_LAYOUTS[kind], F.lit(base), domain, doc_id)


def attachment_url(base: str, domain: Column, doc_id: Column, name: Column) -> Column:
    """Address of one attachment; an empty name has none."""
    name = name.cast("string")
    address = template(ATTACHMENT_LAYOUT, F.lit(base), domain, doc_id, name)
    return F.when(name != "", address)


def attachment_urls(base: str, domain: Column, doc_id: Column, names: Column) -> Column:
    """One address per element of a list of names."""
    return F.transform(names, lambda n: attachment_url(base, domain, doc_id, n))
