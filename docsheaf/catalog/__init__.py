"""Registered queries and the SQL that states the same results."""

from . import documents, functions, ledgers, merging, nested, org, sources  # noqa: F401  (they register)
from .base import QUERIES, SQL
