"""Sinks."""

from .files import json_cells, read_csv, text_cells, write_csv, write_jdbc, write_json
from .store import StoredTable
