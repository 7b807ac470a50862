"""Sources."""

from .pages import (
    one_per_id, read_pages, read_pages_untyped, stream_pages, typed_documents, variant_schema,
    write_pages,
)
from .ranges import (
    in_range, keyset_page, match_filters, next_cursor, progress_date, since_until,
    since_until_fallback,
)
from .related import inline_children, related_rows
from .tables import RESOURCES, DocTable, inline_rows, load
