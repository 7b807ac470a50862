"""Column functions."""

from .arith import add, divide, floor_divide, multiply, subtract
from .convert import (
    format_uuid, sha1_text, to_datetime, to_exact_number, to_integer, to_json_text, to_number,
)
from .lists import (
    cell_text, distinct_items, items_where, join_items, length_of, unwrap_single, variant_cell, variant_json,
    xml_text,
)
from .logic import (
    bool_to_int, default_value, first_present, is_empty, is_truthy, to_bool,
)
from .paths import (
    auto_id, bound, descendants, descendants_of, dynamic_field, each, each_present, field, field_or_null,
    index_at, index_range, variant_descendants, variant_field, variant_items, variant_list,
    variant_missing,
)
from .registry import FUNCTIONS, LIST_FUNCTIONS, call, register, register_row_function, via
from .text import (
    count_selected, join_text, selected, selected_at, substr_range, template, words,
)
from .urls import attachment_url, attachment_urls, doc_url
