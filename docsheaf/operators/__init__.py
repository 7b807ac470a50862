"""Operators over DataFrames."""

from .columntypes import (
    align, as_text, choose_types, common_type, declared_columns, fits, infer_columns,
    kind_of, rejects, spark_type, type_evidence, without_empty_columns,
)
from .contract import ContractError, check_names, contract_report, width_profile
from .hierarchy import ancestor_columns, ancestors, clean_name, level_depths, ordered_codes
from .lookup import last_per_source, look_up, map_values, unknown_references
from .merge import append, collapse, upsert
from .org import locations_table, roll_up, users_table
from .unnest import (
    bind, child_or_root_rows, child_rows, child_rows_at, is_root_row, named_scope, present_rows,
)
