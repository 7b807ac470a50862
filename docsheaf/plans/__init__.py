"""Export specs and the progress ledger."""

from .export import ColumnSpec, ExportSpec, export, export_many, with_actor
from .ledger import Ledger, Run
from .routed import RoutedTables, TableCounts, export_routed, route
from .run import Progress, run_export
