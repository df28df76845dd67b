"""Scans, sources and sinks (SRC-*), column selection helpers (PRJ-*)."""

from .tables import TABLES, load_table, load_tables, register_views
from .columns import (require_columns, select_existing, numeric_columns,
                      strip_dots, all_plus_derived)

__all__ = ["TABLES", "load_table", "load_tables", "register_views",
           "require_columns", "select_existing", "numeric_columns", "strip_dots",
           "all_plus_derived"]
