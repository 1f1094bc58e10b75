from feedloom.sinks.loads import append_once, ledger, read_loads, remove_attempts
from feedloom.sinks.reconcile import column_measures, load_verdicts
from feedloom.sinks.tables import (
    align,
    append_table,
    jdbc_options,
    month_replace,
    replace_table,
)
from feedloom.sinks.versioned import publish_version, read_version, remove_versions, versions

__all__ = [
    "align",
    "append_once",
    "append_table",
    "column_measures",
    "jdbc_options",
    "ledger",
    "load_verdicts",
    "month_replace",
    "publish_version",
    "read_loads",
    "read_version",
    "remove_attempts",
    "remove_versions",
    "replace_table",
    "versions",
]
