from feedloom.operators.checks import preview, require_rows, require_settings, row_counter
from feedloom.operators.envelope import classify, unnest
from feedloom.operators.lookup import lookup_join
from feedloom.operators.paging import latest_runs, resolve_batches, resolve_pages, run_bounds
from feedloom.operators.project import project_documents, type_audit
from feedloom.operators.rejects import Apart, judge_records, set_apart
from feedloom.operators.slots import flatten_slots, unpivot_columns

__all__ = [
    "Apart",
    "classify",
    "flatten_slots",
    "judge_records",
    "latest_runs",
    "lookup_join",
    "preview",
    "project_documents",
    "require_rows",
    "require_settings",
    "resolve_batches",
    "resolve_pages",
    "row_counter",
    "run_bounds",
    "set_apart",
    "type_audit",
    "unnest",
    "unpivot_columns",
]
