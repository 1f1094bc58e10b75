from feedloom.functions.json_types import json_type, strict_double
from feedloom.functions.keys import base_name, calendar_month_key, month_key, ordinal_label, request_key

__all__ = [
    "base_name",
    "calendar_month_key",
    "json_type",
    "month_key",
    "ordinal_label",
    "request_key",
    "strict_double",
]
