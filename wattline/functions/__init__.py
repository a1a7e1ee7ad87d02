from wattline.functions.calendar import date_spine, degree_days, calendar_columns
from wattline.functions.keys import LOAD_AUDIT, load_audit_columns, surrogate_key
from wattline.functions.numbers import exact, exact_avg, exact_sum, pence_to_pounds, rounded
from wattline.functions.text import cast_columns, ensure_columns, is_blank, trim_strings

__all__ = [
    "LOAD_AUDIT",
    "calendar_columns",
    "cast_columns",
    "date_spine",
    "degree_days",
    "ensure_columns",
    "exact",
    "exact_avg",
    "exact_sum",
    "is_blank",
    "load_audit_columns",
    "pence_to_pounds",
    "rounded",
    "surrogate_key",
    "trim_strings",
]
