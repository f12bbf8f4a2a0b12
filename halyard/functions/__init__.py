"""Column functions. All are built from Spark's own expressions and stay in generated code."""

from .calendar import date_dimension, date_key, los_hours, turnaround_minutes
from .casts import first_of, to_bool, to_date, to_decimal, to_double, to_timestamp
from .hashing import mask_name, mask_ssn, record_hash
from .text import code_system_valid, default_text, strip_reference

__all__ = [
    "code_system_valid",
    "date_dimension",
    "date_key",
    "default_text",
    "first_of",
    "los_hours",
    "mask_name",
    "mask_ssn",
    "record_hash",
    "strip_reference",
    "to_bool",
    "to_date",
    "to_decimal",
    "to_double",
    "to_timestamp",
    "turnaround_minutes",
]
