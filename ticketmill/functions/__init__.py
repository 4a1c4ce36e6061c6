"""Column expressions. All are built-in Spark functions; none is a UDF."""

from ticketmill.functions.casts import lax_bool, safe_bool, safe_int, safe_str, variant_text
from ticketmill.functions.custom import custom_map, custom_value, json_text, semi_structured
from ticketmill.functions.dates import iso_ts, release_date
from ticketmill.functions.text import clean_ws, first_truthy, labels_text, pii_hash, strip_text

__all__ = [
    "clean_ws",
    "custom_map",
    "custom_value",
    "first_truthy",
    "iso_ts",
    "json_text",
    "labels_text",
    "lax_bool",
    "pii_hash",
    "release_date",
    "safe_bool",
    "safe_int",
    "safe_str",
    "semi_structured",
    "strip_text",
    "variant_text",
]
