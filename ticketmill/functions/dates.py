"""Date and time expressions. Both need the session time zone to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def iso_ts(text: Column) -> Column:
    """ISO time with a mandatory offset (+0000, +00:00 or Z); else null.

    The form of the offset picks the pattern, so a good value is parsed once,
    and a text too short to hold an offset is not tried at all.
    """
    with_colon = F.substring(text, -3, 1) == ":"
    parsed = F.when(with_colon, F.try_to_timestamp(text, F.lit(_ISO + "XXX"))).otherwise(
        F.try_to_timestamp(text, F.lit(_ISO + "XX"))
    )
    return F.when(F.length(text) >= 20, parsed)


def release_date(text: Column) -> Column:
    """``YYYY-MM-DD``, ``DD/Mon/YY HH:MM`` or ``DD/Mon/YY`` as midnight or minute in UTC.

    Two-digit years 69-99 belong to the 1900s. Null for null, '' and for text
    in no known form; a caller that rejects the latter compares with the text.
    """
    short = F.when(
        F.contains(text, F.lit(":")), F.try_to_timestamp(text, F.lit("d/MMM/yy H:m"))
    ).otherwise(F.try_to_timestamp(text, F.lit("d/MMM/yy")))
    century = F.make_ym_interval(F.lit(100))
    pivoted = F.when(F.year(short) >= 2069, short - century).otherwise(short)
    return F.when(F.contains(text, F.lit("/")), pivoted).otherwise(
        F.try_to_timestamp(text, F.lit("yyyy-M-d"))
    )
