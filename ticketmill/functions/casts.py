"""Lenient casts: a value that does not fit becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two word lists of the boolean parser ...
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
# ... and those of record validation, which takes a few more spellings.
LAX_TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
LAX_FALSE_WORDS = ("0", "off", "f", "false", "n", "no")


def safe_str(value: Column) -> Column:
    """Text of the value; '' for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def safe_int(text: Column) -> Column:
    """Whole number or null; '', 'None', '3.9' and overflow are null.

    The pattern keeps other text away from the cast, which would raise and
    catch an error for each such value; the cast still decides on overflow.
    """
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("bigint"))


def _words(text: Column, true_words: tuple[str, ...], false_words: tuple[str, ...]) -> Column:
    lowered = F.lower(text.cast("string"))
    return F.when(lowered.isin(*true_words), True).when(lowered.isin(*false_words), False)


def safe_bool(text: Column) -> Column:
    """true/1/yes and false/0/no in any case; anything else is null."""
    return _words(text, TRUE_WORDS, FALSE_WORDS)


def lax_bool(text: Column) -> Column:
    """The boolean spellings that record validation takes; anything else is null."""
    return _words(text, LAX_TRUE_WORDS, LAX_FALSE_WORDS)


def variant_text(value: Column, default: str) -> Column:
    """Text of a VARIANT: ``default`` when the field is absent, null when it is null."""
    return F.when(value.isNull(), F.lit(default)).otherwise(
        F.try_variant_get(value, "$", "string")
    )
