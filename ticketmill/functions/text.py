"""Text expressions: masking, stripping, first-truthy, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character the stripping rule counts as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: the separator between hashed parts, so ("a","bc") != ("ab","c").
UNIT_SEPARATOR = "\x1f"


def pii_hash(*parts: Column) -> Column:
    """SHA-256 hex of the parts joined by U+001F; a null part counts as ''.

    Never null: "nobody" hashes to a constant.
    """
    # concat_ws skips nulls, which would change the hash, hence the coalesce.
    texts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    return F.sha2(F.concat_ws(UNIT_SEPARATOR, *texts), 256)


def strip_text(text: Column) -> Column:
    """White space removed from both ends of one string."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def clean_ws(value: Column, dtype: T.DataType) -> Column:
    """``strip_text`` on every string leaf of a (nested) column of type ``dtype``."""
    if isinstance(dtype, T.StringType):
        return strip_text(value)
    if isinstance(dtype, T.StructType):
        rebuilt = F.struct(
            *[clean_ws(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        )
        return F.when(value.isNotNull(), rebuilt)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda item: clean_ws(item, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, item: clean_ws(item, dtype.valueType))
    return value


def first_truthy(*texts: Column) -> Column:
    """The first text that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in texts])


def labels_text(labels: Column) -> Column:
    """Non-empty labels joined by ', '; null when there is none."""
    kept = F.filter(labels, lambda label: label.isNotNull() & (label != ""))
    return F.nullif(F.array_join(kept, ", "), F.lit(""))
