"""Row validity: a reason column, and the split into good rows and rejects."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.schemas import RECORDS


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The text of the first failing check; null for a valid row.

    A check is (the row is wrong, why); an unknown outcome counts as not wrong.
    """
    return F.coalesce(*[F.when(wrong, F.lit(text)) for wrong, text in checks])


def good(checked: DataFrame, relation: str, extra: Iterable[str] = ()) -> DataFrame:
    """Valid rows in the relation's declared columns and types, then ``extra`` ones."""
    return typed(checked.where(F.col("reason").isNull()), relation, extra)


def typed(df: DataFrame, relation: str, extra: Iterable[str] = ()) -> DataFrame:
    """Every column of the relation, in order, cast to its declared type.

    A column the frame lacks becomes a typed null.
    """
    schema = RECORDS[relation]
    present = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*columns, *[name for name in extra if name not in schema.names])


def rejects(checked: DataFrame, relation: str) -> DataFrame:
    """Invalid rows as (relation, entity_id, reason, raw)."""
    return checked.where(F.col("reason").isNotNull()).select(
        F.lit(relation).alias("relation"), "entity_id", "reason", "raw"
    )
