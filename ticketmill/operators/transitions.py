"""Change histories of good issues -> checked transitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import first_truthy, iso_ts, pii_hash, safe_int, variant_text
from ticketmill.operators.validity import first_reason
from ticketmill.schemas import TRACKED_FIELDS


def tracked_items(items: Column, fields: Sequence[str] = TRACKED_FIELDS) -> Column:
    """The items of one history whose field is tracked (exact, case-sensitive)."""
    return F.filter(items, lambda item: item.getField("field").isin(*fields))


def numbered(histories: Column) -> Column:
    """Histories with a numeric id; the others drop out whole, never as id 0."""
    return F.filter(histories, lambda history: safe_int(history.getField("id")).isNotNull())


def tracked_histories(
    histories: Column, fields: Sequence[str] = TRACKED_FIELDS, keys_only: bool = False
) -> Column:
    """Only what can become a transition, so that nothing else is shuffled.

    With ``keys_only`` that is a history's id, and of its items the field and its type.
    """

    def kept(history: Column) -> Column:
        items = tracked_items(history.getField("items"), fields)
        if not keys_only:
            return history.withField("items", items)
        keys = F.transform(items, lambda item: F.struct(item["field"].alias("field"), item["fieldtype"].alias("fieldtype")))
        return F.struct(history["id"].alias("id"), keys.alias("items"))

    return F.filter(F.transform(numbered(histories), kept), lambda history: F.size(history["items"]) > 0)


def explode_histories(issues: DataFrame, keys_only: bool = False) -> DataFrame:
    """``issues(id, key, project_id, histories)`` -> one row per item, with its history's
    values and its place (``hist_ord``, ``item_ord``). Null lists give no rows."""
    rest = [] if keys_only else [F.col("h.created").alias("created_text"), F.col("h.author").alias("author")]
    per_history = issues.select(
        "project_id",
        F.col("id").alias("issue_id"),
        F.col("key").alias("issue_key"),
        F.posexplode("histories").alias("hist_ord", "h"),
    )
    return per_history.select(
        "project_id",
        "issue_id",
        "issue_key",
        "hist_ord",
        safe_int(F.col("h.id")).alias("transition_id"),
        *rest,
        F.posexplode("h.items").alias("item_ord", "item"),
    )


def author_hash(author: Column) -> Column:
    """Hash of the display name with the key, or the account id where there is none."""
    account = first_truthy(author.getField("key"), author.getField("accountId"))
    return pii_hash(author.getField("displayName"), account)


def _values(item: Column) -> list[Column]:
    old, new = item.getField("from"), item.getField("to")
    old_text, new_text = item.getField("fromString"), item.getField("toString")
    is_person = item.getField("field") == "assignee"
    return [
        author_hash(F.col("author")).alias("hashed_author"),
        iso_ts(F.col("created_text")).alias("created"),
        F.when(~is_person, first_truthy(old)).alias("from_id"),
        F.when(is_person, pii_hash(old_text, old)).otherwise(first_truthy(old_text)).alias("from_string"),
        F.when(~is_person, first_truthy(new)).alias("to_id"),
        F.when(is_person, pii_hash(new_text, new)).otherwise(first_truthy(new_text)).alias("to_string"),
    ]


def check_transitions(good_issues: DataFrame, keys_only: bool = False) -> DataFrame:
    """An assignee's names and ids become hashes and its plain ids null;
    elsewhere an empty text becomes null. With ``keys_only`` rows lack all of this."""
    item = F.col("item")
    values = [] if keys_only else _values(item)
    flat = explode_histories(good_issues, keys_only).select(
        "transition_id",
        item.getField("field").alias("transition_field"),
        variant_text(item.getField("fieldtype"), "").alias("transition_field_type"),
        "issue_id",
        "issue_key",
        *values,
        "project_id",
        "hist_ord",
        "item_ord",
        "item",
    )
    checked = flat.withColumn(
        "reason", first_reason((F.col("transition_field_type").isNull(), "fieldtype is null"))
    )
    return (
        checked.withColumn("raw", F.when(F.col("reason").isNotNull(), F.to_json("item")))
        .withColumn("entity_id", F.col("transition_id").cast("string"))
        .drop("item")
    )
