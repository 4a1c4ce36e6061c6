"""Issue listings of good boards -> checked issues, one copy per project."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions import (
    custom_map,
    first_truthy,
    iso_ts,
    labels_text,
    lax_bool,
    safe_int,
    variant_text,
)
from ticketmill.operators.dedupe import entry_marks, first_board_wins, first_places, marked_only, only_first_places
from ticketmill.operators.transitions import tracked_histories
from ticketmill.operators.validity import first_reason
from ticketmill.schemas import CORRUPT, TRACKED_FIELDS, issue_wire
from ticketmill.sources.storage import Stage, is_small, unstaged


def parse_issues(
    issues: DataFrame,
    custom_fields: Mapping[str, str] | None = None,
    details: bool | Collection[str] = True,
    histories: bool = True,
    history_keys_only: bool = False,
) -> DataFrame:
    """``issues(board_id, ord, body)`` with the body parsed once into columns.

    The wire schema holds only the fields that are used, custom fields by
    their configured ids, so unknown ones are skipped while parsing. A caller
    that reads a few standard fields names them in ``details``.
    ``inline`` keeps the parse in one place: a filter or projection on its
    output is not rewritten into another parse of the same text.
    """
    wire = issue_wire(tuple((custom_fields or {}).values()), details, histories, history_keys_only)
    parsed = F.from_json("body", wire, {"columnNameOfCorruptRecord": CORRUPT})
    return issues.select("board_id", "ord", "body", F.inline(F.array(parsed)))


def in_date_range(created: Column, updated: Column, start: str | None, end: str | None) -> Column:
    """Created or updated on or after ``start``, and created or updated up to
    midnight at the start of ``end``. A null time does not match."""
    matches = F.lit(True)
    if start:
        since = F.lit(start).cast("timestamp")
        matches = matches & ((created >= since) | (updated >= since))
    if end:
        until = F.lit(end).cast("timestamp")
        matches = matches & ((created <= until) | (updated <= until))
    return matches


def _epic_done() -> Column:
    done = F.col("fields.epic.done")
    return F.when(~F.is_variant_null(done), lax_bool(variant_text(done, "")))


def _custom(custom_fields: Mapping[str, str], typed_fields: set[str]) -> Column:
    values = {}
    for name, field_id in custom_fields.items():
        if field_id in typed_fields:
            # A standard field, parsed into a type of its own: read it once more as it is.
            whole = F.try_parse_json("body")
            values[name] = F.try_variant_get(whole, f"$.fields.{field_id}", "variant")
        else:
            values[name] = F.col("fields").getField(field_id)
    return custom_map(values)


def _details(parsed: DataFrame, custom_fields: Mapping[str, str]) -> list[Column]:
    """The columns of the issues relation that nothing but that relation reads, of the standard fields that were parsed."""
    fields = parsed.schema["fields"].dataType
    standard = {f.name for f in fields if not isinstance(f.dataType, T.VariantType)}
    by_field = {
        "issuetype": [
            safe_int(F.col("fields.issuetype.id")).alias("issuetype_id"),
            F.col("fields.issuetype.name").alias("issue_type"),
        ],
        "parent": [
            safe_int(F.col("fields.parent.id")).alias("parent_task_id"),
            F.col("fields.parent.key").alias("parent_task_key"),
        ],
        "priority": [
            F.col("fields.priority.name").alias("priority"),
            safe_int(F.col("fields.priority.id")).alias("priority_id"),
        ],
        "status": [
            safe_int(F.col("fields.status.id")).alias("status_id"),
            F.col("fields.status.name").alias("status_name"),
            safe_int(F.col("fields.status.statusCategory.id")).alias("status_category_id"),
            F.col("fields.status.statusCategory.name").alias("status_category_name"),
            F.col("fields.status.statusCategory.colorName").alias("status_category_colour"),
        ],
        "epic": [
            safe_int(F.col("fields.epic.id")).alias("epic_id"),
            F.col("fields.epic.key").alias("epic_key"),
            F.col("fields.epic.name").alias("epic_name"),
            first_truthy(F.col("fields.epic.summary")).alias("epic_summary"),
        ],
        "summary": [F.col("fields.summary").alias("summary")],
        "labels": [labels_text(F.col("fields.labels")).alias("labels")],
    }
    parsed_whole = {name for name in standard if name != "epic" or len(fields["epic"].dataType) > 1}
    columns = [column for name, own in by_field.items() if name in parsed_whole for column in own]
    return [*columns, _custom(custom_fields, standard).alias("custom_fields")] if columns else []


def flatten_issues(
    parsed: DataFrame,
    custom_fields: Mapping[str, str] | None = None,
    history_fields: Sequence[str] = TRACKED_FIELDS,
    history_keys_only: bool = False,
) -> DataFrame:
    """The issue columns that come from the body, with ``reason`` and ``histories``.

    An absent nested object reads as empty; bad nested ids and times become
    null and never reject. The raw text is kept for invalid rows only, so it
    does not travel through the shuffles behind this step. Columns follow what
    ``parse_issues`` was asked to read.
    """
    done = F.col("fields.epic.done")
    columns = [
        F.nullif(F.col("id"), F.lit("")).alias("issue_ref"),
        safe_int(F.col("id")).alias("id"),
        F.col("key"),
        iso_ts(F.col("fields.created")).alias("created"),
        iso_ts(F.col("fields.updated")).alias("updated"),
        _epic_done().alias("epic_done"),
        F.coalesce(done.isNotNull() & ~F.is_variant_null(done), F.lit(False)).alias("done_given"),
    ]
    columns += _details(parsed, custom_fields or {})
    if "changelog" in parsed.columns:
        tracked = tracked_histories(F.col("changelog.histories"), history_fields, history_keys_only)
        columns.append(tracked.alias("histories"))
    flat = parsed.select("board_id", "ord", "body", CORRUPT, *columns)
    reason = first_reason(
        (F.col("issue_ref").isNull() & F.col(CORRUPT).isNotNull(), "body is no readable object"),
        (F.col("issue_ref").isNull(), "id is blank"),
        (F.col("id").isNull(), "id is not an integer"),
        (F.col("key").isNull(), "key is missing"),
        (F.col("done_given") & F.col("epic_done").isNull(), "epic_done is not a boolean"),
    )
    checked = flat.withColumn("reason", reason)
    raw = F.when(F.col("reason").isNotNull(), F.col("body"))
    return checked.withColumn("raw", raw).drop("body", CORRUPT, "done_given")


def list_issues(flat: DataFrame, good_boards: DataFrame) -> DataFrame:
    """Listing entries joined with their good board, hence with the project
    being read, whose id, key and name the issue takes over."""
    owners = good_boards.select(
        F.col("board_id").alias("listed_on"),
        "board_ord",
        "project_id",
        F.col("owner_key").alias("project_key"),
        F.col("owner_name").alias("project_name"),
    )
    return flat.join(owners, flat.board_id == owners.listed_on, "inner").drop("listed_on")


def check_issues(
    issues: DataFrame,
    good_boards: DataFrame,
    start_date: str | None = None,
    end_date: str | None = None,
    custom_fields: Mapping[str, str] | None = None,
    details: bool = True,
    histories: bool = True,
    stage: Stage = unstaged,
    history_fields: Sequence[str] = TRACKED_FIELDS,
    history_keys_only: bool = False,
    one_copy: bool = False,
) -> DataFrame:
    """Parse, date range, board join, first board wins; then the rows carry
    their ``reason``. An invalid copy still counts as the first one seen.

    ``details`` and ``histories`` say whether issues and transitions are
    wanted; what is not wanted is not even parsed. Of the histories only the
    items of ``history_fields``, or their keys, go through the joins.

    With a stage that writes, parsed entries are staged as they come, and first
    places are found from their keys alone and only for issues that a project
    lists more than once. Details and histories then move in no shuffle, as
    long as boards and repeated issues are small; where they are not, the
    winners are chosen by keys too, and only their details and histories move,
    once, and are staged. A board that is there twice at one place gives its
    entries twice then, and once with ``one_copy`` or without a stage."""
    parsed = parse_issues(issues, custom_fields, details, histories, history_keys_only)
    flat = flatten_issues(parsed, custom_fields, history_fields, history_keys_only)
    if start_date or end_date:
        flat = flat.where(in_date_range(F.col("created"), F.col("updated"), start_date, end_date))
    if stage is unstaged:
        winners = first_board_wins(list_issues(flat, good_boards))
    else:
        if one_copy:
            good_boards = good_boards.dropDuplicates(["board_id", "board_ord", "project_id"])
        flat = stage(flat.withColumn("entry", F.monotonically_increasing_id()), "parsed_entries")
        # Of one place that landed twice the earlier entry stays.
        place = F.struct("board_ord", "ord", "entry")
        listed = list_issues(flat, good_boards).withColumn("place", place)
        repeated = stage(first_places(listed.select("project_id", "issue_ref", "place")), "repeated")
        if is_small(repeated) and is_small(good_boards):
            winners = only_first_places(listed, repeated).drop("place", "entry")
        else:
            keys = flat.select("board_id", "ord", "issue_ref", "entry")
            placed = list_issues(keys, good_boards).withColumn("place", place)
            chosen = only_first_places(placed, repeated).drop("place", *keys.columns[:3])
            marked = marked_only(flat, stage(entry_marks(chosen), "chosen"))
            winners = stage(marked.join(chosen, "entry").drop("entry"), "issues")
    return winners.withColumnRenamed("issue_ref", "entity_id").drop("board_id", "ord", "board_ord")
