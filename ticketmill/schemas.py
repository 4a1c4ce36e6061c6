"""Output schemas of the five relations, their keys, and the wire schemas."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import types as T

DATA_TYPES = ("projects", "releases", "boards", "issues", "transitions")

_BIGINT, _STRING, _BOOLEAN, _TIMESTAMP = (
    T.LongType(),
    T.StringType(),
    T.BooleanType(),
    T.TimestampType(),
)
_CUSTOM = T.MapType(_STRING, _STRING)


def _record(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RECORDS: dict[str, T.StructType] = {
    "projects": _record(
        id=_BIGINT,
        key=_STRING,
        name=_STRING,
        project_type_key=_STRING,
        archived=_BOOLEAN,
        project_category_id=_STRING,
        project_category_name=_STRING,
        project_category_description=_STRING,
        lead_hash=_STRING,
    ),
    "releases": _record(
        release_id=_BIGINT,
        release_name=_STRING,
        project_id=_BIGINT,
        project_key=_STRING,
        archived=_BOOLEAN,
        released=_BOOLEAN,
        release_date=_TIMESTAMP,
        user_release_date=_TIMESTAMP,
    ),
    "boards": _record(
        board_id=_BIGINT,
        project_id=_BIGINT,
        name=_STRING,
        board_type=_STRING,
    ),
    "issues": _record(
        id=_BIGINT,
        key=_STRING,
        project_id=_BIGINT,
        project_key=_STRING,
        project_name=_STRING,
        issuetype_id=_BIGINT,
        issue_type=_STRING,
        parent_task_id=_BIGINT,
        parent_task_key=_STRING,
        priority=_STRING,
        priority_id=_BIGINT,
        status_id=_BIGINT,
        status_name=_STRING,
        status_category_id=_BIGINT,
        status_category_name=_STRING,
        status_category_colour=_STRING,
        epic_id=_BIGINT,
        epic_key=_STRING,
        epic_name=_STRING,
        epic_summary=_STRING,
        epic_done=_BOOLEAN,
        summary=_STRING,
        labels=_STRING,
        created=_TIMESTAMP,
        updated=_TIMESTAMP,
        custom_fields=_CUSTOM,
    ),
    "transitions": _record(
        transition_id=_BIGINT,
        transition_field=_STRING,
        transition_field_type=_STRING,
        issue_id=_BIGINT,
        issue_key=_STRING,
        hashed_author=_STRING,
        created=_TIMESTAMP,
        from_id=_STRING,
        from_string=_STRING,
        to_id=_STRING,
        to_string=_STRING,
    ),
}

REJECTS = _record(relation=_STRING, entity_id=_STRING, reason=_STRING, raw=_STRING)

# Load keys and the columns a table load must not leave null.
KEYS: dict[str, tuple[str, ...]] = {
    "projects": ("id",),
    "releases": ("release_id",),
    "boards": ("board_id",),
    "issues": ("id",),
    "transitions": ("transition_id", "issue_id", "transition_field"),
}
REQUIRED: dict[str, tuple[str, ...]] = {
    "projects": ("id", "key"),
    "releases": ("release_id", "project_id"),
    "boards": ("board_id", "project_id"),
    "issues": ("id", "key"),
    "transitions": ("transition_id", "transition_field", "issue_id"),
}

# Which of two rows with one load key came first. Where an issue was reached
# from two projects, that of the lower project id; within a project the place
# in the source decides.
LOAD_ORDER: dict[str, tuple[str, ...]] = {
    "projects": ("key", "name"),
    "releases": ("project_id", "version_ord"),
    "boards": ("project_id", "board_ord"),
    "issues": ("project_id", "key"),
    "transitions": ("project_id", "hist_ord", "item_ord"),
}

# Column widths of the SQL tables (used when a caller asks for them).
WIDTHS: dict[str, dict[str, int]] = {
    "projects": {
        "key": 32,
        "name": 256,
        "project_type_key": 64,
        "project_category_id": 32,
        "project_category_name": 256,
        "project_category_description": 1024,
        "lead_hash": 64,
    },
    "releases": {"project_key": 32, "release_name": 256},
    "boards": {"name": 256, "board_type": 32},
    "issues": {
        "key": 32,
        "project_key": 32,
        "project_name": 256,
        "issue_type": 128,
        "parent_task_key": 32,
        "priority": 64,
        "status_name": 128,
        "status_category_name": 128,
        "status_category_colour": 64,
        "epic_key": 32,
        "epic_name": 256,
        "epic_summary": 1024,
        "summary": 1024,
        "labels": 1024,
    },
    "transitions": {
        "transition_field": 128,
        "transition_field_type": 64,
        "issue_key": 32,
        "hashed_author": 64,
        "from_id": 256,
        "from_string": 1024,
        "to_id": 256,
        "to_string": 1024,
    },
}

# The change-history fields kept as transitions.
TRACKED_FIELDS = (
    "status",
    "Sprint",
    "resolution",
    "Story Points",
    "Epic Link",
    "Rank",
    "issuetype",
    "labels",
    "priority",
    "Link",
    "summary",
    "assignee",
)

# --- wire schemas ---------------------------------------------------------
# Ids are read as text because they arrive quoted or not. A field whose
# "absent" and "explicit null" mean different things is read as VARIANT, the
# one type that keeps the two apart.

CORRUPT = "_corrupt"

PROJECT_WIRE = (
    "id STRING, key STRING, name STRING, projectTypeKey VARIANT, archived VARIANT, self STRING, "
    "projectCategory STRUCT<id: STRING, name: STRING, description: STRING>"
)
DETAILS_WIRE = (
    "lead STRUCT<displayName: STRING, key: STRING>, "
    "versions ARRAY<STRUCT<id: STRING, name: VARIANT, archived: VARIANT, released: VARIANT, "
    "releaseDate: STRING, userReleaseDate: STRING>>"
)
BOARD_WIRE = "id STRING, name VARIANT, type VARIANT"

_HISTORY = (
    "STRUCT<id: STRING, created: STRING, "
    "author: STRUCT<displayName: STRING, key: STRING, accountId: STRING>, "
    "items: ARRAY<STRUCT<field: STRING, fieldtype: VARIANT, `from`: STRING, fromString: STRING, "
    "`to`: STRING, toString: STRING>>>"
)
_HISTORY_KEYS = "STRUCT<id: STRING, items: ARRAY<STRUCT<field: STRING, fieldtype: VARIANT>>>"


_ISSUE_TIMES = "created STRING, updated STRING"
_ISSUE_DETAILS = (
    "summary STRING, labels ARRAY<STRING>, "
    "status STRUCT<id: STRING, name: STRING, "
    "statusCategory: STRUCT<id: STRING, name: STRING, colorName: STRING>>, "
    "issuetype STRUCT<id: STRING, name: STRING>, "
    "priority STRUCT<id: STRING, name: STRING>, "
    "parent STRUCT<id: STRING, key: STRING>, "
    "epic STRUCT<id: STRING, key: STRING, name: STRING, summary: STRING, done: VARIANT>"
)


def issue_wire(
    custom_field_ids: tuple[str, ...] = (),
    details: bool | Collection[str] = True,
    histories: bool = True,
    history_keys_only: bool = False,
) -> T.StructType:
    """Wire schema of one issue body; configured custom fields arrive as VARIANT.

    Without ``details`` it holds only what decides whether the issue is valid
    in a date range, with names as ``details`` these standard fields besides;
    without ``histories`` no change history, with ``history_keys_only`` their
    ids and their items' fields and types. What the schema leaves out is
    skipped while parsing.
    """
    every = T.StructType.fromDDL(_ISSUE_DETAILS)
    wanted = every.names if details is True else details or ()
    fields = T.StructType.fromDDL(_ISSUE_TIMES)
    for field in every:
        if field.name in wanted:
            fields = fields.add(field)
    if "epic" not in wanted:
        fields = fields.add("epic", T.StructType.fromDDL("done VARIANT"))
    known = set(fields.names)
    for field_id in dict.fromkeys(custom_field_ids if details else ()):
        if field_id not in known:
            fields = fields.add(field_id, T.VariantType())
    wire = T.StructType.fromDDL("id STRING, key STRING").add("fields", fields)
    if histories:
        wire = wire.add("changelog", T.StructType.fromDDL(f"histories ARRAY<{_HISTORY_KEYS if history_keys_only else _HISTORY}>"))
    return wire.add(CORRUPT, T.StringType())


ENVELOPE = (
    "request_id STRING, startAt BIGINT, maxResults BIGINT, total BIGINT, isLast BOOLEAN, "
    f"`values` ARRAY<STRING>, issues ARRAY<STRING>, {CORRUPT} STRING"
)
DETAIL_ENVELOPE = f"request_id STRING, body STRING, {CORRUPT} STRING"
