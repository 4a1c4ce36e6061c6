"""Run parameters, checked on the driver before any plan is built."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from ticketmill.schemas import DATA_TYPES

FORMATS = ("parquet", "csv", "jsonl")
MODES = ("replace", "append")
LOAD_MODES = ("keyed", "plain", "bulk")
CUSTOM_FORMS = ("map", "variant", "json")
DEFAULT_MAX_ROWS = 10_000


def day(label: str, value: str | None) -> str | None:
    """A calendar day written YYYY-MM-DD, or None."""
    if value is None or value == "":
        return None
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        raise ValueError(f"{label} must look like YYYY-MM-DD, got {value!r}")
    try:
        date.fromisoformat(value)
    except ValueError:
        raise ValueError(f"{label} is not a calendar day: {value!r}") from None
    return value


def name_list(value: str | Iterable[str] | None) -> list[str]:
    """A list, or comma-separated text with blanks and empty entries dropped."""
    if not value:
        return []
    if isinstance(value, str):
        return [part.strip() for part in value.split(",") if part.strip()]
    return list(value)


def data_types(value: str | Iterable[str] | None) -> tuple[str, ...]:
    """The selected relations; None means all, an empty list means none."""
    if value is None:
        return DATA_TYPES
    chosen = name_list(value)
    unknown = sorted(set(chosen) - set(DATA_TYPES))
    if unknown:
        raise ValueError(f"unknown data types {unknown}; valid ones are {sorted(DATA_TYPES)}")
    return tuple(name for name in DATA_TYPES if name in chosen)


def one_data_type(name: str) -> str:
    if name not in DATA_TYPES:
        raise ValueError(f"unknown data type {name!r}; valid ones are {sorted(DATA_TYPES)}")
    return name


def custom_fields(value: str | Mapping[str, str] | None) -> dict[str, str]:
    """Logical name -> field id, given as a mapping or as JSON text."""
    if not value:
        return {}
    parsed = json.loads(value) if isinstance(value, str) else dict(value)
    if not isinstance(parsed, dict) or not all(isinstance(v, str) for v in parsed.values()):
        raise ValueError("custom_fields must map logical names to field ids")
    return parsed


def choice(label: str, value: str, allowed: tuple[str, ...]) -> str:
    if value not in allowed:
        raise ValueError(f"unsupported {label} {value!r}; choose one of {list(allowed)}")
    return value


def max_rows(value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"max_rows must be a positive integer, got {value!r}")
    return value


def suffix(value: str | None = None) -> str:
    """The run's date suffix; today in UTC as YYYYMMDD by default."""
    return value or datetime.now(timezone.utc).strftime("%Y%m%d")


def root(uri: str) -> str:
    return uri.rstrip("/")


@dataclass(frozen=True)
class RunParams:
    """Everything one run needs besides the raw input. Checked when created."""

    uri: str
    suffix: str | None = None
    fmt: str = "parquet"
    mode: str = "replace"
    max_rows: int = DEFAULT_MAX_ROWS
    data_types: str | Iterable[str] | None = None
    project_keys: str | Iterable[str] | None = None
    start_date: str | None = None
    end_date: str | None = None
    custom_fields: str | Mapping[str, str] | None = field(default=None)
    database: str | None = None
    load_mode: str = "keyed"
    swap: bool = False
    """Replace a run by writing aside and moving in place."""
    multi_line: bool = False
    """Landed files hold one pretty-printed response each."""
    keep_rejects: bool = False
    """Write rejected rows to ``{uri}/rejects/rejects_{suffix}`` as JSON Lines."""
    prefix: str | None = None
    custom_as: str = "map"
    widths: bool = False
    buckets: int | None = None

    def __post_init__(self) -> None:
        put = object.__setattr__
        put(self, "uri", root(self.uri))
        put(self, "suffix", suffix(self.suffix))
        choice("format", self.fmt, FORMATS)
        choice("mode", self.mode, MODES)
        choice("load mode", self.load_mode, LOAD_MODES)
        max_rows(self.max_rows)
        put(self, "data_types", data_types(self.data_types))
        put(self, "project_keys", name_list(self.project_keys))
        put(self, "start_date", day("start_date", self.start_date))
        put(self, "end_date", day("end_date", self.end_date))
        put(self, "custom_fields", custom_fields(self.custom_fields))
        choice("custom_as", self.custom_as, CUSTOM_FORMS)
        if self.buckets is not None:
            max_rows(self.buckets)
        if self.load_mode == "bulk" and self.fmt != "parquet":
            raise ValueError("bulk load reads the written run back, so it needs fmt='parquet'")
