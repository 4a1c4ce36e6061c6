"""Custom fields: dynamic JSON values resolved to one text per logical name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts that count as "nothing there".
_FALSY_JSON = ('""', "false", "[]", "{}", "null")


def _resolved(value: Column, path: str, as_json: Column) -> Column:
    """A string as it is, any other JSON value as its JSON text."""
    is_text = as_json.startswith('"')
    return F.when(is_text, F.try_variant_get(value, path, "string")).otherwise(as_json)


def _truthy_member(value: Column, path: str) -> Column:
    as_json = F.to_json(F.try_variant_get(value, path, "variant"))
    is_zero = ~as_json.startswith('"') & (as_json.try_cast("double") == 0)
    return F.when(
        ~as_json.isin(*_FALSY_JSON) & ~F.coalesce(is_zero, F.lit(False)),
        _resolved(value, path, as_json),
    )


def custom_value(value: Column) -> Column:
    """One custom field: an object gives its ``value``, else its ``name``, else its
    JSON text (the first truthy one); anything else is kept as text, JSON null as null."""
    as_json = F.to_json(value)
    member = F.coalesce(_truthy_member(value, "$.value"), _truthy_member(value, "$.name"), as_json)
    return F.when(as_json.startswith("{"), member).when(
        as_json != "null", _resolved(value, "$", as_json)
    )


def custom_map(values: Mapping[str, Column]) -> Column:
    """logical name -> text for every configured name; null when none is configured.

    A configured field that an issue lacks gets a null entry, not a missing one.
    """
    if not values:
        return F.lit(None).cast("map<string,string>")
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name in values]),
        F.array(*[custom_value(value) for value in values.values()]),
    )


def json_text(value: Column) -> Column:
    """Map, array or struct as JSON text, null entries included; null stays null."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def semi_structured(text: Column) -> Column:
    """JSON text as VARIANT; null when it is no JSON."""
    return F.try_parse_json(text)
