from __future__ import annotations

import hashlib
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import functions as X


@pytest.fixture
def apply(spark):
    """Evaluate an expression over text values."""

    def run(build, values):
        rows = spark.createDataFrame(list(enumerate(values)), "n INT, v STRING")
        return [r[0] for r in rows.orderBy("n").select(build(F.col("v"))).collect()]

    return run


def _sha(*parts):
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()


def test_hash_joins_parts_by_a_separator_and_counts_null_as_empty(spark):
    df = spark.createDataFrame([("John", "Smith1"), ("JohnSmith", "1"), (None, "é"), (None, None)],
                               "a STRING, b STRING")
    found = [r[0] for r in df.select(X.pii_hash(F.col("a"), F.col("b"))).collect()]
    assert found == [_sha("John", "Smith1"), _sha("JohnSmith", "1"), _sha("", "é"), _sha("", "")]
    assert len(set(found)) == 4


def test_text_or_empty(apply):
    assert apply(X.safe_str, [None, "42", ""]) == ["", "42", ""]


def test_integer_or_null(apply):
    values = ["42", " 7\t", "-3", "+5", None, "", "abc", "None", "3.9", "1e3", "9" * 30,
              "9223372036854775807", "9223372036854775808"]
    assert apply(X.safe_int, values) == [
        42, 7, -3, 5, None, None, None, None, None, None, None, 2**63 - 1, None
    ]


def test_boolean_words(apply):
    values = ["true", "TRUE", "1", "yes", "false", "False", "0", "No", "maybe", "t", "on", "", None]
    assert apply(X.safe_bool, values) == [True] * 4 + [False] * 4 + [None] * 5
    assert apply(X.lax_bool, values) == [True] * 4 + [False] * 4 + [None, True, True, None, None]


def test_strip_takes_every_white_space(apply):
    assert apply(X.strip_text, ["\t\n a b\x1f\x85 ", "　x", "", None, " \n "]) == [
        "a b", "x", "", None, ""
    ]


def test_strip_matches_python_on_all_white_space(apply):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    assert apply(X.strip_text, [f"{s}x{s}" for s in spaces]) == ["x"] * len(spaces)
    kept = [chr(0x200B), chr(0xFEFF), chr(0x180E)]
    assert apply(X.strip_text, kept) == kept


def test_clean_reaches_nested_leaves_and_leaves_the_rest(spark):
    kind = T.StructType.fromDDL("a STRING, n INT, l ARRAY<STRING>, s STRUCT<b: STRING>, "
                                "m MAP<STRING,STRING>")
    rows = [(((" x ", 1, [" y", None], (" z ",), {" k ": " v "})),), (None,)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("d", kind)]))
    found = [r[0] for r in df.select(X.clean_ws(F.col("d"), kind)).collect()]
    assert found[0].asDict(True) == {
        "a": "x", "n": 1, "l": ["y", None], "s": {"b": "z"}, "m": {" k ": "v"}
    }
    assert found[1] is None


def _utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def _instants(values):
    return [None if v is None else v.astimezone(timezone.utc) for v in values]


def test_release_dates(apply):
    values = ["2024-03-01", "15/Mar/24", "15/mar/24 08:05", "1/Jan/69", "31/Dec/68", "29/Feb/96",
              "not-a-date", "", None, "2024/03/01", "15/Mar/2024"]
    assert apply(lambda v: F.unix_seconds(X.release_date(v)), values) == [
        None if v is None else int(v.timestamp())
        for v in [
            _utc(2024, 3, 1), _utc(2024, 3, 15), _utc(2024, 3, 15, 8, 5), _utc(1969, 1, 1),
            _utc(2068, 12, 31), _utc(1996, 2, 29), None, None, None, None, None,
        ]
    ]


def test_two_digit_years_over_the_whole_range(spark):
    days = spark.range(0, 36500, 29).select(
        F.date_add(F.lit("1969-01-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    read = X.release_date(F.date_format("d", "dd/MMM/yy")).cast("date")
    assert days.where(~read.eqNullSafe(F.col("d"))).count() == 0


def test_iso_times_need_an_offset(apply):
    values = ["2024-01-15T09:00:00.000+0000", "2024-01-15T09:00:00+05:30", "2024-01-15T09:00:00Z",
              "2024-01-15T09:00:00.123456-0330", "2024-01-15T09:00:00", "2024-01-15", "yesterday",
              "2024-13-15T09:00:00.000+0000", "", None]
    micros = apply(lambda v: F.unix_micros(X.iso_ts(v)), values)
    nine = int(_utc(2024, 1, 15, 9).timestamp()) * 10**6
    assert micros == [nine, nine - 19800 * 10**6, nine, nine + 12600 * 10**6 + 123456] + [None] * 6


def test_first_truthy_and_labels(spark):
    df = spark.createDataFrame(
        [("", "b", ["x", "", None, "y"]), ("a", "b", []), (None, "", None), ("", None, [""])],
        "a STRING, b STRING, l ARRAY<STRING>",
    )
    found = df.select(X.first_truthy(F.col("a"), F.col("b")), X.labels_text(F.col("l"))).collect()
    assert [tuple(r) for r in found] == [("b", "x, y"), ("a", None), (None, None), (None, None)]


@pytest.mark.parametrize(
    ("json_value", "wanted"),
    [
        ('{"value":"feature","name":"n"}', "feature"),
        ('{"value":"","name":"n"}', "n"),
        ('{"value":0,"name":"n"}', "n"),
        ('{"value":0.0,"name":"n"}', "n"),
        ('{"value":"0","name":"n"}', "0"),
        ('{"value":false,"name":"n"}', "n"),
        ('{"value":[],"name":"n"}', "n"),
        ('{"value":{},"name":"n"}', "n"),
        ('{"value":null,"name":"n"}', "n"),
        ('{"value":{"a":1}}', '{"a":1}'),
        ('{"value":7}', "7"),
        ('{"id":5}', '{"id":5}'),
        ('"Platform"', "Platform"),
        ('"{\\"value\\":\\"x\\"}"', '{"value":"x"}'),
        ('""', ""),
        ("8", "8"),
        ("2.5", "2.5"),
        ("0", "0"),
        ("true", "true"),
        ('["a",1]', '["a",1]'),
        ("null", None),
    ],
)
def test_custom_values(spark, json_value, wanted):
    df = spark.createDataFrame([(json_value,)], "j STRING")
    assert df.select(X.custom_value(F.parse_json("j"))).first()[0] == wanted


def test_custom_map_without_names_is_null(spark):
    assert spark.range(1).select(X.custom_map({})).first()[0] is None


def test_json_text_keeps_nulls_and_passes_null(spark):
    df = spark.createDataFrame([({"a": "1", "b": None},), (None,)], "m MAP<STRING,STRING>")
    assert [r[0] for r in df.select(X.json_text(F.col("m"))).collect()] == [
        '{"a":"1","b":null}', None
    ]


def test_json_text_as_variant(spark):
    df = spark.createDataFrame([('{"a":5}',), ("{",), (None,)], "j STRING")
    found = df.select(F.try_variant_get(X.semi_structured(F.col("j")), "$.a", "int")).collect()
    assert [r[0] for r in found] == [5, None, None]
