from __future__ import annotations

from datetime import datetime, timezone

import pytest

from ticketmill import RunParams, params
from ticketmill.schemas import DATA_TYPES


@pytest.mark.parametrize(
    "bad", ["2024-01-01' OR 1=1--", "not-a-date", "2024-1-1", "2024-99-99", "2024-01-01\n", "٢٠٢٤-01-01"]
)
def test_dates_that_are_no_day_are_refused_by_name(bad):
    with pytest.raises(ValueError, match="start_date"):
        params.day("start_date", bad)


def test_good_and_absent_dates():
    assert params.day("end_date", "2024-02-29") == "2024-02-29"
    assert params.day("end_date", None) is None


def test_lists_come_as_text_or_list():
    assert params.name_list(" A , ,B,") == ["A", "B"]
    assert params.name_list(["A"]) == ["A"]
    assert params.name_list(None) == params.name_list("") == []


def test_data_types():
    assert params.data_types(None) == DATA_TYPES
    assert params.data_types("issues, projects") == ("projects", "issues")
    assert params.data_types([]) == ()
    with pytest.raises(ValueError, match="invoices.*boards"):
        params.data_types("projects,invoices")


def test_custom_fields():
    assert params.custom_fields('{"team": "customfield_1"}') == {"team": "customfield_1"}
    assert params.custom_fields({"a": "b"}) == {"a": "b"}
    assert params.custom_fields(None) == {}
    with pytest.raises(ValueError):
        params.custom_fields('["a"]')


def test_run_params_check_everything_up_front():
    made = RunParams("/out//", data_types="boards", project_keys="A,B")
    assert (made.uri, made.data_types, made.project_keys) == ("/out", ("boards",), ["A", "B"])
    assert made.suffix == datetime.now(timezone.utc).strftime("%Y%m%d")
    assert made.max_rows == 10_000
    for wrong in (
        {"fmt": "orc"}, {"mode": "merge"}, {"max_rows": 0}, {"max_rows": -5}, {"max_rows": True},
        {"load_mode": "upsert"}, {"end_date": "tomorrow"}, {"load_mode": "bulk", "fmt": "csv"},
    ):
        with pytest.raises(ValueError):
            RunParams("/out", **wrong)
