from __future__ import annotations

import hashlib

import pytest
from conftest import HOST, board, change, details, history, issue, project

from ticketmill import build
from ticketmill.plans.relations import summary
from ticketmill.schemas import DATA_TYPES, RECORDS


def _sha(*parts):
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()


def rows(df):
    return [r.asDict() for r in df.collect()]


def one(df):
    found = rows(df)
    assert len(found) == 1
    return found[0]


def issues_of(make_raw, *bodies, **options):
    raw = make_raw(issues=[(1, b) for b in bodies])
    return build(raw, data_types=["issues"], **options)["issues"]


def transitions_of(make_raw, *histories):
    raw = make_raw(issues=[(1, issue(histories=histories))])
    return build(raw, data_types=["transitions"])["transitions"]


def rejected(relations):
    return {(r.relation, r.entity_id, r.reason) for r in relations.rejects().collect()}


# --- projects -----------------------------------------------------------------


def test_project_is_stripped_but_details_are_not(make_raw):
    raw = make_raw(
        [project(key=" FERRY\t", name="\n Name ", projectTypeKey=" software ",
                 projectCategory={"id": 7, "name": " Cat ", "description": None})],
        {"/rest/api/2/project/520": details(lead={"displayName": " Mara ", "key": None})},
    )
    assert one(build(raw, data_types=["projects"])["projects"]) == {
        "id": 520, "key": "FERRY", "name": "Name", "project_type_key": "software",
        "archived": False, "project_category_id": "7", "project_category_name": "Cat",
        "project_category_description": None, "lead_hash": _sha(" Mara ", ""),
    }


def test_lead_without_key_ignores_the_account_id_and_nobody_has_a_hash(make_raw):
    lead = {"displayName": "Mara", "accountId": "a1"}
    raw = make_raw(
        [project(), project(id="2", key="B")],
        {"/rest/api/2/project/520": details(lead=lead), "/rest/api/2/project/2": details(lead=None)},
    )
    found = {r["key"]: r["lead_hash"] for r in rows(build(raw)["projects"])}
    assert found == {"FERRY": _sha("Mara", ""), "B": _sha("", "")}


def test_absent_fields_have_defaults_but_explicit_nulls_reject(make_raw):
    bare = {"id": "1", "key": "A", "name": "N", "self": f"{HOST}/1"}
    wrong = [
        {**bare, "projectTypeKey": None},
        {**bare, "archived": None},
        {**bare, "archived": "maybe"},
        {**bare, "name": None},
        {"id": "1", "name": "N", "self": f"{HOST}/1"},
        {**bare, "id": "not-an-int"},
        {**bare, "id": None},
    ]
    raw = make_raw([bare, *wrong], {"/rest/api/2/project/1": details()}, [])
    found = build(raw, data_types=["projects"])
    good = one(found["projects"])
    assert (good["project_type_key"], good["archived"]) == ("", False)
    assert found.rejects().count() == len(wrong)


@pytest.mark.parametrize(("given", "wanted"), [("yes", True), (" Off ", False), (1, True), (0, False)])
def test_archived_takes_the_usual_spellings(make_raw, given, wanted):
    raw = make_raw([project(archived=given)], {"/rest/api/2/project/520": details()})
    assert one(build(raw, data_types=["projects"])["projects"])["archived"] is wanted


@pytest.mark.parametrize("body", [None, "{}", "null", "[]", "{broken"])
def test_project_without_details_vanishes_with_its_children(make_raw, body):
    found = build(make_raw(detail_map={} if body is None else {"/rest/api/2/project/520": body}))
    assert summary(found).count() == 0
    assert found.rejects().count() == 0


def test_invalid_project_takes_its_children_along(make_raw):
    versions = [{"id": "1", "name": "v1"}]
    raw = make_raw(
        [project(id="not-an-int")], {"/rest/api/2/project/not-an-int": details(versions=versions)}
    )
    found = build(raw)
    assert summary(found).count() == 0
    assert rejected(found) == {("projects", "not-an-int", "id is not an integer")}


def test_project_keys_match_the_raw_key(make_raw):
    raw = make_raw([project(), project(id="2", key="DOCK"), project(id="3", key=" FERRY")])
    found = build(raw, data_types="projects", project_keys="FERRY, NONE")
    assert [r["id"] for r in rows(found["projects"])] == [520]


# --- releases and boards --------------------------------------------------------


def test_releases(make_raw):
    versions = [
        {"id": "1", "name": "v1", "releaseDate": "2024-03-01", "released": True},
        {"id": 2, "releaseDate": "15/Mar/24", "userReleaseDate": ""},
        {"id": "3", "name": "v3", "releaseDate": "not-a-date"},
        {"id": "x", "name": "v4"},
        {"id": None, "name": "v5"},
        {"id": "6", "name": None},
        {"id": "7", "name": "v7", "archived": "perhaps"},
    ]
    raw = make_raw(detail_map={"/rest/api/2/project/520": details(versions=versions)})
    found = build(raw, data_types=["releases"])
    got = {r["release_id"]: r for r in rows(found["releases"])}
    assert set(got) == {1, 2}
    assert (got[1]["release_name"], got[1]["released"], got[1]["archived"]) == ("v1", True, False)
    assert got[2]["release_name"] == "" and got[2]["user_release_date"] is None
    assert (got[2]["project_id"], got[2]["project_key"]) == (520, "FERRY")
    assert [str(got[i]["release_date"])[:10] for i in (1, 2)] == ["2024-03-01", "2024-03-15"]
    assert {(e, r) for _, e, r in rejected(found)} == {
        ("3", "unknown date form"), ("x", "id is not an integer"), (None, "id is not an integer"),
        ("6", "name is null"), ("7", "archived is not a boolean"),
    }


@pytest.mark.parametrize("versions", [None, []])
def test_no_versions_no_releases(make_raw, versions):
    raw = make_raw(detail_map={"/rest/api/2/project/520": details(versions=versions)})
    assert build(raw, data_types=["releases"])["releases"].count() == 0


def test_invalid_board_is_dropped_and_its_listing_not_read(make_raw):
    raw = make_raw(
        boards=[("FERRY", board("not-an-int")), ("FERRY", {"id": 2}), ("FERRY", board(3, name=None))],
        issues=[(1, issue("1")), (2, issue("2")), (3, issue("3"))],
    )
    found = build(raw)
    got = one(found["boards"])
    assert (got["board_id"], got["name"], got["board_type"]) == (2, "", "")
    assert [r["id"] for r in rows(found["issues"])] == [2]
    assert {(e, r) for _, e, r in rejected(found)} == {
        ("not-an-int", "id is not an integer"), ("3", "name is null")
    }


# --- issues ---------------------------------------------------------------------


def test_issue_columns(make_raw):
    body = issue(
        labels=["backend", "", None, "urgent"],
        parent={"id": "7", "key": "FERRY-7"},
        epic={"id": "None", "key": "E-1", "name": "Epic", "summary": "", "done": True},
        issuetype={"id": "abc", "name": "Crossing"},
        updated="2024-03-01",
    )
    got = one(issues_of(make_raw, body))
    assert list(got) == RECORDS["issues"].names
    assert (got["id"], got["key"], got["labels"]) == (7001, "FERRY-8", "backend, urgent")
    assert (got["project_id"], got["project_key"], got["project_name"]) == (
        520, "FERRY", "Ferry timetable"
    )
    assert (got["parent_task_id"], got["epic_id"], got["issuetype_id"]) == (7, None, None)
    assert (got["epic_summary"], got["epic_done"]) == (None, True)
    assert (got["status_category_id"], got["status_category_colour"]) == (6, "teal")
    assert str(got["created"]) == "2023-05-04 10:20:30" and got["updated"] is None
    assert got["custom_fields"] is None


def test_empty_issue_has_nulls_only(make_raw):
    for fields in ({}, None):
        got = one(issues_of(make_raw, {"id": 5, "key": "K", "fields": fields}))
        given = {"id", "key", "project_id", "project_key", "project_name"}
        assert {name for name, value in got.items() if value is not None} == given


def test_a_scalar_in_place_of_an_object_nulls_that_field_only(make_raw):
    got = one(issues_of(make_raw, issue(status="x")))
    assert (got["status_id"], got["status_name"], got["summary"]) == (None, None, "Moor at berth two")


def test_custom_fields(make_raw):
    body = issue(
        customfield_1={"value": "feature"}, customfield_2="Platform", customfield_3=5,
        customfield_4=None, customfield_9="unmapped", **{"weird.id x": ["a"]},
    )
    names = {"type": "customfield_1", "team": "customfield_2", "points": "customfield_3",
             "nil": "customfield_4", "gone": "customfield_5", "odd": "weird.id x",
             "again": "customfield_2", "title": "summary", "state": "status"}
    got = one(issues_of(make_raw, body, custom_fields=names))["custom_fields"]
    assert got.pop("state") == "Boarding"
    assert got == {"type": "feature", "team": "Platform", "points": "5", "nil": None,
                   "gone": None, "odd": '["a"]', "again": "Platform", "title": "Moor at berth two"}


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        (issue("not-an-int"), "id is not an integer"),
        ({**issue(), "key": None}, "key is missing"),
        ({**issue(), "id": ""}, "id is blank"),
        ({**issue(), "id": None}, "id is blank"),
        ('{"id": "1", "key"', "body is no readable object"),
        (issue(epic={"done": "maybe"}), "epic_done is not a boolean"),
    ],
)
def test_rejected_issue_takes_its_transitions(make_raw, body, reason):
    if isinstance(body, dict):
        body = {**body, "changelog": {"histories": [history(items=[change()])]}}
    found = build(make_raw(issues=[(1, body), (1, issue("77"))]))
    assert [r["id"] for r in rows(found["issues"])] == [77]
    assert found["transitions"].count() == 0
    assert [r.reason for r in found.rejects().collect()] == [reason]
    assert found.rejects().first().raw is not None


def test_blank_ids_are_not_copies_of_one_another(make_raw):
    raw = make_raw(issues=[(1, {**issue(), "id": ""}), (1, {**issue(), "id": None})])
    assert build(raw).rejects().count() == 2


# --- first board wins -------------------------------------------------------------


def test_first_board_then_first_place_wins(make_raw):
    raw = make_raw(
        boards=[("FERRY", board(20)), ("FERRY", board(10))],
        issues=[(10, issue(summary="board 10")), (20, issue(summary="second")),
                (20, issue(summary="third")), (10, issue("8", summary="only here"))],
    )
    found = rows(build(raw, data_types=["issues"])["issues"])
    assert {(r["id"], r["summary"]) for r in found} == {(7001, "second"), (8, "only here")}


def test_an_invalid_first_copy_hides_a_later_valid_one(make_raw):
    raw = make_raw(issues=[(1, {**issue(), "key": None}), (1, issue())])
    found = build(raw, data_types=["issues"])
    assert found["issues"].count() == 0
    assert rejected(found) == {("issues", "7001", "key is missing")}


def test_copies_on_an_invalid_board_do_not_count(make_raw):
    raw = make_raw(
        boards=[("FERRY", board("bad")), ("FERRY", board(2))],
        issues=[(1, issue(summary="on the bad one")), (2, issue(summary="kept"))],
    )
    assert one(build(raw, data_types=["issues"])["issues"])["summary"] == "kept"


def test_scope_is_the_project(make_raw):
    raw = make_raw(
        [project(), project(id="2", key="DOCK", name="Dock")],
        boards=[("FERRY", board(1)), ("DOCK", board(2))],
        issues=[(1, issue()), (2, issue())],
    )
    found = rows(build(raw, data_types=["issues"])["issues"])
    assert sorted((r["id"], r["project_id"], r["project_name"]) for r in found) == [
        (7001, 2, "Dock"), (7001, 520, "Ferry timetable")
    ]


def test_one_board_of_two_projects(make_raw):
    raw = make_raw(
        [project(), project(id="2", key="DOCK")],
        boards=[("FERRY", board(1)), ("DOCK", board(1))],
        issues=[(1, issue())],
    )
    assert sorted(r["project_id"] for r in rows(build(raw)["issues"])) == [2, 520]


def test_seen_issues_do_not_come_again(make_raw, spark):
    seen = spark.createDataFrame([(520, "7001")], "project_id BIGINT, entity_id STRING")
    raw = make_raw(issues=[(1, issue()), (1, issue("2"))])
    assert [r["id"] for r in rows(build(raw, seen=seen)["issues"])] == [2]


# --- transitions ------------------------------------------------------------------


def test_status_change(make_raw):
    got = one(transitions_of(make_raw, history(items=[change()])))
    assert str(got.pop("created")) == "2023-05-09 07:40:05"
    assert got == {
        "transition_id": 81, "transition_field": "status", "transition_field_type": "core",
        "issue_id": 7001, "issue_key": "FERRY-8", "hashed_author": _sha("Oskar", "oskar"),
        "from_id": "11", "from_string": "Queued", "to_id": "12", "to_string": "Boarding",
    }


def test_assignee_is_masked(make_raw):
    item = change("assignee", **{"from": "ib-key", "fromString": "Ilse Brandt", "to": None,
                                 "toString": None})
    got = one(transitions_of(make_raw, history(items=[item])))
    assert (got["from_id"], got["to_id"]) == (None, None)
    assert (got["from_string"], got["to_string"]) == (_sha("Ilse Brandt", "ib-key"), _sha("", ""))


def test_author_falls_back_to_the_account_id(make_raw):
    authors = [{"displayName": "A", "key": "", "accountId": "x"}, {}, None]
    found = rows(transitions_of(
        make_raw, *[history(str(n), [change()], author=a) for n, a in enumerate(authors)]
    ))
    assert [r["hashed_author"] for r in sorted(found, key=lambda r: r["transition_id"])] == [
        _sha("A", "x"), _sha("", ""), _sha("", "")
    ]


def test_untracked_fields_and_wrong_case_are_left_out(make_raw):
    items = [change("Attachment"), change("Status"), change("sprint"), change(None)]
    assert transitions_of(make_raw, history(items=items)).count() == 0


def test_every_tracked_field_is_kept(make_raw):
    names = ["status", "Sprint", "resolution", "Story Points", "Epic Link", "Rank", "issuetype",
             "labels", "priority", "Link", "summary", "assignee"]
    found = transitions_of(make_raw, history(items=[change(n) for n in names]))
    assert sorted(r["transition_field"] for r in rows(found)) == sorted(names)


@pytest.mark.parametrize("bad", [None, "", "abc", "1.5"])
def test_history_without_numeric_id_is_dropped_whole(make_raw, bad):
    found = rows(transitions_of(make_raw, history(bad, [change()]), history("5", [change()])))
    assert [r["transition_id"] for r in found] == [5]


def test_sparse_item_is_kept_and_null_lists_are_empty(make_raw):
    sparse = history("1", [{"field": "status"}], created="2024-01-01", author={})
    got = one(transitions_of(make_raw, sparse, {"id": "2"}, {"id": "3", "items": None}))
    assert (got["created"], got["transition_field_type"]) == (None, "")
    assert all(got[n] is None for n in ("from_id", "from_string", "to_id", "to_string"))
    for changelog in (None, {}, {"histories": None}):
        raw = make_raw(issues=[(1, {**issue(), "changelog": changelog})])
        assert build(raw, data_types=["transitions"])["transitions"].count() == 0


def test_explicit_null_type_rejects_that_item_only(make_raw):
    raw = make_raw(issues=[(1, issue(histories=[history(items=[change(fieldtype=None), change()])]))])
    found = build(raw, data_types=["transitions"])
    assert found["transitions"].count() == 1
    assert rejected(found) == {("transitions", "81", "fieldtype is null")}


def test_two_items_of_one_field_both_stay(make_raw):
    assert transitions_of(make_raw, history(items=[change("Link"), change("Link")])).count() == 2


# --- selection, dates, summary ------------------------------------------------------


def test_default_gives_every_relation(make_raw):
    raw = make_raw(
        detail_map={"/rest/api/2/project/520": details(versions=[{"id": "1", "name": "v1"}])},
        issues=[(1, issue(histories=[history(items=[change()])]))],
    )
    found = build(raw)
    assert [tuple(r) for r in summary(found).collect()] == [
        (name, 1) for name in sorted(DATA_TYPES)
    ]
    for name, df in found.items():
        assert df.schema == RECORDS[name]


def test_unselected_relations_are_not_planned(make_raw):
    raw = make_raw()
    assert set(build(raw, data_types=["projects"]).checked) == {"projects"}
    assert set(build(raw, data_types=["boards"]).checked) == {"projects", "boards"}
    assert set(build(raw, data_types=["releases"]).checked) == {"projects", "releases"}
    assert set(build(raw, data_types=["issues"]).checked) == {"projects", "boards", "issues"}
    only = build(raw, data_types=["projects", "issues"])
    assert list(only.as_dict()) == ["projects", "issues"]
    with pytest.raises(KeyError):
        only["boards"]
    assert build(raw, data_types=[]).as_dict() == {}


@pytest.mark.parametrize(
    ("start", "end", "kept"),
    [
        ("2023-06-11", None, {1, 2}),
        (None, "2023-05-04", {3}),
        ("2023-06-01", "2023-06-01", {1, 2}),
        ("2023-06-12", None, {2}),
        (None, "2023-05-05", {1, 2, 3}),
        (None, None, {1, 2, 3, 4}),
    ],
)
def test_date_range(make_raw, start, end, kept):
    bodies = [
        issue("1"),
        issue("2", created="2023-05-04T23:00:00.000+0000", updated="2023-09-01T00:00:00.000+0000"),
        issue("3", created="2022-01-01T00:00:00.000+0000", updated=None),
        issue("4", created=None, updated="garbage"),
    ]
    found = issues_of(make_raw, *bodies, start_date=start, end_date=end)
    assert {r["id"] for r in rows(found)} == kept


def test_a_copy_outside_the_range_does_not_count_as_seen(make_raw):
    raw = make_raw(
        boards=[("FERRY", board(1)), ("FERRY", board(2))],
        issues=[(1, issue(created=None, updated=None)), (2, issue(summary="inside"))],
    )
    found = build(raw, data_types=["issues"], start_date="2023-01-01")
    assert one(found["issues"])["summary"] == "inside"


def test_a_session_outside_utc_is_refused(make_raw, spark):
    raw = make_raw()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            build(raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_transitions_of_some_fields_or_their_keys_alone_are_the_same_rows(make_raw):
    changes = [
        history("81", [change(), change("assignee")]),
        history("82", [change("Attachment")]),
        history("83", [change("assignee", fieldtype=None), change("Link")]),
    ]
    raw = make_raw(issues=[(1, issue(histories=changes))])

    def planned(**options):
        return build(raw, data_types="transitions", **options)

    def rows(df):
        return sorted(map(str, df.collect()))

    whole = planned()
    assert whole["transitions"].count() == 3
    people = planned(transition_fields=["assignee"])["transitions"]
    assert rows(people) == rows(whole["transitions"].where("transition_field = 'assignee'"))
    keys, names = planned(transition_keys_only=True), ["transition_id", "issue_id", "transition_field"]
    assert rows(keys["transitions"].select(*names)) == rows(whole["transitions"].select(*names))
    assert rows(keys.rejects().drop("raw")) == rows(whole.rejects().drop("raw"))
    assert "displayName" not in str(keys.checked["issues"].schema)


def test_issue_keys_alone_are_those_of_whole_issues(make_raw):
    raw = make_raw(issues=[(1, issue()), (1, issue(id="")), (1, issue(id="x9"))])
    whole, keys = (build(raw, data_types="issues", issue_keys_only=only) for only in (False, True))
    names = ["id", "key", "project_id", "project_key", "project_name", "created", "updated"]
    assert sorted(map(str, keys["issues"].select(*names).collect())) == sorted(map(str, whole["issues"].select(*names).collect()))
    assert sorted(map(str, keys.rejects().collect())) == sorted(map(str, whole.rejects().collect()))
    assert keys["issues"].schema == whole["issues"].schema
    assert keys["issues"].where("status_name IS NOT NULL OR summary IS NOT NULL").isEmpty()
