"""Options of a whole run, and what it says about dropped rows."""

from __future__ import annotations

import json
import uuid

from conftest import board, details, history, issue, project

from ticketmill import RunParams, run
from ticketmill.sources import runs

SUFFIX = "20240601"


def land(root, indent=None, **folders):
    for kind, lines in folders.items():
        (root / kind).mkdir(parents=True)
        for n, line in enumerate(lines):
            text = line if isinstance(line, str) else json.dumps(line, indent=indent)
            (root / kind / f"{n}.json").write_text(text)
    return str(root)


def pages(*issues):
    return [
        {"request_id": "/rest/agile/1.0/board/1/issue", "startAt": n, "issues": [body]}
        for n, body in enumerate(issues)
    ]


def dimensions():
    return {
        "projects": [{"request_id": "/rest/api/2/project", "values": [project()]}],
        "details": [{"request_id": "/rest/api/2/project/520", "body": details()}],
        "boards": [{"request_id": "/rest/agile/1.0/board?projectKeyOrId=FERRY", "values": [board()]}],
    }


def test_rejects_by_reason_and_torn_lines(spark, tmp_path):
    torn = json.dumps(pages(issue("3"))[0])[:-5]
    bad_item = {"field": "status", "fieldtype": None}
    landed = [*pages(issue("1", histories=[history(items=[bad_item])]), issue("x")), torn]
    uri = land(tmp_path / "landing", issues=landed, **dimensions())
    out = str(tmp_path / "out")
    result = run(spark, uri, RunParams(out, SUFFIX, keep_rejects=True))
    assert [tuple(r) for r in result.rejects.collect()] == [
        ("issues", "id is not an integer", 1),
        ("pages", "line is no readable page", 1),
        ("transitions", "fieldtype is null", 1),
    ]
    kept = spark.read.json(f"{out}/rejects/rejects_{SUFFIX}")
    assert torn in {r.raw for r in kept.collect()}
    assert [tuple(r) for r in result.summary.collect()] == [("boards", 1), ("issues", 1), ("projects", 1)]


def test_pretty_printed_files(spark, tmp_path):
    uri = land(tmp_path / "landing", indent=2, issues=pages(issue("1"), issue("2")), **dimensions())
    params = RunParams(str(tmp_path / "out"), SUFFIX, multi_line=True, swap=True)
    for _ in range(2):
        run(spark, uri, params)
    back = runs.read_run(spark, params.uri, "issues", SUFFIX)
    assert sorted(r["id"] for r in back.collect()) == [1, 2]


def test_table_options_reach_the_tables(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    uri = land(tmp_path / "landing", issues=pages(issue("1", customfield_1="x")), **dimensions())
    params = RunParams(
        str(tmp_path / "out"), SUFFIX, database=database, prefix="own_", custom_as="variant",
        widths=True, buckets=4, custom_fields={"team": "customfield_1"},
    )
    assert run(spark, uri, params).inserted["issues"] == 1
    table = spark.table(f"{database}.own_issues")
    assert dict(table.dtypes)["custom_fields"] == "variant"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_staged_pages_are_read_from_landing_once(spark, tmp_path):
    from ticketmill.plans.relations import landed
    from ticketmill.sources import storage

    uri = land(tmp_path / "landing", issues=pages(issue("1")), **dimensions())
    raw = landed(spark, uri, storage.stage_in(spark, storage.work_folder(spark, "once")))
    plan = raw.issues._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "Exchange hashpartitioning" not in plan
