from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .config("spark.executorEnv.PYTHONPATH", str(ROOT))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# One body of each kind, as a ferry company's tracker would send it.
HOST = "https://desk.invalid/rest/api/2/project"
SAMPLE = json.loads("""
{
  "project": {"id": "520", "key": "FERRY", "name": "Ferry timetable", "archived": false,
              "projectTypeKey": "software", "self": "https://desk.invalid/rest/api/2/project/520"},
  "details": {"id": "520", "lead": {"displayName": "Mara Quill", "key": "mquill"}, "versions": []},
  "board":   {"id": 1, "name": "Night sailings", "type": "scrum"},
  "change":  {"field": "status", "fieldtype": "core", "from": "11", "fromString": "Queued",
              "to": "12", "toString": "Boarding"},
  "history": {"id": "81", "created": "2023-05-09T07:40:05.000+0000",
              "author": {"displayName": "Oskar", "key": "oskar"}, "items": []},
  "issue":   {"id": "7001", "key": "FERRY-8", "changelog": {"histories": []}},
  "fields":  {"summary": "Moor at berth two", "labels": [], "parent": {}, "epic": {},
              "created": "2023-05-04T10:20:30.000+0000", "updated": "2023-06-11T18:02:00.000+0000",
              "issuetype": {"id": "31", "name": "Crossing"}, "priority": {"id": "5", "name": "Urgent"},
              "status": {"id": "12", "name": "Boarding",
                         "statusCategory": {"id": "6", "name": "Afloat", "colorName": "teal"}}}
}
""")


def _body(kind, **other):
    """A copy of the sample of this kind with some of its entries replaced."""
    return {**json.loads(json.dumps(SAMPLE[kind])), **other}


def project(id="520", **other):
    return _body("project", **{"id": id, "self": f"{HOST}/{id}", **other})


def details(**other):
    return _body("details", **other)


def board(id=1, **other):
    return _body("board", id=id, **other)


def change(field="status", **other):
    return _body("change", field=field, **other)


def history(id="81", items=(), **other):
    return _body("history", id=id, items=list(items), **other)


def issue(id="7001", key="FERRY-8", histories=(), **fields):
    whole = _body("issue", id=id, key=key, fields=_body("fields", **fields))
    whole["changelog"]["histories"] = list(histories)
    return whole


@pytest.fixture(scope="session")
def make_raw(spark):
    """Raw frames of literals: projects, {path: details}, (project key, board)
    and (board id, issue) lists; their order is the listing order."""
    from ticketmill import Raw

    def text(body):
        return body if isinstance(body, str) else json.dumps(body)

    def make(projects=None, detail_map=None, boards=None, issues=None):
        projects = [project()] if projects is None else projects
        if detail_map is None:
            detail_map = {"/rest" + p["self"].partition("/rest")[2]: details() for p in projects}
        boards = [("FERRY", board())] if boards is None else boards
        issues = [(1, issue())] if issues is None else issues
        return Raw(
            projects=spark.createDataFrame([(text(p),) for p in projects], "body STRING"),
            details=spark.createDataFrame(
                [(path, text(body)) for path, body in detail_map.items()],
                "path STRING, body STRING",
            ),
            boards=spark.createDataFrame(
                [(key, n, text(body)) for n, (key, body) in enumerate(boards)],
                "project_key STRING, ord BIGINT, body STRING",
            ),
            issues=spark.createDataFrame(
                [(b, n, text(body)) for n, (b, body) in enumerate(issues)],
                "board_id BIGINT, ord BIGINT, body STRING",
            ),
        )

    return make
