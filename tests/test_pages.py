from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ticketmill.sources import pages


@pytest.fixture
def landed(spark):
    def make(*envelopes):
        rows = [(json.dumps(e),) for e in envelopes]
        return pages.parse_pages(spark.createDataFrame(rows, "page STRING"))

    return make


def page(start, items, request="r", key="issues", **other):
    return {"request_id": request, "startAt": start, key: items, **other}


def read(df):
    found = pages.paged_items(df).orderBy("request_id", "ord").collect()
    return [(r.request_id, r.body) for r in found]


def bodies(*ids):
    return [{"id": i} for i in ids]


def test_single_page(landed):
    assert read(landed(page(0, bodies(1, 2), total=2))) == [("r", '{"id":1}'), ("r", '{"id":2}')]


def test_two_pages_in_start_order(landed):
    found = read(landed(page(2, bodies(3), total=3), page(0, bodies(1, 2), total=3)))
    assert [b for _, b in found] == ['{"id":1}', '{"id":2}', '{"id":3}']


def test_last_flag_without_total(landed):
    assert len(read(landed(page(0, bodies(1), isLast=True, key="values")))) == 1


def test_empty_response(landed):
    assert read(landed({})) == []
    assert read(landed({"request_id": "r"})) == []


@pytest.mark.parametrize(
    "stopping",
    [
        page(0, bodies(1, 2), total=2),
        page(0, bodies(1, 2), isLast=True),
        page(0, bodies(1, 2), total=1),
    ],
)
def test_pages_behind_the_stop_are_not_read(landed, stopping):
    found = read(landed(stopping, page(2, bodies(3)), page(3, bodies(4))))
    assert len(found) == 2


def test_an_empty_page_stops(landed):
    assert len(read(landed(page(0, bodies(1)), page(1, []), page(2, bodies(9))))) == 1


def test_without_any_stop_every_page_counts_and_requests_are_apart(landed):
    found = read(
        landed(
            page(0, bodies(1)), page(1, bodies(2)),
            page(0, bodies(3), request="q", total=1), page(1, bodies(4), request="q"),
        )
    )
    assert found == [("q", '{"id":3}'), ("r", '{"id":1}'), ("r", '{"id":2}')]


def test_audit(landed):
    found = pages.audit_pages(
        landed(
            page(0, bodies(1, 2), total=5), page(4, bodies(5), total=5),
            page(0, bodies(1), request="q", total=2), page(1, bodies(2), request="q", total=2),
            page(0, bodies(1), request="s"), page(1, [], request="s"),
            page(3, bodies(1), request="u"),
        )
    )
    rows = {r.request_id: tuple(r)[1:] for r in found.collect()}
    assert rows == {
        "r": (2, 3, 5, 1, False),
        "q": (2, 2, 2, 0, True),
        "s": (2, 1, None, 0, True),
        "u": (1, 1, None, 1, False),
    }


def test_request_ids(spark):
    df = spark.createDataFrame(
        [("/rest/agile/1.0/board/17/issue?expand=changelog",),
         ("/rest/agile/1.0/board?projectKeyOrId=A%20B&startAt=0",), ("/rest/api/2/project",)],
        "r STRING",
    )
    found = df.select(
        pages.board_of_request(F.col("r")), pages.project_of_request(F.col("r"))
    ).collect()
    assert [tuple(r) for r in found] == [(17, None), (None, "A B"), (None, None)]


def test_scan_of_lines_and_of_whole_files(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text(
        "\n".join(json.dumps(e) for e in (page(0, bodies(1)), page(1, bodies(2))))
    )
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "a.json").write_text(json.dumps(page(0, bodies(1, 2)), indent=2))
    assert len(read(pages.scan_pages(spark, str(tmp_path / "lines")))) == 2
    assert len(read(pages.scan_pages(spark, str(tmp_path / "whole"), multi_line=True))) == 2


def test_project_keys_are_exact(spark):
    df = spark.createDataFrame(
        [(json.dumps({"key": k}),) for k in ("A", "a", " A", "B")], "body STRING"
    )
    assert pages.projects_by_key(df, ["A"]).count() == 1
    assert pages.projects_by_key(df, []).count() == 4
    keys = spark.createDataFrame([("A",), ("A",), ("B",)], "key STRING")
    assert pages.projects_in_table(df, keys).count() == 2


def test_audit_without_its_last_page_and_with_overlaps(landed):
    found = pages.audit_pages(
        landed(
            page(0, bodies(1, 2)), page(2, bodies(3)),
            page(0, bodies(1, 2, 3), request="o", total=4), page(2, bodies(3, 4), request="o", total=4),
            page(0, bodies(1), request="l"), page(1, bodies(2), request="l", isLast=True),
        )
    )
    rows = {r.request_id: tuple(r)[1:] for r in found.collect()}
    assert rows == {
        "r": (2, 3, None, 0, False),
        "o": (2, 4, 4, 0, True),
        "l": (2, 2, None, 0, True),
    }


def test_torn_lines_are_rejects_and_never_complete(spark):
    whole = [json.dumps(page(n, bodies(n), total=3)) for n in (0, 2)]
    torn = json.dumps(page(1, bodies(1), total=3))[:-4]
    df = pages.parse_pages(spark.createDataFrame([(t,) for t in (whole[0], torn, whole[1])], "page STRING"))
    assert [b for _, b in read(df)] == ['{"id":0}', '{"id":2}']
    assert [(r.reason, r.raw) for r in pages.torn_rejects(df).collect()] == [("line is no readable page", torn)]
    audit = pages.audit_pages(df).collect()
    assert [(r.request_id, r.gaps, r.complete) for r in audit] == [("r", 1, False)]


def test_a_stop_in_an_earlier_batch_holds(landed):
    first, second = landed(page(0, bodies(1), isLast=True)), landed(page(1, bodies(2)))
    assert pages.paged_items(second, earlier=pages.ledger(first)).collect() == []
    assert pages.paged_items(second).count() == 1
