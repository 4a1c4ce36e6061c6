from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F
from ticketmill.llm import warc

COLUMNS = "page_id bigint, url string, html string, at int, record string"


def rows(n):
    found = [(i * 7 % n, f"http://x/{i}", "é" * (i % 50) + f"<p>{i}") for i in range(n)]
    return [*found, (3, None, "twice"), (3, None, "twice"), (None, "http://none", None), (4, "", "")]


def pages(spark, found):
    return spark.createDataFrame([(*r, 1, "x") for r in found], COLUMNS).repartition(4)


def test_archive_is_ordered_and_complete(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_RECORDS", 10)
    table = pages(spark, rows(95))
    whole = {hashlib.sha256(bytes(r.record)).hexdigest(): bytes(r.record) for r in warc.records(table).collect()}
    got = sorted(warc.archive(spark, table).collect(), key=lambda r: r["at"])
    assert [r["at"] for r in got] == list(range(99))
    ends: dict = {}
    for r in got:
        record = whole[r.digest]
        assert r.warc_file == r["at"] // 10 and r.length == len(record)
        assert r.start == ends.get(r.warc_file, 0)
        ends[r.warc_file] = r.start + r.length
        head, _, rest = record.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.0\r\n") and rest.endswith(b"\r\n\r\n") and b"\r\nWARC-Date: 2" in head
        assert f"Content-Length: {len(rest) - 4}".encode() in head
    assert [r.page_id for r in got[3:7]] == [3, 3, 3, 4] and got[-1].page_id is None


@pytest.mark.parametrize("fanout", [2, 16])
def test_audit_of_a_replica_archived_on_its_own(spark, fanout):
    found = rows(200)
    ours = warc.archive(spark, pages(spark, found))
    at = {(r.page_id, r.url): r["at"] for r in ours.collect()}
    lost, changed = {0, 17, 199}, {5, 100, 101}
    other = [(i, u, "x" + (h or "") if i in changed else h) for i, u, h in found if i not in lost]
    # One of two equal records, one without an id, and one that only the replica has.
    other.remove((3, None, "twice"))
    other = [(i, u, "now here" if i is None else h) for i, u, h in other] + [(-7, "http://new", "")]
    got = warc.audit(spark, ours, warc.archive(spark, pages(spark, other)), fanout).collect()
    states = sorted((r.page_id is None, r.page_id, r.state) for r in got if r.page_id is not None)
    assert states == sorted([(False, i, "missing") for i in (*lost, 3)] + [(False, i, "altered") for i in changed] + [(False, -7, "added")])
    assert [r.state for r in got if r.page_id is None] == ["altered"]
    by_page = {i: at[i, u] for i, u, _ in found if i in lost | changed}
    assert {r.page_id: r.place for r in got if r.page_id in by_page} == by_page
    assert warc.audit(spark, ours, warc.archive(spark, pages(spark, found[::-1])), fanout).collect() == []


def test_one_lost_record_is_one_finding(spark):
    found = [(i, f"http://x/{i}", f"page {i}") for i in range(200)]
    ours, theirs = (warc.archive(spark, pages(spark, some)) for some in (found, found[:50] + found[51:]))
    (only,) = warc.audit(spark, ours, theirs).collect()
    assert (only.page_id, only.place, only.state) == (50, 50, "missing")


def test_what_is_compared_follows_the_damage(spark):
    found = [(i, f"http://x/{i}", f"page {i}") for i in range(600)]
    other = [(i, u, "other" if i == 77 else h) for i, u, h in found if i != 300]
    one, two = (warc.archive(spark, pages(spark, some)) for some in (found, other))
    height = warc.height_of(one, two, fanout=4)
    ours, theirs = (warc.tree(spark, side, height, 4) for side in (one, two))
    assert ours[-1].count() == 1
    for level, (a, b) in enumerate(zip(ours, theirs, strict=True)):
        hashes = {r.node: r["hash"] for r in a.collect()}
        differ = {n for n, h in hashes.items() if h != {r.node: r["hash"] for r in b.collect()}.get(n)}
        assert differ == ({77 // 4**level, 300 // 4**level} if level <= height else {0})
    root = ours[-1].first()
    assert (root["from"].warc_file, root["from"].offset) == (0, 0)
    assert sorted(r.node for r in warc.differing(spark, ours, theirs, 4).collect()) == [77, 300]


def test_no_exchange_carries_a_record(spark):
    plans, table = [], pages(spark, rows(50))
    real = warc.staged
    warc.staged = lambda s, df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(s, df, name)
    try:
        warc.audit(spark, warc.archive(spark, table), warc.archive(spark, warc.with_faults(table))).collect()
    finally:
        warc.staged = real
    assert plans and not any("record#" in line or "html#" in line for plan in plans for line in plan.splitlines() if "FileScan" in line)


def test_empty(spark):
    none = warc.archive(spark, pages(spark, []))
    some = warc.archive(spark, pages(spark, rows(20)))
    assert warc.audit(spark, none, none).collect() == []
    assert {r.state for r in warc.audit(spark, some, none).collect()} == {"missing"}
    assert [r.state for r in warc.audit(spark, none, some).collect()] == ["added"] * 24
