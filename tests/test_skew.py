"""One key that holds a third of all rows: results whole, and equal to brute force."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ticketmill.operators import dedupe
from ticketmill.operators.dedupe import first_board_wins, first_per_key, first_places, only_first_places
from ticketmill.sinks.tables import absent_rows
from ticketmill.sources import pages


@pytest.fixture(scope="module")
def listed(spark):
    """30,000 entries; a third of them copies of one issue of one project."""
    rows = spark.range(30_000, numPartitions=16)
    hot = F.col("id") % 3 == 0
    return rows.select(
        F.when(hot, 1).otherwise(F.col("id") % 7).cast("bigint").alias("project_id"),
        F.when(hot, "hot").otherwise((F.col("id") % 4001).cast("string")).alias("issue_ref"),
        (F.xxhash64("id") % 5).alias("board_ord"),
        (F.xxhash64("id", F.lit(1)) % 10**9).alias("ord"),
        F.col("id").alias("row"),
    )


def test_first_board_wins(listed):
    best = {}
    for r in listed.collect():
        key, place = (r.project_id, r.issue_ref), (r.board_ord, r.ord)
        if key not in best or place < best[key][0]:
            best[key] = (place, r.row)
    got = {(r.project_id, r.issue_ref): r.row for r in first_board_wins(listed).collect()}
    assert got == {key: row for key, (_, row) in best.items()}


def test_first_places_of_repeated_issues(listed):
    """The choice by keys alone gives the same rows; places that tie keep one entry."""
    twice = listed.unionByName(listed).withColumn("entry", F.monotonically_increasing_id())
    placed = twice.withColumn("place", F.struct("board_ord", "ord", "entry"))
    left = only_first_places(placed, first_places(placed.select("project_id", "issue_ref", "place")))
    want = {(r.project_id, r.issue_ref): r.row for r in first_board_wins(listed).collect()}
    got = [((r.project_id, r.issue_ref), r.row) for r in left.collect()]
    assert len(got) == len(want) and dict(got) == want


def test_marked_entries(spark, monkeypatch):
    """A bit for each entry keeps exactly the chosen ones, at the ends of a row of marks and of a task's numbers too."""
    numbers = [0, 1, 7, 8, 32_767, 32_768, 32_769, 65_536, 65_537, 2**33 - 1, 2**33, 2**33 + 1, 5 * 2**33 + 40_000]
    entries = spark.createDataFrame([(n,) for n in numbers], "entry BIGINT")
    for start in (0, 1):
        chosen = entries.where(F.col("entry").isin(numbers[start::2]))
        marks = dedupe.entry_marks(chosen.unionByName(chosen))
        assert [r.entry for r in dedupe.marked_only(entries, marks).orderBy("entry").collect()] == numbers[start::2]
    assert dedupe.marked_only(entries, dedupe.entry_marks(entries.where("false"))).count() == 0
    monkeypatch.setattr(dedupe, "MOST_MARKS", 1)
    assert dedupe.marked_only(entries, marks).count() == len(numbers)


def test_a_hot_board_is_split(spark, make_raw, tmp_path):
    """Boards too large to broadcast and a third of all entries on one of them: the join splits its partition."""
    from conftest import board, issue
    from ticketmill import build
    from ticketmill.sources import storage

    bodies = [(1 if n % 3 == 0 else 2 + n % 400, issue(str(n), summary="x" * 400)) for n in range(6_000)]
    boards = [("FERRY", board(n)) for n in range(1, 402)]
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        plans, write = {}, storage.stage_in(spark, storage.work_folder(spark, "skew"))

        def stage(df, name):
            if name == "issues":
                df.write.format("noop").mode("overwrite").save()
                df.collect()
                plans[name] = df._jdf.queryExecution().executedPlan().toString()
            return write(df, name)

        raw = make_raw(boards=boards, issues=bodies)
        raw = type(raw)(raw.projects, raw.details, raw.boards, raw.issues.repartition(16))
        relations = build(raw, data_types=["issues"], stage=stage)
        assert relations["issues"].count() == 6_000
        assert "SortMergeJoin(skew=true)" in plans["issues"]
    finally:
        for key in small:
            spark.conf.unset(key)


def test_each_map_task_sends_at_most_one_row_per_key(listed):
    plan = first_per_key(listed, ["issue_ref"], ["ord"])._jdf.queryExecution().executedPlan()
    lines = [line.strip(" +-:") for line in plan.toString().splitlines()]
    kinds = [w for line in lines for w in ("Final", "Exchange", "Partial")
             if (w == "Exchange" and line.startswith(w)) or line.endswith(f"1, {w}")]
    assert kinds == ["Final", "Exchange", "Partial"]


def test_absent_rows_against_brute_force(spark, listed):
    target = spark.createDataFrame([("hot",)] + [(str(n),) for n in range(0, 4001, 2)], "issue_ref STRING")
    got = {r.issue_ref: r.row for r in absent_rows(listed, target, ["issue_ref"], ["ord"]).collect()}
    best = {}
    for r in listed.collect():
        if r.issue_ref != "hot" and int(r.issue_ref) % 2:
            best[r.issue_ref] = min(best.get(r.issue_ref, (r.ord, r.row)), (r.ord, r.row))
    assert got == {key: row for key, (_, row) in best.items()}


def test_one_request_with_most_pages(spark):
    def page(request, n, **other):
        return (json.dumps({"request_id": request, "startAt": n, "issues": [{"id": n}], **other}),)

    texts = [page("hot", n, total=4_000) for n in range(5_000) if n != 77]
    texts += [page(f"r{n}", 0, isLast=True) for n in range(500)]
    landed = pages.parse_pages(spark.createDataFrame(texts, "page STRING").repartition(8))
    read = pages.paged_items(landed).groupBy("request_id").count().collect()
    counts = {r.request_id: r["count"] for r in read}
    assert counts.pop("hot") == 3_999 and set(counts.values()) == {1} and len(counts) == 500
    audit = {r.request_id: r for r in pages.audit_pages(landed).collect()}
    assert (audit["hot"].gaps, audit["hot"].received, audit["hot"].complete) == (1, 4_999, False)
    assert all(audit[f"r{n}"].complete for n in range(500))
