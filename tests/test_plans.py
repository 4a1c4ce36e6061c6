"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ticketmill import build
from ticketmill.operators.issues import in_date_range, parse_issues
from ticketmill.schemas import RECORDS
from ticketmill.sinks.files import write_run
from ticketmill.sources import runs, storage
from ticketmill.sources.pages import scan_pages, until_stop
from ticketmill.workload import queries as registered
from ticketmill.workload import raw as workload

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def staged(spark):
    """The plan of every frame at the moment it is staged, by name."""
    plans, write = {}, storage.stage_in(spark, storage.work_folder(spark, "plans"))

    def stage(df, name):
        plans[name] = plan_of(df)
        return write(df, name)

    relations = build(workload.raw(spark, SF), custom_fields=workload.CUSTOM_FIELDS, stage=stage)
    return plans, relations


def test_details_and_histories_move_in_no_shuffle(staged):
    plans, relations = staged
    # Entries are staged as they are parsed; the exchange there deals out the test table that bodies are made of.
    assert "ENSURE_REQUIREMENTS" not in plans["parsed_entries"]
    # First places come from keys: combined before the one exchange, of two columns and a place.
    first = plans["repeated"]
    assert len(re.findall(r"Exchange hashpartitioning\(project_id#\d+L, issue_ref#\d+, ", first)) == 1
    assert first.count("Exchange hashpartitioning") == 1 and "partial_min(place" in first
    read = re.search(r"FileScan parquet \[(board_id[^]]*)\]", first).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {"board_id", "ord", "issue_ref", "entry"}
    # Boards and repeated issues are known to be small, so the entries stay where they are.
    for name in ("issues", "transitions"):
        plan = plan_of(relations[name])
        assert "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") == 2


def test_a_body_is_parsed_once(staged):
    assert staged[0]["parsed_entries"].count("from_json(StructField(id") == 1


def test_relations_read_only_their_columns(spark, staged):
    relations = staged[1]
    spark.conf.set("spark.sql.debug.maxToStringFields", 200)
    issues, transitions = plan_of(relations["issues"]), plan_of(relations["transitions"])
    spark.conf.unset("spark.sql.debug.maxToStringFields")

    def columns(plan):
        read = re.search(r"FileScan parquet \[(board_id[^]]*entry[^]]*)\]", plan).group(1)
        return {c.split("#")[0] for c in read.split(",")}

    places = {"board_id", "ord", "issue_ref", "entry"}
    assert "histories" not in columns(issues)
    assert columns(transitions) == places | {"id", "key", "histories", "reason"}


def test_no_python_in_any_relation(staged):
    plans, relations = staged
    every = list(plans.values()) + [plan_of(df) for _, df in relations.items()]
    assert not any(re.search(r"Python|Pandas|Arrow(Eval|Map)", plan) for plan in every)


def test_big_sides_are_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        every = plan_of(build(workload.raw(spark, SF))["transitions"])
        assert "Broadcast" not in every and "Cartesian" not in every
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_date_range_reaches_the_scan(spark, tmp_path):
    issues = spark.createDataFrame([], RECORDS["issues"])
    filled = issues.union(spark.range(3).select(
        *[(F.lit("1") if f.name == "key" else F.lit(None)).cast(f.dataType) for f in RECORDS["issues"]]
    ))
    write_run({"issues": filled}, str(tmp_path), "1")
    back = runs.read_run(spark, str(tmp_path), "issues", "1")
    wanted = back.where(in_date_range(F.col("created"), F.col("updated"), "2024-01-01", None))
    plan = plan_of(wanted.select("id"))
    assert "PushedFilters: [Or(GreaterThanOrEqual(created" in plan
    assert "ReadSchema: struct<id:bigint,created:timestamp,updated:timestamp>" in plan


def test_stop_rule_does_not_move_payloads(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"request_id":"r","startAt":0,"issues":[{"id":1}]}')
    pages = scan_pages(spark, str(tmp_path))
    plan = plan_of(until_stop(pages, storage.stage_in(spark, storage.work_folder(spark, "s"))))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_only_what_is_wanted_is_parsed(spark):
    source = workload.raw(spark, SF)
    issues = plan_of(build(source, data_types=["issues"])["issues"])
    transitions = plan_of(build(source, data_types=["transitions"])["transitions"])
    wire = "from_json(StructField(id,StringType,true), StructField(key"
    read = {name: plan[plan.index(wire) :].split("_corrupt")[0]
            for name, plan in (("issues", issues), ("transitions", transitions))}
    assert "histories" not in read["issues"] and "priority" in read["issues"]
    assert "histories" in read["transitions"] and "priority" not in read["transitions"]


def test_wire_schema_holds_configured_fields_only(spark):
    df = spark.createDataFrame([(1, 1, "{}")], "board_id BIGINT, ord BIGINT, body STRING")
    parsed = parse_issues(df, {"a": "customfield_1", "b": "customfield_1", "c": "summary"})
    names = [n for n in parsed.schema["fields"].dataType.names if n.startswith("custom")]
    assert names == ["customfield_1"]


def test_what_the_histories_of_an_entry_share_is_written_once(spark):
    """Made bodies: the author's JSON is made by one expression, not by a lambda for every history."""
    bodies = workload.issue_bodies(workload.listing(spark, SF))
    plan = bodies._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" AS author_json#") == 1
    entry = bodies.where("body LIKE '%Link%'").selectExpr("from_json(body, 'changelog STRING') AS b").first()
    assert '"fieldtype":"second"' in entry["b"]["changelog"]


def test_queries_parse_only_the_fields_that_they_read(spark):
    """Whole issues are parsed where whole issues are read; others skip details, authors and values."""
    unread = {
        "f1_date_range": ("priority", "labels"), "p9_issue_project": ("priority", "labels"),
        "v_rejected_issues": ("priority", "labels"), "l5_required_columns": ("priority", "labels"),
        "v_issues_good": ("priority", "labels"), "v_nulled_values": ("priority", "labels"),
        "f4_tracked_fields": ("displayName", "fromString"),
    }
    for name, fields in unread.items():
        plan = plan_of(registered.queries()[name](spark, SF))
        wire = plan[plan.index("from_json(StructField(id,StringType,true), StructField(key") :].split("_corrupt")[0]
        assert "StructField(fields," in wire and not any(f"StructField({field}," in wire for field in fields), name


def test_history_times_pass_the_end_of_a_month(spark):
    """Made bodies: a history is as many days after shipping as its place, over months and years, in odd hours too."""
    entries = workload.listing(spark, SF).limit(3)
    for shipped in ("1996-02-27 00:00:00", "1999-12-25 13:07:09.25", "2000-03-01 00:00:00"):
        ship = F.lit(shipped).cast("timestamp")
        odd = entries.withColumn("l_shipdate", ship).withColumn("l_linenumber", F.lit(7)).withColumn("o_orderdate", ship)
        form = "changelog STRUCT<histories: ARRAY<STRUCT<created: STRING>>>"
        for row in workload.issue_bodies(odd).select(F.from_json("body", form).alias("b")).collect():
            start = datetime.fromisoformat(shipped)
            days = [start + timedelta(days=i) for i in range(1, 8)]
            expected = [f"{day.isoformat(timespec='milliseconds')}+0000" for day in days]
            expected[5] = start.date().isoformat()
            assert [h.created for h in row.b.changelog.histories] == expected


def test_parsed_bodies_are_never_broadcast(spark):
    """The planner takes them for smaller than the table they are made from; as hash tables they are many times larger."""
    boards = plan_of(build(workload.raw(spark, SF), data_types=["boards"])["boards"])
    assert "SortMergeJoin [path#" in boards and "SortMergeJoin [project_key#" in boards
    assert not re.search(r"BroadcastHashJoin \[(path|project_key|owner_key)#", boards)


def test_large_sides_move_the_winners_alone(spark):
    """Where boards are too large to broadcast, keys find the first places, and losers leave before the wide rows move."""
    kept, write = {}, storage.stage_in(spark, storage.work_folder(spark, "large"))

    def stage(df, name):
        kept[name] = df
        return write(df, name)

    source = workload.raw(spark, SF)
    small = {n: sorted(map(str, df.collect())) for n, df in build(source, stage=storage.stage_in(
        spark, storage.work_folder(spark, "small"))).as_dict().items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = build(source, stage=stage)
        assert {n: sorted(map(str, df.collect())) for n, df in large.as_dict().items()} == small
        plan = plan_of(kept["issues"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = plan.split("SortMergeJoin [entry#", 1)[1].split("Exchange hashpartitioning(entry#")[1]
    assert "getbit" in wide and "BroadcastHashJoin" in wide and "Exchange hashpartitioning" not in wide


def test_one_copy_where_boards_come_twice(spark):
    """A staged plan gives the rows of one that is not staged, whether boards are small or not."""
    source = workload.raw(spark, SF)
    twice = replace(source, boards=source.boards.unionByName(source.boards))

    def rows(**options):
        made = build(twice, data_types=["issues", "transitions"], **options).as_dict()
        return {name: sorted(map(str, df.collect())) for name, df in made.items()}

    want = rows()
    for small in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
        try:
            stage = storage.stage_in(spark, storage.work_folder(spark, "twice"))
            assert rows(stage=stage, one_copy=True) == want
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
