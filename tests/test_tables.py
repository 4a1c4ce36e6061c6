from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

import pytest
from conftest import board, change, details, history, issue, project
from pyspark.sql import functions as F

from ticketmill import RunParams, run
from ticketmill.schemas import DATA_TYPES, KEYS, RECORDS, WIDTHS
from ticketmill.sinks import tables
from ticketmill.sources import runs


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


def records(spark, relation, *rows):
    names = [f for f in RECORDS[relation] if any(f.name in row for row in rows)]
    from pyspark.sql.types import StructType

    return spark.createDataFrame(
        [tuple(row.get(f.name) for f in names) for row in rows], StructType(names)
    )


def found(spark, database, relation):
    return spark.table(tables.table_name(relation, database))


def load(spark, database, relation, *rows, **options):
    return tables.load_all({relation: records(spark, relation, *rows)}, database, **options)


def test_creating_tables_twice_is_harmless(spark, database):
    for _ in range(2):
        tables.ensure_tables(spark, database)
    for relation in DATA_TYPES:
        got = found(spark, database, relation)
        assert sorted(got.dtypes) == sorted(spark.createDataFrame([], RECORDS[relation]).dtypes)
    assert found(spark, database, "releases").columns[:4] == [
        "release_id", "project_id", "project_key", "release_name"
    ]


def test_same_row_twice_goes_in_once(spark, database):
    tables.ensure_tables(spark, database)
    row = {"id": 1, "key": "FERRY", "name": "N", "archived": False}
    assert load(spark, database, "projects", row) == {"projects": 1}
    assert load(spark, database, "projects", row) == {"projects": 0}
    assert load(spark, database, "projects", {**row, "id": 2}, {**row, "id": 2}, row) == {"projects": 1}
    assert found(spark, database, "projects").count() == 2


def test_a_row_that_is_there_is_never_changed(spark, database):
    tables.ensure_tables(spark, database)
    load(spark, database, "projects", {"id": 1, "key": "OLD"})
    load(spark, database, "projects", {"id": 1, "key": "NEW"})
    assert [r["key"] for r in found(spark, database, "projects").collect()] == ["OLD"]


def test_composite_key(spark, database):
    tables.ensure_tables(spark, database)
    row = {"transition_id": 10, "transition_field": "status", "issue_id": 100, "issue_key": "P-1"}
    assert load(spark, database, "transitions", row, row) == {"transitions": 1}
    others = [{**row, "transition_field": "Link"}, {**row, "issue_id": 101}, row]
    assert load(spark, database, "transitions", *others) == {"transitions": 2}


def test_missing_columns_become_null(spark, database):
    tables.ensure_tables(spark, database)
    lone = records(spark, "projects", {"id": 1, "key": "A", "archived": True})
    other = records(spark, "projects", {"id": 2, "key": "B", "name": "N"})
    both = tables.align(lone, other)
    assert tables.load_all({"projects": both}, database) == {"projects": 2}
    got = {r["id"]: (r["name"], r["archived"]) for r in found(spark, database, "projects").collect()}
    assert got == {1: (None, True), 2: ("N", None)}


def test_empty_batch(spark, database):
    tables.ensure_tables(spark, database)
    none = records(spark, "projects", {"id": 1, "key": "A"}).limit(0)
    for mode in ("keyed", "plain"):
        assert tables.load_all({"projects": none}, database, mode) == {"projects": 0}


def test_plain_insert_keeps_duplicates(spark, database):
    tables.ensure_tables(spark, database)
    row = {"board_id": 1, "project_id": 1}
    assert load(spark, database, "boards", row, row, load_mode="plain") == {"boards": 2}


@pytest.mark.parametrize("mode", ["keyed", "plain"])
def test_required_columns(spark, database, mode):
    tables.ensure_tables(spark, database)
    bad = records(spark, "projects", {"id": 1, "key": None}, {"id": 2, "key": "B"})
    with pytest.raises(Exception, match="projects.key must not be null"):
        tables.load_all({"projects": bad}, database, mode)
    assert found(spark, database, "projects").count() == 0
    lacking = tables.missing_required(bad, "projects").collect()
    assert [(r["id"], r["missing_column"]) for r in lacking] == [(1, "key")]


def test_unknown_relation(spark):
    with pytest.raises(ValueError, match="invoices"):
        tables.load_all({"invoices": spark.range(1)})
    with pytest.raises(ValueError, match="invoices"):
        tables.create_statement("invoices")


@pytest.mark.parametrize(("custom_as", "kind"), [("map", "map<string,string>"), ("variant", "variant"), ("json", "string")])
def test_custom_field_column_per_target(spark, database, custom_as, kind):
    tables.ensure_tables(spark, database, custom_as=custom_as)
    when = datetime(2024, 1, 15, 9, tzinfo=timezone.utc)
    row = {"id": 1, "key": "P-1", "created": when, "custom_fields": {"story_points": "5", "n": None}}
    load(spark, database, "issues", row, {"id": 2, "key": "P-2"})
    got = found(spark, database, "issues").orderBy("id")
    assert dict(got.dtypes)["custom_fields"] == kind
    text = {"map": F.to_json("custom_fields"), "variant": F.to_json("custom_fields"),
            "json": F.col("custom_fields")}[custom_as]
    first, second = [r[0] for r in got.select(text).collect()]
    assert second is None
    assert '"story_points":"5"' in first and '"n":null' in first
    assert got.select(F.unix_seconds("created")).first()[0] == int(when.timestamp())


def test_widths_refuse_longer_text(spark, database):
    tables.ensure_tables(spark, database, widths=True)
    row = {"id": 1, "key": "K" * WIDTHS["projects"]["key"]}
    assert load(spark, database, "projects", row) == {"projects": 1}
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load(spark, database, "projects", {"id": 2, "key": row["key"] + "K"})


def test_bucketed_target_is_not_shuffled(spark, database):
    tables.ensure_tables(spark, database, buckets=8)
    load(spark, database, "boards", {"board_id": 1, "project_id": 1})
    batch = records(spark, "boards", {"board_id": 1, "project_id": 1}, {"board_id": 2, "project_id": 1})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        target = found(spark, database, "boards")
        fresh = tables.absent_rows(batch, target, KEYS["boards"], ["project_id"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert scans and all("Bucketed: true" in line for line in scans)
        assert [r["board_id"] for r in fresh.collect()] == [2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_keys_of_few_bytes_are_not_broadcast(spark, tmp_path):
    """An exploded list seems small to the planner; what is read tells that it is not."""
    lists = F.transform(F.sequence(F.lit(1), F.lit(40)), lambda n: F.concat(F.lit("k"), n))
    spark.range(20_000).select("id", lists.alias("keys"), *[F.sha2(F.concat("id", F.lit(i)), 256).alias(f"c{i}") for i in range(9)]).write.parquet(f"{tmp_path}/batch")
    spark.range(50).select(F.col("id"), F.lit("k3").alias("key")).write.parquet(f"{tmp_path}/target")
    batch = spark.read.parquet(f"{tmp_path}/batch").select("id", F.explode("keys").alias("key"))
    target = spark.read.parquet(f"{tmp_path}/target")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3m")
    try:
        fresh = tables.absent_rows(batch, target, ["id", "key"], ["key"])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin [^\n]*LeftSemi", plan) and not re.search(r"BroadcastHashJoin [^\n]*LeftSemi", plan)
    assert fresh.count() == 20_000 * 40 - 50


@pytest.fixture
def tracker(make_raw):
    """Two projects that share a board, hence an issue, with one bad row of each kind."""
    link = [change("Link", toString="first"), change("Link", toString="second")]
    return make_raw(
        [project(), project(id="2", key="DOCK", name="Dock"), project(id="x", key="BAD")],
        {"/rest/api/2/project/520": details(versions=[{"id": "1"}, {"id": "bad"}]),
         "/rest/api/2/project/2": details()},
        [("FERRY", board(1)), ("DOCK", board(1)), ("DOCK", board(2)), ("DOCK", board("bad"))],
        [(1, issue(histories=[history(items=link)])), (2, issue("7")), (2, issue("bad"))],
    )


def test_run_writes_counts_and_loads(spark, tmp_path, database, tracker):
    params = RunParams(str(tmp_path / "out"), "20240601", "jsonl", database=database)
    result = run(spark, tracker, params)
    assert [tuple(r) for r in result.summary.collect()] == [
        ("boards", 3), ("issues", 3), ("projects", 2), ("releases", 1), ("transitions", 4)
    ]
    assert result.inserted == {
        "projects": 2, "releases": 1, "boards": 2, "issues": 2, "transitions": 1
    }
    kept = {r["id"]: r["project_id"] for r in found(spark, database, "issues").collect()}
    assert kept == {7001: 2, 7: 2}
    assert found(spark, database, "transitions").first()["to_string"] == "first"
    assert runs.read_run(spark, params.uri, "issues", "20240601", "jsonl").count() == 3
    assert not any(run(spark, tracker, params).inserted.values())


def test_bulk_load_takes_every_written_row(spark, tmp_path, database, tracker):
    params = RunParams(str(tmp_path / "out"), "20240601", database=database, load_mode="bulk",
                       data_types="boards,issues")
    assert run(spark, tracker, params).inserted == {"boards": 3, "issues": 3}
    assert tables.bulk_load(spark, params.uri, "20240601", ["issues"], database) == {"issues": 3}
    assert found(spark, database, "issues").count() == 6


def test_run_of_nothing(spark, tmp_path, make_raw):
    result = run(spark, make_raw(), RunParams(str(tmp_path), data_types=[]))
    assert result.summary.count() == 0 and result.inserted == {}
