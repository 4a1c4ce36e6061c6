from __future__ import annotations

import csv
import io
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from ticketmill.schemas import RECORDS
from ticketmill.sinks.files import run_path, write_run
from ticketmill.sources import runs, storage

SUFFIX = "20240601"


@pytest.fixture
def boards(spark):
    def make(*names, first=1):
        rows = [(first + n, 10, name, "scrum") for n, name in enumerate(names)]
        return spark.createDataFrame(rows, RECORDS["boards"])

    return make


@pytest.fixture
def issues(spark):
    blank = dict.fromkeys(RECORDS["issues"].names)

    def make(**values):
        row = {**blank, "id": 1, "key": "FERRY-8", **values}
        return spark.createDataFrame([tuple(row.values())], RECORDS["issues"])

    return make


def parts(root, name, suffix=SUFFIX):
    folder = root / name / f"{name}_{suffix}"
    return sorted(p for p in folder.rglob("part-*")) if folder.exists() else []


def names_in(spark, root, fmt="parquet", suffix=SUFFIX):
    return sorted(
        r["name"] for r in runs.read_run(spark, str(root), "boards", suffix, fmt).collect()
    )


@pytest.mark.parametrize(("fmt", "ending"), [("parquet", ".snappy.parquet"), ("csv", ".csv"), ("jsonl", ".json")])
def test_layout_and_round_trip(spark, tmp_path, issues, fmt, ending):
    tricky = 'a "quoted", text\nwith a line break; \\ and é'
    created = datetime(2023, 5, 4, 10, 20, 30, 123456, tzinfo=timezone.utc)
    df = issues(summary=tricky, labels="", epic_done=True, created=created,
                custom_fields={"team": 'x "y", z', "none": None})
    write_run({"issues": df}, f"{tmp_path}/", SUFFIX, fmt)
    found = parts(tmp_path, "issues")
    assert found and all(p.name.endswith(ending) for p in found)
    back = runs.read_run(spark, str(tmp_path), "issues", SUFFIX, fmt)
    assert back.schema == RECORDS["issues"]
    row = back.first()
    assert row["summary"] == tricky
    assert row["custom_fields"] == {"team": 'x "y", z', "none": None}
    assert (row["id"], row["epic_done"], row["epic_id"]) == (1, True, None)
    assert back.select(F.unix_micros("created")).first()[0] == int(created.timestamp()) * 10**6 + 123456


def test_csv_parts_have_headers_and_plain_values(tmp_path, issues):
    df = issues(created=datetime(2023, 5, 4, 10, 20, 30, tzinfo=timezone.utc), custom_fields={"a": "1"})
    write_run({"issues": df}, str(tmp_path), SUFFIX, "csv")
    texts = [p.read_text() for p in parts(tmp_path, "issues")]
    assert all(text.startswith("id,key,project_id,") for text in texts)
    (row,) = [r for text in texts for r in csv.DictReader(io.StringIO(text))]
    assert list(row) == RECORDS["issues"].names
    assert (row["custom_fields"], row["epic_id"]) == ('{"a":"1"}', "")
    assert row["created"] == "2023-05-04 10:20:30.000000+00:00"


def test_json_lines_write_nulls(tmp_path, issues):
    write_run({"issues": issues()}, str(tmp_path), SUFFIX, "jsonl")
    line = json.loads("".join(p.read_text() for p in parts(tmp_path, "issues")))
    assert list(line) == RECORDS["issues"].names and line["epic_id"] is None


@pytest.mark.parametrize("swap", [False, True])
def test_replace_leaves_only_the_second_run(spark, tmp_path, boards, swap):
    write_run({"boards": boards("FIRST")}, str(tmp_path), SUFFIX, swap=swap)
    write_run({"boards": boards("SECOND")}, str(tmp_path), SUFFIX, swap=swap)
    assert names_in(spark, tmp_path) == ["SECOND"]
    assert [p.name for p in (tmp_path / "boards").iterdir()] == [f"boards_{SUFFIX}"]


def test_append_keeps_both(spark, tmp_path, boards):
    for name in ("FIRST", "SECOND"):
        write_run({"boards": boards(name)}, str(tmp_path), SUFFIX, mode="append")
    assert names_in(spark, tmp_path) == ["FIRST", "SECOND"]


def test_other_dates_and_relations_are_left_alone(spark, tmp_path, boards, issues):
    write_run({"boards": boards("A"), "issues": issues()}, str(tmp_path), SUFFIX)
    write_run({"boards": boards("B")}, str(tmp_path), "20240602")
    write_run({"boards": boards("C")}, str(tmp_path), SUFFIX)
    assert names_in(spark, tmp_path) == ["C"]
    assert names_in(spark, tmp_path, suffix="20240602") == ["B"]
    assert runs.read_run(spark, str(tmp_path), "issues", SUFFIX).count() == 1
    every = runs.read_runs(spark, str(tmp_path), "boards")
    assert sorted((r["run"], r["name"]) for r in every.collect()) == [
        (SUFFIX, "C"), ("20240602", "B")
    ]


def test_empty_relation_has_no_parts(spark, tmp_path, boards):
    none = boards("x").limit(0)
    write_run({"boards": none}, str(tmp_path), SUFFIX)
    assert parts(tmp_path, "boards") == []
    write_run({"boards": boards("A")}, str(tmp_path), SUFFIX)
    write_run({"boards": none}, str(tmp_path), SUFFIX, mode="append")
    assert names_in(spark, tmp_path) == ["A"]
    write_run({"boards": none}, str(tmp_path), SUFFIX)
    assert parts(tmp_path, "boards") == []
    assert runs.read_run(spark, str(tmp_path), "boards", SUFFIX).count() == 0
    assert runs.written_types(spark, str(tmp_path), SUFFIX) == ()


def test_parts_hold_at_most_max_rows(spark, tmp_path, boards):
    df = boards(*[str(n) for n in range(25)]).coalesce(1)
    write_run({"boards": df}, str(tmp_path), SUFFIX, max_rows=10)
    sizes = [spark.read.parquet(str(p)).count() for p in parts(tmp_path, "boards")]
    assert sorted(sizes) == [5, 10, 10]


def test_all_null_columns_keep_their_types(spark, tmp_path, issues):
    write_run({"issues": issues().select("id", "key")}, str(tmp_path), SUFFIX)
    assert spark.read.parquet(run_path(str(tmp_path), "issues", SUFFIX)).schema == RECORDS["issues"]


def test_bad_arguments(tmp_path, boards):
    for wrong in ({"fmt": "orc"}, {"mode": "upsert"}, {"max_rows": 0}):
        with pytest.raises(ValueError):
            write_run({"boards": boards("A")}, str(tmp_path), SUFFIX, **wrong)
    with pytest.raises(ValueError, match="invoices"):
        write_run({"invoices": boards("A")}, str(tmp_path), SUFFIX)


def test_bulk_prefixes_skip_what_was_not_asked_for_or_written(spark, tmp_path, boards, issues):
    write_run({"boards": boards("A"), "issues": issues()}, str(tmp_path), SUFFIX)
    assert set(runs.bulk_prefixes(spark, str(tmp_path), SUFFIX)) == {"boards", "issues"}
    assert set(runs.bulk_prefixes(spark, str(tmp_path), SUFFIX, "boards,projects")) == {"boards"}
    assert runs.bulk_prefixes(spark, str(tmp_path), "19990101") == {}


def test_work_folder_lies_where_the_session_says(spark):
    folder = storage.work_folder(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or folder.startswith(f"{base}/x-")
    staged = storage.stage_in(spark, folder)(spark.range(3).toDF("n"), "n")
    assert staged.count() == 3
    assert "LogicalRDD" not in staged._jdf.queryExecution().toString()
    storage.delete(spark, folder)
    assert not storage.has_files(spark, folder)


@pytest.mark.parametrize("step", ["point", "keep_only"])
@pytest.mark.parametrize("fmt", ["parquet", "jsonl"])
def test_a_crash_while_replacing_leaves_a_whole_run(spark, tmp_path, boards, monkeypatch, step, fmt):
    """Between writing and pointing the old run is read, between pointing and deleting the new one."""
    write_run({"boards": boards("OLD", "TOO")}, str(tmp_path), SUFFIX, fmt, swap=True)

    def broken(*args):
        raise RuntimeError("lost the driver here")

    with monkeypatch.context() as patch:
        patch.setattr(storage, step, broken)
        with pytest.raises(RuntimeError, match="lost"):
            write_run({"boards": boards("NEW")}, str(tmp_path), SUFFIX, fmt, swap=True)
    assert names_in(spark, tmp_path, fmt) == (["OLD", "TOO"] if step == "point" else ["NEW"])
    assert runs.read_runs(spark, str(tmp_path), "boards", fmt).count() == (2 if step == "point" else 1)
    write_run({"boards": boards("LAST")}, str(tmp_path), SUFFIX, fmt, swap=True)
    assert names_in(spark, tmp_path, fmt) == ["LAST"]
    versions = [p for p in (tmp_path / "boards" / f"boards_{SUFFIX}").iterdir() if p.is_dir()]
    assert len(versions) == 1


def test_a_plain_run_is_kept_until_its_versioned_replacement_is_pointed_at(spark, tmp_path, boards, monkeypatch):
    write_run({"boards": boards("PLAIN")}, str(tmp_path), SUFFIX)

    def broken(*args):
        raise RuntimeError("lost the driver here")

    with monkeypatch.context() as patch:
        patch.setattr(storage, "point", broken)
        with pytest.raises(RuntimeError):
            write_run({"boards": boards("NEW")}, str(tmp_path), SUFFIX, swap=True)
    assert names_in(spark, tmp_path) == ["PLAIN"]
    write_run({"boards": boards("NEW")}, str(tmp_path), SUFFIX, swap=True)
    assert names_in(spark, tmp_path) == ["NEW"]
    write_run({"boards": boards("MORE")}, str(tmp_path), SUFFIX, mode="append")
    assert names_in(spark, tmp_path) == ["MORE", "NEW"]
    write_run({"boards": boards()}, str(tmp_path), SUFFIX, swap=True)
    assert names_in(spark, tmp_path) == [] and not parts(tmp_path, "boards")
    write_run({"boards": boards("AGAIN")}, str(tmp_path), SUFFIX)
    assert names_in(spark, tmp_path) == ["AGAIN"]


def test_many_small_parts_are_written_by_many_tasks(spark, tmp_path):
    """Rows of one task that fill a part for every shuffle partition are dealt out; fewer rows stay together."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def writers(rows: int) -> int:
        boards = spark.range(rows, numPartitions=1).selectExpr("id AS board_id", "id AS project_id", "'b' AS name")
        path = tmp_path / str(rows)
        assert write_run({"boards": boards}, str(path), "20240101", max_rows=10) == {"boards": rows}
        parts = list(path.glob("boards/boards_20240101/part-*"))
        assert sum(spark.read.parquet(str(part)).count() for part in parts[:3]) <= 30
        return len({part.name.split("-")[1] for part in parts})

    assert writers(10 * tasks) == 1
    assert writers(30 * tasks) == tasks
