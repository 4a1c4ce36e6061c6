from __future__ import annotations

import re

import pytest
from ticketmill.llm import mixing

COLUMNS = "doc_id bigint, text string, source string, size int, copy int, rate int"


def plain_targets(sizes: dict, weights=(1, 2, 3), most=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        share = sum(weight[s] for s in order if s not in stopped)
        left = total - sum(most * sizes[s] for s in stopped)
        more = {s for s in order if s not in stopped and weight[s] * left >= most * sizes[s] * share}
        if not more:
            return {s: float(most * sizes[s]) if s in stopped else weight[s] * left / share for s in order}
        stopped |= more


def rows(n: int):
    out = []
    for i in range(n):
        source = ["b", "a", None, "", "é", "z"][min(i % 11, 5)]
        out.append((i, " ".join(["w"] * (i % 37)) + "\t\n", source, 1, 2, 3))
    return [*out, (5, None, "a", 0, 0, 0), (5, "", "only empty", 0, 0, 0), (None, "no id\x0bhere", "b", 0, 0, 0), (7, "x y", "b", 0, 0, 0), (7, "x y", "b", 0, 0, 0)]


def test_targets_and_copies(spark):
    data = rows(3000)
    docs = spark.createDataFrame(data, COLUMNS).repartition(5)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes: dict = {}
    for _, text, source, *_ in data:
        sizes[source] = sizes.get(source, 0) + size(text)
    targets = plain_targets(sizes)
    got = mixing.repetitions(spark, docs).collect()
    assert len(got) == len(data)
    taken: dict = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], rel=1e-12)
        rate = r.target / r.source_size if r.source_size else 0
        assert r.copies in (int(rate), int(rate) + 1) and r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 0.15 * targets[source] + 100
    again = mixing.repetitions(spark, docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mix = mixing.repeated(spark, docs)
    assert mix.columns == docs.columns
    count: dict = {}
    for r in mix.collect():
        key = (str(r.doc_id), r.text, r.source)
        count[key] = count.get(key, 0) + 1
    want: dict = {}
    for r in got:
        if r.copies and r.doc_id is not None and r.doc_id > 100:
            want[(str(r.doc_id), r.source)] = r.copies
    assert want == {(i, s): n for (i, _, s), n in count.items() if i != "None" and int(i) > 100}


def test_all_sources_at_their_stop_or_empty(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a", "y")], "doc_id bigint, text string, source string")
    got = {r.source: r.target for r in mixing.repetitions(spark, docs).collect()}
    assert got == {"x": 1.0, "y": 2.0}
    for data in ([], [(1, None, None)], [(1, "", "x"), (2, " ", "y")]):
        docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
        assert [(r.target, r.copies) for r in mixing.repetitions(spark, docs).collect()] == [(0.0, 0)] * len(data)
        assert mixing.repeated(spark, docs).collect() == []


def test_rows_without_an_id_of_their_own_draw_apart(spark):
    """A source without ids, and one of a single id, come near their targets; equal rows too."""
    data = [(None, f"text {i % 400} " + "w " * 8, "a") for i in range(3000)] + [(7, "w " * 10, "b") for _ in range(3000)]
    data += [(100 + i, "w " * 10, "c") for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string").repartition(6)
    got = mixing.repetitions(spark, docs).collect()
    mixed = mixing.repeated(spark, docs).groupBy("source").count().collect()
    counted = {r.source: r["count"] for r in mixed}
    for source in "abc":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= 0.04 * mine[0].target
        assert counted[source] == sum(r.copies for r in mine)
    again = mixing.repetitions(spark, docs.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_sql_of_rows_without_an_id_of_their_own(spark):
    import duckdb
    import pandas as pd

    data = [(None, "a b c", "x"), (None, "a b c", "x"), (None, None, None), (4, "one", "x"), (4, "two words", "y"), (5, "some more words here", "z")] * 7
    data += [(i, "w " * (i % 9), "xyz"[i % 3]) for i in range(50, 300)]
    documents = pd.DataFrame(data, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    want = duckdb.connect().register("documents", documents).execute(mixing.ORACLE_SQL).fetchall()
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string")
    got = [(r.doc_id, r.size, r.source_size, r.target, r.copies * r.size) for r in mixing.repetitions(spark, docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
