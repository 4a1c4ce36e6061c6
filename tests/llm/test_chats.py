from __future__ import annotations

import random

import pytest
from ticketmill.llm import chats

COLUMNS = "conv_id bigint, turn bigint, role string, text string, n int, part int, at int"


def plain(rows, part):
    convs: dict = {}
    key = lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or "")
    for row in sorted(rows, key=key):
        convs.setdefault(row[0], []).append((row[2], row[3]))
    out = []
    for conv, turns in convs.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values())
        twin = any(o == turns and c is not None and (conv is None or c < conv) for c, o in convs.items())
        if longer or twin:
            continue
        for p in range(0, len(turns), part):
            text = "".join(f"<|{r or ''}|>\n{t or ''}\n" for r, t in turns[p : p + part])
            out.append((conv, len(turns), p // part, text))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk, part", [(3, 4), (4096, 256)])
def test_beside_trying_all(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(chats, "CHUNK", chunk)
    draw = random.Random(chunk)
    rows, conv = [], 0
    for _ in range(40):
        turns = [(["user", "assistant"][i % 2], draw.choice(["hi", "yes", "no", "long text", "", None])) for i in range(draw.randint(1, 30))]
        for _ in range(draw.randint(1, 4)):
            cut = turns[: draw.randint(1, len(turns))]
            rows += [(conv, t, *turn) for t, turn in enumerate(cut, draw.choice([0, 1, 5]))]
            conv += 1
    rows += [(900, 1, None, None), (901, 1, "", ""), (902, None, "user", "x"), (902, 1, "user", "y"), (None, 0, "user", "no id"), (None, 1, "user", "b")]
    rows += [(903, 1, "a", "same"), (903, 1, "a", "same"), (904, 1, "a", "same")]
    rows += [(905, t, "user", "hot") for t in range(500)] + [(906, t, "user", "hot") for t in range(499)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], COLUMNS).repartition(5)
    got = [(r.conv_id, r.n_turns, r.part, r.text) for r in chats.rendered(spark, df, part=part).collect()]
    assert sorted(got, key=str) == plain(rows, part)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chats.rendered(spark, df).collect() == []


def test_tied_turns_are_in_the_order_of_their_text(spark):
    rows = [(1, 1, "user", t) for t in "cfabed"] + [(1, 1, "user", None), (1, 1, None, "z"), (1, 0, "x", "first"), (1, None, "a", "last")]
    docs = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    (row,) = chats.rendered(spark, docs).collect()
    lines = row.text.split("\n")[1::2]
    assert lines == ["first", "a", "b", "c", "d", "e", "f", "", "z", "last"]
