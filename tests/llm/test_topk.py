from __future__ import annotations

import math

import numpy as np
import pytest
from ticketmill.llm import topk


def plain(rows, k, every):
    """The best k of all rows for each query, by trying them all."""
    whole = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (q, query) in enumerate(whole):
        if q is None or q % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(query, v, strict=False)), i is None, i or 0)
            for other, (i, v) in enumerate(whole)
            if other != at
        ]
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'x' AS block", "1 AS rank")
    got = topk.top_k(spark, df.repartition(3), **options).collect()
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in got), key=str)


@pytest.mark.parametrize("block_rows", [7, 100, 8192])
def test_as_by_trying_all(spark, block_rows):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(5, 8)) * 0.3
    rows = [(i, [float(np.float32(x)) for x in centres[i % 5] + draw.normal(size=8) * 0.05]) for i in range(300)]
    same = rows[7][1]
    rows += [(None, same), (7, same), (400, same), (400, same), (401, None), (500, [None] * 8), (501, [math.inf] * 8)]
    rows += [(600, [math.nan] * 8), (700, [0.5, -0.5]), (701, []), (800, []), (900, [0.0] * 8), (-100, [1.0] * 8)]
    assert found(spark, rows, block_rows=block_rows, every=50) == plain(rows, 10, 50)


def test_few_rows_and_none(spark):
    rows = [(0, [0.1, 0.2]), (1, [0.3, 0.1]), (2, [-1.0, 0.0])]
    assert found(spark, rows) == plain(rows, 10, 100)
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []


def test_stops_early_on_proof():
    draw = np.random.default_rng(2)
    vectors = draw.integers(-20, 20, size=(4000, 16))
    vectors[:40] += 300
    index = topk.Index(vectors, 12)
    query = np.full(16, 50)
    places, scores, done = index.top(query, np.arange(4000), 10)
    exact = vectors @ query
    order = np.lexsort((np.arange(4000), -exact))[:10]
    assert places.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
    assert done < 4000 * 16 / 2
