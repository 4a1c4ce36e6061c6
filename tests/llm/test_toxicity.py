from __future__ import annotations

import random

import numpy as np
from ticketmill.llm import toxicity

DOCS = "doc_id bigint, text string, toxic string, p int, words int"
LABELS = "doc_id bigint, quality int, toxic int, text string"


def sample(n: int, first: int = 0):
    draw = random.Random(n + first)
    prose = [f"{a}{b}" for a in ("th", "re", "on", "st", "in", "er") for b in ("an", "ou", "ing", "es", "ti")]
    bad = ["vilest", "vilely", "grotest", "grotly"]
    docs, labels = [], []
    for i in range(first, first + n):
        toxic, poor = draw.random() < 0.2, draw.random() < 0.3
        words = [draw.choice(prose) for _ in range(draw.randint(20, 300))]
        for _ in range(3 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad).title() + ",")
        words += ["cheap", "offer"] * poor
        docs.append((i, " ".join(words), "x", 1, 2))
        labels.append((i, 0 if poor else 1, int(toxic), "y"))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = sample(900)
    odd = [(5000, None, "", 0, 0), (5001, "", "", 0, 0), (None, "no id vilest vilest", "", 0, 0), (3, docs[3][1], "", 0, 0)]
    marks = [*labels[:600], (2000, None, 1, ""), (None, 1, 1, ""), (4, labels[4][1], None, ""), (5001, 1, None, "")]
    table = spark.createDataFrame(docs + odd, DOCS).repartition(4)
    models = toxicity.fit_chain(spark, table, spark.createDataFrame(marks, LABELS))
    rows = toxicity.scored(spark, table, models).collect()
    assert len(rows) == len(docs) + len(odd) and rows[0].asDict().keys() == {"doc_id", "p_low_quality", "p_toxic", "toxic"}
    got = {r.doc_id: r for r in rows}
    truth = {i: (q, t) for i, q, t, _ in labels[600:]}
    assert sum(got[i].toxic == bool(t) for i, (_, t) in truth.items()) >= 0.97 * len(truth)
    assert sum((got[i].p_low_quality > 0.5) == (q == 0) for i, (q, _) in truth.items()) >= 0.95 * len(truth)
    assert got[None].toxic and not got[5000].toxic and got[5000].p_toxic == got[5001].p_toxic
    again = toxicity.scored(spark, table.repartition(2), models).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_earlier_probabilities_are_out_of_fold():
    draw = np.random.default_rng(1)
    rows = [np.sort(draw.choice(10_000, 40, replace=False)) for _ in range(300)]
    labels = draw.integers(0, 2, 300).astype(float)
    import pyarrow as pa

    fold = np.arange(300) % 3
    table = pa.table(
        {"job": [0] * 300, "doc_id": np.arange(300), "fold": fold, "words": [r.tolist() for r in rows], "earlier": [[]] * 300, "label": labels}
    )
    table = table.set_column(3, "words", table["words"].cast(pa.list_(pa.int64())))
    out = toxicity._fit(0)(table)
    assert out["doc_id"].to_pylist() == [i for i in range(300) if i % 3 == 0]
    other = table.set_column(5, "label", pa.array(np.where(fold == 0, 1 - labels, labels)))
    # A fold's own labels do not touch its probabilities.
    assert toxicity._fit(0)(other)["p"].to_pylist() == out["p"].to_pylist()


def test_threshold():
    p = np.array([0.9, 0.8, 0.3, 0.2, 0.1])
    assert 0.2 < toxicity.best_threshold(p, np.array([1, 1, 1, 0, 0])) < 0.3
    assert toxicity.best_threshold(p, np.zeros(5)) == 0.5
    assert toxicity.best_threshold(np.array([0.7]), np.array([1.0])) < 0.7


def test_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "", 0, 0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    rows = toxicity.scored(spark, docs, toxicity.fit_chain(spark, docs, none)).collect()
    assert [(r.p_low_quality, r.p_toxic, r.toxic) for r in rows] == [(0.5, 0.5, False)]
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.scored(spark, empty, toxicity.fit_chain(spark, empty, none)).collect() == []
