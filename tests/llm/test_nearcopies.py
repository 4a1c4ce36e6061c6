from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from ticketmill.llm import nearcopies
from ticketmill.llm.components import components

COLUMNS = "doc_id bigint, text string, class_id string, words_md5 int, bands int"


def shingles(text) -> Counter:
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a: Counter, b: Counter) -> float:
    every = sum((a | b).values())
    return sum((a & b).values()) / every if every else 1.0


def plain_classes(texts: list) -> list[int]:
    sets = [shingles(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and similarity(sets[i], sets[j]) >= 0.8:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def near_texts(seed: int, families: int, copies: int) -> list[str]:
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("aeioubdgklmnprst") for _ in range(draw.randint(2, 7)))
    out = []
    for _ in range(families):
        base = [word() for _ in range(draw.randint(20, 300))]
        if draw.random() < 0.3:
            base = base[:30] * 4 + base[30:]
        for _ in range(draw.randint(1, copies)):
            edited = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 30))):
                edited[draw.randrange(len(edited))] = word()
            out.append((" " if draw.random() < 0.8 else "\n").join(edited))
    return out


def test_signatures_estimate_weighted_similarity():
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join(base[:350]), " ".join(base[:200] * 2), " ".join(base[:4]), "one", ""]
    cells, owner = nearcopies._cells(texts)
    k = 2048
    got = nearcopies.signatures(cells, owner, len(texts), k)
    sets = [shingles(t) for t in texts]
    for i in range(5):
        for j in range(5):
            agree = (got[i] == got[j]).mean()
            assert abs(agree - similarity(sets[i], sets[j])) < 0.05, (i, j)


def test_classes_beside_trying_all_pairs(spark):
    odd = ["", None, " \n", "a b c", "a  b\tc", "a b d", "one", "x " * 50, "x " * 51, "x " * 30]
    texts = [*near_texts(1, 60, 6), *odd, *near_texts(2, 1, 1) * 40]
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    want = plain_classes(texts)
    got = {r.doc_id: r.class_id for r in nearcopies.classes(spark, docs).collect()}
    assert len(got) == len(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    # Nothing is joined that a chain of near copies doesn't join; hardly anything is missed.
    assert all(want[i] == want[c] for i, c in got.items())
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.98 * len(pairs)
    sure = [p for p in pairs if similarity(shingles(texts[p[0]]), shingles(texts[p[1]])) >= 0.9]
    assert all(got[i] == got[j] for i, j in sure)
    kept = nearcopies.deduplicated(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a b c d e f", "", 0, 0)] * 3 + [(5, "other words here", "", 0, 0), (None, "a b c d e f", "", 0, 0)]
    rows += [(None, "no id at all", "", 0, 0)] * 2
    docs = spark.createDataFrame(rows, COLUMNS)
    got = sorted((str(r.doc_id), str(r.class_id), r.n_texts) for r in nearcopies.classes(spark, docs).collect())
    assert got == [("5", "5", 1)] * 4 + [("None", "5", 1)] + [("None", "None", 1)] * 2
    kept = sorted((str(r.doc_id), r.text) for r in nearcopies.deduplicated(spark, docs).collect())
    assert kept == [("5", "a b c d e f"), ("5", "other words here"), ("None", "no id at all")]


def test_one_large_group_costs_few_comparisons(spark):
    draw = random.Random(4)
    base = [f"w{draw.randrange(10**6)}" for _ in range(200)]
    texts = []
    for i in range(600):
        edited = list(base)
        edited[draw.randrange(200)] = f"new{i}"
        texts.append((i, " ".join(edited)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.class_id for r in nearcopies.classes(spark, docs).collect()} == {0}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert nearcopies.classes(spark, docs).collect() == []
    assert nearcopies.deduplicated(spark, docs).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    draw = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 200, size=(150, 2))] + [(i, i + 1) for i in range(300, 340)]
    links += [(500, i) for i in range(501, 560)] + [(700, 700)]
    group = {x: x for link in links for x in link if link[0] != link[1]}
    for _ in range(60):
        for a, b in links:
            if a != b:
                group[a] = group[b] = min(group[a], group[b])
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert {r.node: r.component for r in components(spark, df).collect()} == group


@pytest.mark.parametrize("rate", [0.08, 0.1])
def test_no_link_of_a_bucket_is_lost(spark, rate):
    draw = random.Random(1)
    words, texts = [f"w{i}" for i in range(400)], []
    for i in range(250):
        # One run of words is replaced: neighbours stay above the limit, their neighbours don't.
        at, n = draw.randrange(360), int(400 * rate)
        words = [*words[:at], *(f"n{i}x{j}" for j in range(min(n, 400 - at))), *words[at + n :]]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.class_id for r in nearcopies.classes(spark, docs).collect()}
    cells, owner = nearcopies._cells(texts)
    earliest = nearcopies.signatures(cells, owner, len(texts), 144).reshape(len(texts), 24, 6)
    sets = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if (earliest[i] == earliest[j]).all(axis=1).any() and similarity(sets[i], sets[j]) >= 0.8:
                assert got[i] == got[j], (i, j)
