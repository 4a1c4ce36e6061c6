from __future__ import annotations

import random
from hashlib import sha256

import numpy as np
import pytest
from ticketmill.llm import runs


def brute(words, least=runs.LEAST, times=runs.TIMES):
    """All runs, by trying every period and stretching every repetition as far as it goes."""
    found, n = {}, len(words)
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if j > i and length >= max(least, times * p):
                found.setdefault((i, length), p)
            i = max(j, i) + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def ours(texts, **limits):
    flat, sizes = runs.numbered(texts)
    start, length, period = runs.find_runs(flat, sizes, **limits)
    out = [[] for _ in texts]
    ends = np.cumsum(sizes)
    for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True):
        i = int(np.searchsorted(ends, s, side="right"))
        out[i].append((s - int(ends[i] - sizes[i]), n, p))
    return out


def odd_texts():
    draw = random.Random(3)
    texts = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a"] * 200, ["a", "b"] * 50, list("aab" * 40 + "aac" * 9), list("abcabdabc" * 12)]
    for _ in range(400):
        n, letters = draw.randint(0, 60), "ab" if draw.random() < 0.6 else "abc"
        texts.append([draw.choice(letters) for _ in range(n)])
    for _ in range(60):
        text = []
        while len(text) < 150:
            text += [draw.choice("abcd") for _ in range(draw.randint(1, 6))] * draw.choice([1, 1, 4, 5, 9])
        texts.append(text)
    return texts


@pytest.mark.parametrize("limits", [{}, {"least": 2, "times": 3}, {"least": 20, "times": 5}])
def test_runs_as_by_brute_force(limits):
    texts = odd_texts()
    assert ours(texts, **limits) == [brute(t, **limits) for t in texts]


def test_long_repetitions_take_few_pairs():
    flat, sizes = runs.numbered([["a"] * 40_000, ["a", "b", "c"] * 20_000])
    start, length, period = runs.find_runs(flat, sizes)
    assert list(zip(start.tolist(), length.tolist(), period.tolist(), strict=True)) == [(0, 40_000, 1), (40_000, 60_000, 3)]


def digest(doc_id, text):
    words = runs.planted(doc_id, runs._WORDS.findall(text or ""))
    found = brute(words)
    drop = {i for s, n, p in found for i in range(s + p, s + n)}
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(found, key=lambda r: (r[0], r[2])))
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    left = " ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha256(lines.encode()).hexdigest(), sha256(left.encode()).hexdigest())


def test_query_as_by_brute_force(spark):
    draw = random.Random(8)
    texts = [None, "", " \n", "x", "one word", *(" ".join(draw.choice("abcdefgh") for _ in range(draw.randint(0, 90))) for _ in range(150))]
    rows = [*enumerate(texts), (3, "a a a a a a"), (3, "a a a a a a"), (None, "a b " * 9), (None, None)]
    docs = spark.createDataFrame([(i, t, "run") for i, t in rows], "doc_id bigint, text string, length string")
    got = runs.digests(spark, docs.repartition(3), rewrite=runs.planted)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(digest(*row)) for row in rows)


def test_planted_words():
    import zlib

    doc_id = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g, words = zlib.crc32(str(doc_id).encode()) // 10, [str(i) for i in range(50)]
    a = g % 50
    p = 1 + (50 - a) // (3 + g % 8)
    assert runs.planted(doc_id, words) == words[:a] + [words[a + (i - a) % p] for i in range(a, 50)]


def test_collapsed_texts_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "so so so so so so it goes"), (2, "plain text")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in runs.collapsed(spark, docs).collect()}
    assert (got[1].starts, got[1].lengths, got[1].periods, got[1].collapsed) == ([0], [6], [1], "so it goes")
    assert (got[2].starts, got[2].collapsed) == ([], "plain text")
    assert runs.digests(spark, docs.where("false"), rewrite=runs.planted).collect() == []
