from __future__ import annotations

import random

import numpy as np
import pytest
from ticketmill.llm import linking, setjoin


def shingles(text, length=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1)))


def brute(rows, length=5):
    """Id, set size and smallest id of the component, by comparing all pairs of different sets."""
    sets = sorted({shingles(t, length) for _, t in rows if shingles(t, length)}, key=len)
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(sets):
        for b in sets[i + 1 :]:
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    least = {}
    for doc_id, text in rows:
        if (s := shingles(text, length)) and doc_id is not None:
            least[find(s)] = min(least.get(find(s), doc_id), doc_id)
    return sorted(((i, len(s), least.get(find(s)) if s else i) for i, t in rows for s in [shingles(t, length)]), key=repr)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = draw.choice("uvwxyz") * draw.randint(3, 6)
    return words


def corpus(seed, n_groups=25):
    """Groups of near copies on either side of the limit, texts that share a passage, copies, short and empty texts."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 5)))
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n\t", "a", "A", "a b", "a b c d e", "a B c d\ne", "x y z " * 30]
    for _ in range(n_groups):
        base = [word() for _ in range(draw.choice([6, 9, 25, 40, 130, 300]))]
        for _ in range(draw.randint(1, 14)):
            texts.append(" ".join(edited(draw, base, draw.randint(0, max(1, len(base) // 35)))))
        if draw.random() < 0.5:
            chain = base
            for _ in range(8):
                chain = edited(draw, chain, max(1, len(base) // 60))
                texts.append(" ".join(chain))
    for _ in range(30):
        own = [word() for _ in range(draw.randint(1, 60))]
        texts.append(" ".join(own + passage if draw.random() < 0.5 else passage + own).upper())
    texts += [texts[20]] * 12
    draw.shuffle(texts)
    return [*enumerate(texts), (3, texts[30]), (3, texts[30]), (None, texts[31]), (None, None), (None, "only here without an id today")]


@pytest.mark.parametrize(("seed", "often", "block_chars"), [(1, 16, 10**7), (2, 2, 4000), (3, 4, 900)])
def test_components_as_by_all_pairs(spark, seed, often, block_chars):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "a", "b", 0) for i, t in rows], "doc_id bigint, text string, node string, bucket string, n int")
    got = setjoin.components(spark, docs.repartition(3), often=often, block_chars=block_chars, shards=16)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_empty_table_and_no_links(spark):
    docs = spark.createDataFrame([(1, "one"), (2, None), (3, "one two three four five six")], "doc_id bigint, text string")
    assert setjoin.components(spark, docs.where("false")).collect() == []
    assert sorted(map(tuple, setjoin.components(spark, docs).collect())) == [(1, 1, 1), (2, 0, 2), (3, 2, 3)]


@pytest.mark.parametrize("limit", [0, 3])
def test_similar_sets_share_a_signature(limit):
    """At every size, with all shingles frequent or some rare."""
    draw = random.Random(4)
    for _ in range(1500):
        n = draw.choice([1, 2, 4, 5, 9, 10, 26, 31, 32, 33, 40, 64, 100, 255, 400])
        common = draw.randint(int(0.8 * n), n)
        most = int(common / 0.8) - n
        keys = draw.sample(range(1, 1 << 56), n + max(most, 0))
        x, y = keys[:n], keys[n - common :]
        if common < 0.8 * len(set(x) | set(y)):
            continue
        often = {k: draw.randint(2, 6) for k in keys}
        # Some of what only one of them has, no other set has either.
        alone = {k for k in set(x) ^ set(y) if draw.random() < 0.5}

        def signs(s, often=often, alone=alone):
            known = sorted((often[k], k) for k in s if k not in alone)
            found = setjoin.signatures(len(s), np.array([k for _, k in known], np.uint64), np.array([o for o, _ in known], np.int64), limit=limit)
            return dict(zip(*(a.tolist() for a in found), strict=True))

        one, two = signs(x), signs(y)
        # At one of them, the bounds of both are at least what the sets share.
        assert any(min(one[s], two[s]) >= len(set(x) & set(y)) for s in one.keys() & two.keys()), (n, common)


def test_a_large_group_takes_few_comparisons(spark, monkeypatch):
    draw = random.Random(9)
    base = [f"w{draw.randrange(5000)}" for _ in range(120)]
    rows = [(i, " ".join(edited(draw, base, 1 + i % 2))) for i in range(500)]
    compared, real = [], linking.similar_pairs

    def counting(spark, pairs, cells, similar):
        compared.append(pairs.count())
        return real(spark, pairs, cells, similar)

    monkeypatch.setattr(linking, "similar_pairs", counting)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = setjoin.components(spark, docs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert sum(compared) < 20 * len(rows)
