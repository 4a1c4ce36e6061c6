from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
from ticketmill.llm import phrases

BREAK, WORD = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[^ \t]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, top, within=50):
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in BREAK.split(lower(text or "")):
            words = WORD.findall(piece)
            total[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    f[lang, tuple(words[i : i + n])] += 1
    out = []
    for lang in total:
        found = {p: a for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            if any(100 * b >= within * a for q, b in found.items() if len(q) > len(p) and p in (q[:2], q[1:])):
                continue
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((score, a, " ".join(p), left, right))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i, p, a, left, right, total[lang], s) for i, (s, a, p, left, right) in enumerate(rows[:top], 1)]
    return sorted(out)


def corpus(seed):
    draw = random.Random(seed)
    rows = [(None, None), ("en", ""), ("en", None), (None, "A b. a b; a B\ta b"), ("x", " . , "), ("fr", "Ça va\x0bça va Ça va"), ("en", "a " * 40)]
    for _ in range(150):
        parts = []
        for _ in range(draw.randint(0, 80)):
            parts.append(draw.choice(["new york", "of the", "in spite of", "a", "b", "a", "x y", "Été", "the"]))
            parts.append(draw.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n"]))
        rows.append((draw.choice(["en", "fr", None, "und"]), "".join(parts)))
    return rows + rows[10:14]


def test_phrases_as_by_brute_force(spark):
    for seed, block_chars, top in ((1, 10**7, 2000), (2, 300, 7)):
        rows = corpus(seed)
        docs = spark.createDataFrame([(lang, text, 1, "k") for lang, text in rows], "lang string, text string, n int, phrase string")
        got = phrases.collocations(spark, docs.repartition(3), top=top, shards=8, block_chars=block_chars)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {kind for name, kind in got.dtypes if name not in ("lang", "phrase")} == {"bigint"}
        assert sorted(map(tuple, got.collect())) == brute(rows, phrases.LEAST, top)
    assert phrases.collocations(spark, docs.where("false")).collect() == []


def test_fingerprints_are_those_of_the_words():
    draw = np.random.default_rng(5)
    hashes = draw.integers(0, 2**63, 40, dtype=np.uint64)
    hashes[20:30] = hashes[3:13]
    one, two, three = (phrases.fingerprints(hashes, n) for n in (1, 2, 3))
    assert (one == hashes).all() and len(three) == 38
    assert (two[20:29] == two[3:12]).all() and (three[20:28] == three[3:11]).all()
    assert len(np.unique(two)) == 39 - 9
    assert [len(phrases.fingerprints(hashes[:1], n)) for n in (1, 2, 3)] == [1, 0, 0]


def test_colliding_fingerprints_are_told_apart_by_the_words(spark, monkeypatch):
    grams = np.array([[1, 2], [3, 4], [1, 2], [5, 6], [3, 4], [9, 9]])
    prints, found, counts = phrases._phrases(np.array([7, 7, 7, 8, 7, 8]), grams)
    got = sorted((p, *g, n) for p, g, n in zip(prints.tolist(), found.tolist(), counts.tolist(), strict=True))
    assert got == [(7, 1, 2, 2), (7, 3, 4, 2), (8, 5, 6, 1), (8, 9, 9, 1)]
    assert prints.tolist() == sorted(prints.tolist())
    # All fingerprints alike, over several blocks: counts stay those of the texts.
    rows = corpus(6)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)

    def few(hashes, n, real=phrases.fingerprints):
        return real(hashes, n) % np.uint64(3)

    monkeypatch.setattr(phrases, "fingerprints", few)
    counted, total = Counter(), Counter()
    for batch in _local(phrases, docs.toPandas()):
        counted.update(batch)
    for lang, text in rows:
        for piece in BREAK.split(lower(text or "")):
            words = WORD.findall(piece)
            for n in (1, 2, 3):
                total.update(("und" if lang is None else lang, n, " ".join(words[i : i + n])) for i in range(len(words) - n + 1))
    assert counted == Counter({key: n for key, n in total.items() if n >= 10})


def _local(phrases, table):
    """The steps of ``frequencies`` one after the other in this process, where every fingerprint can be made to collide."""
    import pyarrow as pa

    blocks, shards = [], 4
    for number, part in enumerate((table[:70], table[70:])):
        block = phrases._Block(number)
        for lang, text in zip(part["lang"], part["text"], strict=True):
            block.add(None if lang is None else lang, (text or "").encode())
        blocks += phrases._rows(block, shards, 3)
    answered = [a for s in range(shards) for a in phrases._answer(10)([r for r in blocks if r[1] == s])]
    found = []
    for number in (0, 1):
        mine = sorted((r for r in answered if r[0] == number), key=lambda r: (r[2], r[1], r[3]))
        found += phrases._assemble(3, shards)(number, mine)
    rows = sorted((r for b in found for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: r[1])
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["block", "shard", "kind", "seq", "data"])
    for out in phrases._sum(10)([batch]):
        yield {(r["lang"], r["words"], r["phrase"]): r["n"] for r in out.to_pylist() if r["words"]}


def test_scores_of_large_counts_are_exact(spark):
    """The score's expression beyond 64 bits."""
    big = 3_037_000_499
    row = spark.sql(
        f"select (cast(1000000 as decimal(7, 0)) * cast({big} as decimal(19, 0)) * cast({big} as decimal(19, 0)))"
        f" div (cast({big + 1} as decimal(19, 0)) * cast({big + 2} as decimal(19, 0))) as score"
    ).first()
    assert row.score == 1_000_000 * big * big // ((big + 1) * (big + 2))
