from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from ticketmill.llm import quality

COLUMNS = "doc_id bigint, text string, lang string, kept int, key int, n_words int"


def plain_features(text: str) -> list[int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def texts(n: int) -> list[str]:
    draw = random.Random(7)
    words = ["a", "bb", "cé", "d#", "e%%", "漢字", "\x1c", "x\x85y", "A B"]
    seps = [" ", "  ", "\n", "\t", "\r\n", "\x0b"]
    out = ["".join(draw.choice(words[: draw.randint(1, 9)]) + draw.choice(seps) for _ in range(draw.randint(0, 60))) for _ in range(n)]
    return [*out, "", " \n ", "one two three four five " * 4, "\n".join(["same line"] * 5)]


def test_base_counts_as_defined():
    every = texts(400)
    got = quality.base_features(every)
    assert [[int(got[f][i]) for f in quality.FEATURES] for i in range(len(every))] == [plain_features(t) for t in every]


def plain_model(counts: Counter):
    """Interpolated modified Kneser-Ney over tuples, by its definition."""
    levels = {4: counts}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def off(n):
        c = Counter(levels[n].values())
        if not all(c[i] for i in (1, 2, 3, 4)):
            return [0, 0.5, 0.75, 1.0]
        y = c[1] / (c[1] + 2 * c[2])
        return [0, *(min(max(i - (i + 1) * y * c[i + 1] / c[i], 0.05), i - 0.05) for i in (1, 2, 3))]

    offs = {n: off(n) for n in levels}

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / 64
        seen = {g: c for g, c in levels[n].items() if g[:-1] == gram[:-1]}
        if not seen:
            return p(gram[1:])
        total = sum(seen.values())
        weight = sum(offs[n][min(c, 3)] for c in seen.values()) / total
        c = seen.get(gram, 0)
        return max(c - offs[n][min(c, 3)], 0) / total + max(weight, 1e-9) * p(gram[1:])

    return p


def test_model_is_modified_kneser_ney():
    sample = "the cat sat on the mat, and the dog sat on the log. " * 3 + "zebra quick brown fox 12 jumps over lazy hens"
    keys, _ = quality._joined_keys([sample, "other text"])
    split = lambda k: tuple(int(k) >> 6 * (3 - i) & 63 for i in range(4))
    grams, counts = np.unique(keys, return_counts=True)
    model = quality.Model.load(quality.Model(grams, counts).dump())
    p = plain_model(Counter(map(split, keys.tolist())))
    ask = np.concatenate([grams, np.random.default_rng(1).integers(0, 2**24, 300).astype(np.uint32)])
    for key, got in zip(ask.tolist(), model.score(ask).tolist(), strict=True):
        assert got == pytest.approx(math.log(p(split(key))), abs=1e-3)
    # The probabilities of all characters behind a context are 1 in sum.
    for context in (int(grams[0]) >> 6, int(grams[-1]) >> 6, 12345):
        every = np.array([context << 6 | c for c in range(64)], np.uint32)
        assert np.exp(model.score(every).astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_batches_do_not_change_keys():
    every = ["abc", "", "d", "Größe 12\n"]
    keys, sizes = quality._joined_keys(every)
    assert sizes.tolist() == [len(t) for t in every]
    alone = [quality._joined_keys([t])[0] for t in every if t]
    assert np.concatenate(alone).tolist() == keys.tolist()


def test_verdicts(spark):
    draw = random.Random(3)
    syllables = {"en": ["th", "er", "on", "an", "re", "he"], "de": ["sch", "ung", "ein", "lich", "ü", "z"], None: ["q", "x"]}
    rows = []
    for i in range(400):
        lang = draw.choice(["en", "en", "de", None])
        words = ["".join(draw.choice(syllables[lang]) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(40, 200))]
        rows.append((i, " ".join(words), lang))
    noise = " ".join("".join(draw.choice("0123456789ZQXJKVW{}=+") for _ in range(9)) for _ in range(150))
    rows += [(900, noise, "en"), (901, "the on " * 40, "de"), (902, None, "en"), (903, "", None), (904, "few words", "en"), (None, rows[0][1], rows[0][2])]
    rows += [rows[1], rows[1]]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], COLUMNS).repartition(4)
    got = quality.verdicts(spark, docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
    for doc_id, text, _ in rows:
        want = plain_features(text or "")
        assert [by[doc_id][f] for f in quality.FEATURES] == want
        assert by[doc_id].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert not by[900].base_failed and not by[900].kept
    assert by[902].base_failed and by[903].log_perplexity is None and not by[904].kept
    clean = [r for r in got if r.doc_id is not None and r.doc_id < 400 and not r.base_failed]
    assert len(clean) > 100 and all(r.kept for r in clean)
    left = quality.kept(spark, docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in got if r.kept)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert quality.verdicts(spark, docs).collect() == [] and quality.kept(spark, docs).collect() == []


def test_word_model_grows_and_rejects_words_of_no_other_text(spark):
    draw = random.Random(9)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(draw.randint(3, 4)))
    known = [word() for _ in range(600)]
    fresh = [w for w in (word() for _ in range(4000)) if w not in known]
    rows = [(i, " ".join(draw.choice(known) for _ in range(draw.randint(40, 200))), "en") for i in range(200)]
    # The same syllables, so the same characters, in words that no other text has.
    rows += [(900 + i, " ".join(draw.sample(fresh, 100)), "en") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    got = {r.doc_id: r for r in quality.verdicts(spark, docs).collect()}
    assert all(got[i].kept for i in range(200))
    for i in range(900, 904):
        assert not got[i].base_failed and not got[i].kept
        assert got[i].low <= got[i].log_perplexity <= got[i].high and got[i].word_log_perplexity > got[i].word_high
    # The word model by its definition.
    words = [t.split() for _, t, _ in rows]
    c = Counter(w for ws in words for w in ws)
    n = Counter(c.values())
    y = n[1] / (n[1] + 2 * n[2])
    off = [0, *(min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i - 0.05) for i in (1, 2, 3))] if all(n[i] for i in (1, 2, 3, 4)) else [0, 0.5, 0.75, 1.0]
    total = sum(c.values())
    weight = sum(off[min(k, 3)] for k in c.values()) / total
    keys, counts = np.unique(quality._joined_keys([t for _, t, _ in rows])[0], return_counts=True)
    model = quality.Model(keys, counts)
    by_chars = lambda w: model.score(quality._joined_keys([w + " "])[0]).astype(float).sum()
    for i in (0, 77, 201):
        own = Counter(words[i])
        logs = [k * math.log(max(c[w] - k - off[min(c[w] - k, 3)], 0) / total + weight * math.exp(by_chars(w))) for w, k in own.items()]
        assert got[rows[i][0]].word_log_perplexity == pytest.approx(-sum(logs) / len(words[i]), rel=1e-5)


def test_words_of_a_language_have_probabilities_of_one_in_sum():
    """What the discounts take off is what the characters get."""
    totals = np.array([1] * 40 + [2] * 15 + [3] * 9 + [4] * 5 + [30, 80])
    classes = {"words": int(totals.sum()), "different": len(totals), **{f"n{i}": int((totals == i).sum()) for i in range(1, 5)}}
    none = np.full(len(totals), -np.inf)
    logs = quality.word_log_probabilities(totals, np.zeros(len(totals), int), none, classes)
    new = quality.word_log_probabilities(np.array([0]), np.array([0]), np.array([0.0]), classes)
    assert np.exp(logs).sum() + np.exp(new).sum() == pytest.approx(1)


@pytest.mark.parametrize("block_chars", [300, 4000])
def test_blocks_and_shards_do_not_change_scores(spark, block_chars):
    every = [t for t in texts(120) if t.strip()]
    rows = [(i, t, ["en", None, "fr", "de"][i % 4]) for i, t in enumerate(every)] + [(None, "", "xx"), (900, "### $$$ 12 a", "yy")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    plain = {str(r.doc_id): r for r in quality.scored(spark, docs.coalesce(1)).collect()}
    cut = {str(r.doc_id): r for r in quality.scored(spark, docs.repartition(4), shards=3, block_chars=block_chars).collect()}
    assert plain.keys() == cut.keys()
    for i, r in plain.items():
        assert [cut[i][f] for f in (*quality.FEATURES, "n_letter_words", "key")] == [r[f] for f in (*quality.FEATURES, "n_letter_words", "key")]
        for f in ("log_perplexity", "word_log_perplexity"):
            assert (cut[i][f] is None) == (r[f] is None) and (r[f] is None or cut[i][f] == pytest.approx(r[f], rel=1e-5))


def plain_bands(rows):
    """Each language's bands from all rows that pass the base rules, and the verdicts that follow."""

    def rank(values, q):
        values = sorted(values)
        return values[max(math.ceil(q * len(values)) - 1, 0)]

    kept = {}
    for lang in {r["lang"] for r in rows}:
        mine = [r for r in rows if r["lang"] == lang]
        good = [r for r in mine if not r["failed"]]
        if not good:
            continue
        for name, n, reach, margin in (("log_perplexity", "n_grams", 8.0, 0.12), ("word_log_perplexity", "n_letter_words", 4.0, 0.4)):
            values = [r[name] for r in good if r[name] is not None]
            middle = rank(values, 0.5)
            off = [(r[name] - middle) * math.sqrt(max(r[n] or 0, 1)) for r in good if r[name] is not None]
            spread = (rank(off, 0.75) - rank(off, 0.25)) / 1.349
            tail = 2 * (middle - rank(values, 0.05)) if n == "n_letter_words" else 0
            for r in mine:
                wide = max(margin, reach * spread / math.sqrt(max(r[n] or 0, 1)))
                r[f"{name}_in"] = r[name] is not None and middle - max(wide, tail) <= r[name] <= middle + wide
        kept |= {r["doc_id"]: not r["failed"] and r["log_perplexity_in"] and r["word_log_perplexity_in"] for r in mine}
    return kept


def test_bands_and_verdicts_as_by_their_definition(spark):
    draw = random.Random(12)
    rows = []
    for i in range(300):
        words = [draw.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta"]) + draw.choice(["", "s", "er"]) for _ in range(draw.randint(12, 90))]
        if i % 10 == 0:
            words = ["".join(draw.choice("qxzjkvw") for _ in range(6)) for _ in words]
        rows.append((i, " ".join(words), ["en", "fr"][i % 2]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    scores = [r.asDict() for r in quality.scored(spark, docs).collect()]
    for r in scores:
        r["failed"] = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
    want = plain_bands(scores)
    got = {r.doc_id: r.kept for r in quality.verdicts(spark, docs).collect()}
    assert got == want and 0 < sum(not k for k in got.values()) < 100


def test_a_blocks_texts_move_in_few_bytes():
    """A text's words, frequent ones first, in about 1.1 bytes each where the order of keys takes 1.6."""
    draw = random.Random(3)
    words = [" ".join([f"w{draw.randint(0, 20)}" for _ in range(40)] + [f"r{draw.randint(0, 30_000)}" for _ in range(10)]) for _ in range(3000)]
    lang = ["en"] * len(words)
    keys, counts = np.unique(quality._joined_keys(words)[0], return_counts=True)
    models = {"en": quality.Model(keys.astype(np.int32), counts)}
    block = quality._Block(0)
    arrays = [pa.array(range(len(words)), pa.int64()), pa.array(["k"] * len(words)), pa.array(lang), pa.array(words)]
    block.add(pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "lang", "text"]), models)
    data = next(row[4] for row in block.moved(4, models) if row[2] == quality.TEXTS)
    fields = quality.packing.unframed(data, 8)
    assert [len(part) for part in fields][2] + len(fields[3]) + len(fields[6]) < 1.3 * sum(map(len, block.places))
    assert len(fields[5]) < 0.9 * 4 * len(block.known["en"])
