"""The pipeline's stages on a small table, each held against brute force on what it was given."""

from __future__ import annotations

import hashlib
import random

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from test_mixing import plain_targets
from test_nearcopies import plain_classes
from test_quality import plain_features
from test_secrets import plain
from ticketmill.llm.common import load_ranks

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    draw = random.Random(11)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "st"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 4)))
    texts = [" ".join(word() for _ in range(draw.randint(30, 160))) for _ in range(250)]
    texts += [t.replace(" on ", " xx ", 1) for t in texts[:20]] + texts[20:40]
    texts += [t + ' password = "abcdef123"' for t in texts[50:60]]
    texts += ["too short", None, "one two three four five " * 30]
    rows = [(i, t, "en" if i % 9 else None, f"s{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_beside_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    given = {r.doc_id: r for r in docs.collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality", "near_copies", "secrets", "mix", "bpe"]

    docs = stage["quality"](spark, docs, sf_dir).checkpoint()
    assert docs.columns == columns
    kept = {r.doc_id for r in docs.collect()}
    features = {i: plain_features(r.text or "") for i, r in given.items()}
    assert kept == {i for i, f in features.items() if f[0] >= 10 and 100 * f[4] <= 20 * f[0]}

    docs = stage["near_copies"](spark, docs, sf_dir).checkpoint()
    order = sorted(kept)
    groups = plain_classes([given[i].text for i in order])
    assert docs.columns == columns
    assert sorted(r.doc_id for r in docs.collect()) == sorted({order[g] for g in groups})

    docs = stage["secrets"](spark, docs, sf_dir).checkpoint()
    assert docs.columns == columns
    masked = docs.collect()
    for r in masked:
        text = given[r.doc_id].text
        for start, _, end in reversed(plain(text)):
            text = text[:start] + "[SECRET]" + text[end:]
        assert (r.text, r.n_chars) == (text, len(text))

    docs = stage["mix"](spark, docs, sf_dir).checkpoint()
    assert docs.columns == columns
    sizes: dict = {}
    for r in masked:
        sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
    targets = plain_targets(sizes)
    copies: dict = {}
    for r in docs.collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for r in masked:
        rate = targets[r.source] / sizes[r.source]
        assert copies.get(r.doc_id, 0) in (int(rate), int(rate) + (rate > int(rate)))

    ranks = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = stage["bpe"](spark, docs, sf_dir).collect()
    texts = {r.doc_id: r.text for r in masked}
    assert len(got) == sum(copies.values())
    for r in got:
        ids = " ".join(map(str, library.encode_ordinary(texts[r.doc_id])))
        assert r.ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_applies_all_stages(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_quality_stage_rejects_by_perplexity_alone(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice(["th", "er", "on", "an", "re", "he"]) for _ in range(draw.randint(3, 4)))
    known = [word() for _ in range(600)]
    fresh = [w for w in (word() for _ in range(2000)) if w not in known]
    texts = [" ".join(draw.choice(known) for _ in range(draw.randint(40, 200))) for _ in range(150)]
    texts.append(" ".join(draw.sample(fresh, 80)))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    features = plain_features(texts[150])
    assert features[0] >= 10 and 100 * features[4] <= 20 * features[0]
    kept = dict(corpus_pipeline.STAGES)["quality"](spark, spark.createDataFrame(rows, COLUMNS), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(150))
