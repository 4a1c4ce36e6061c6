from __future__ import annotations

import random

import public_tokenizers
import sentencepiece
from ticketmill.llm import counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  ", " a", "a ", "a  b c", "<s> </s> <unk>", "▁a b▁ ▁c", "a\x00b \x00", "ﬁ①Ａ 漢字", "x" * 9000,
       "a\nb \n c", "word " * 3000, "　   z", "😀" * 50 + " é"]


def test_counts_as_the_library(spark):
    draw = random.Random(5)
    odd = [*ODD, *("".join(draw.choice("ab é▁ \n<>漢.1") for _ in range(draw.randint(0, 120))) for _ in range(400))]
    rows = [*enumerate(odd), (None, "no id"), (3, "twice"), (3, "twice")]
    docs = spark.createDataFrame([(i, t, -1) for i, t in rows], "doc_id bigint, text string, n_tokens int")
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert counts.splits_at_spaces(model)
    want = sorted((str(i), len((t or "").encode()), n := len(model.encode(t or "")), n > 100) for i, t in rows)
    for batch_bytes in (50, counts.BATCH_BYTES):
        got = counts.token_counts(spark, docs.repartition(2), MODEL, limit=100, batch_bytes=batch_bytes).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert counts.token_counts(spark, docs, MODEL).collect() == []
