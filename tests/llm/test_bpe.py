from __future__ import annotations

import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from ticketmill.llm import bpe
from ticketmill.llm.common import load_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n x", "\t\x0b\x1c\x85  x", "don't we'll I'm",
       "ñandú größer ﬁ 漢字漢字 😀😀", "x" * 5000, "ab" * 3000 + " " + "1" * 300, "\x00\x00", "a　 b", " q", "😀" * 400]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(RANKS), special_tokens={})


def texts(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    signs = "aabcdeé 'st \n\t\r.,;12漢😀 　\x1c\x85"
    return ["".join(draw.choice(signs) for _ in range(draw.randint(0, 200))) for _ in range(n)]


def test_chunks_join_to_the_text_and_keep_all_matches():
    import regex

    for text in [*ODD, *texts(1, 500)]:
        cut = bpe.chunks(text)
        assert "".join(cut) == text
        found = [m for chunk in cut for m in regex.findall(public_tokenizers.PATTERN, chunk)]
        assert found == regex.findall(public_tokenizers.PATTERN, text)


def test_merges_as_the_library(library):
    ranks, draw = load_ranks(RANKS), random.Random(3)
    for n in [1, 2, 3, 10, 63, 64, 65, 66, 200, 1000]:
        for letters in (b"abcdeth ing", b"a", b"ab", bytes(range(256))):
            piece = bytes(draw.choice(letters) for _ in range(n))
            assert bpe.merge(piece, ranks) == library._core_bpe.encode_single_piece(piece)
            if n > 2:
                assert bpe._merge_long(piece, ranks) == library._core_bpe.encode_single_piece(piece)


@pytest.mark.parametrize("block_chars", [300, 16_000_000])
def test_round_trip_beside_the_library(spark, library, block_chars):
    rows = [*enumerate([*ODD, *texts(2, 300)]), (7, "again"), (7, "again"), (None, "no id"), (900, None)]
    docs = spark.createDataFrame([(i, t, "x", b"y") for i, t in rows], "doc_id bigint, text string, ids string, decoded binary")
    coded = bpe.encode(spark, docs.repartition(3), RANKS, public_tokenizers.PATTERN, block_chars=block_chars, shards=16)
    got = bpe.decode(spark, coded, RANKS).collect()
    want = sorted((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in got) == want
    whole = bpe.round_trip(spark, docs, RANKS, public_tokenizers.PATTERN, block_chars=block_chars)
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in whole.collect()) == want
    digest = {r.doc_id: r for r in bpe.digests(bpe.decode(spark, coded, RANKS)).collect()}
    ids = " ".join(map(str, library.encode_ordinary(ODD[11])))
    assert digest[11].ids_sha256 == hashlib.sha256(ids.encode()).hexdigest()
    assert digest[11].decoded_sha256 == hashlib.sha256(ODD[11].encode()).hexdigest()
    assert digest[900].n_tokens == 0


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(spark, bpe.encode(spark, docs, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_decoding_works_on_few_ids_at_a_time():
    """The way back of a million ids takes some 30 MB besides its input and output, not over 100."""
    ranks = load_ranks(RANKS)
    ids = np.resize(np.arange(20_000, 50_000, dtype=np.int32), 1_000_000)
    lists = pa.ListArray.from_arrays(np.arange(0, 1_000_001, 1000, dtype=np.int32), pa.array(ids))
    batch = pa.RecordBatch.from_arrays([pa.array(range(1000), pa.int64()), lists], names=["doc_id", "ids"])
    by_id = {number: token for token, number in ranks.items()}
    parts = bpe._decode(SimpleNamespace(value=ranks), 1)(iter([batch]))
    decoded, most = [], 0
    tracemalloc.start()
    for part in parts:
        most = max(most, tracemalloc.get_traced_memory()[1])
        decoded.append(part["decoded"].to_pylist())
    tracemalloc.stop()
    assert b"".join(sum(decoded, [])) == b"".join(by_id[int(i)] for i in ids)
    assert most < 80_000_000
