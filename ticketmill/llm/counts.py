"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries, encoded in batches of about equal bytes, and
only the number of tokens of each piece is kept. A boundary is safe where no
piece of the vocabulary can reach over it, so that the counts of both sides add
up to the count of the whole: for a sentencepiece model without normalisation
that is before a space mark that follows another character, given that no piece
has a space mark after another character. The model is checked for that; a
model that is different is encoded text by text.

Defined results: a null text is empty and has 0 tokens; repeated rows and null
ids are counted like any other; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from ticketmill.llm.common import small_batches

#: Bytes of distinct pieces that are encoded in one call.
BATCH_BYTES = 1_000_000
#: Distinct pieces whose counts a task remembers.
KNOWN_PIECES = 400_000
SPACE = "▁"


def splits_at_spaces(model: sentencepiece.SentencePieceProcessor) -> bool:
    """True when a space mark after another character is a boundary that no token reaches over."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces):
        return False
    # The mark is put before each text and nothing else is changed or dropped.
    probe = " a  　ﬁ "
    return model.decode(model.encode(probe)) == probe and model.encode("a") == model.encode(SPACE + "a")[1:]


def _counter(model: sentencepiece.SentencePieceProcessor, batch_bytes: int) -> Callable[[list[str]], np.ndarray]:
    def lengths(texts: list[str]) -> list[int]:
        return [len(ids) for ids in model.encode(texts, num_threads=1)]

    def batched(texts: list[str]) -> Iterator[int]:
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text) * 2
            if size >= batch_bytes:
                yield from lengths(held)
                held, size = [], 0
        if held:
            yield from lengths(held)

    if not splits_at_spaces(model):
        return lambda texts: np.fromiter(batched(texts), np.int64, len(texts))

    # A mark alone, at a text's end: encoding what follows it would give the empty text.
    alone = {SPACE: len(model.encode("a ")) - len(model.encode("a"))}
    known = dict(alone)

    def count(texts: list[str]) -> np.ndarray:
        if len(known) > KNOWN_PIECES:
            known.clear()
            known.update(alone)
        totals = np.zeros(len(texts), np.int64)
        cut = [_pieces(text) if text else () for text in texts]
        new = list({piece for pieces in cut for piece in pieces if piece not in known})
        # A piece starts with the mark that the model puts before each text.
        known.update(zip(new, batched([piece[1:] for piece in new]), strict=True))
        for i, pieces in enumerate(cut):
            totals[i] = sum(map(known.__getitem__, pieces))
        return totals

    return count


def _pieces(text: str) -> list[str]:
    """The text with marks for spaces and one before it, cut before each mark that follows another character."""
    if SPACE in text or "  " in text or text[0] == " ":
        return re.findall(f"{SPACE}+[^{SPACE}]*", (SPACE + text.replace(" ", SPACE)))
    # Single spaces only: the same cuts, found faster.
    return [SPACE + word for word in text.split(" ")]


def _even(texts: list[str | None], batch_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``batch_bytes`` each."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= batch_bytes:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _count(model_sent, batch_bytes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sentencepiece.SentencePieceProcessor(model_proto=model_sent.value)
        of = _counter(model, batch_bytes)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [of(texts[a:b]) for a, b in _even(texts, 4 * batch_bytes)]
            numbers = pa.array(np.concatenate([np.zeros(0, np.int64), *tokens]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), numbers], names=["doc_id", "n_bytes", "n_tokens"])

    return count


def token_counts(
    spark: SparkSession,
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more tokens than ``limit``) of each text."""
    small_batches(spark)
    with open(model_path, "rb") as model:
        sent = spark.sparkContext.broadcast(model.read())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("bigint").alias("n_bytes")
    )
    counted = rows.mapInArrow(_count(sent, batch_bytes), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
