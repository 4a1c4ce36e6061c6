"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

A task splits its texts into pre-tokens (the matches of the tokenizer's
pattern), keeps each text as a stream of places in its block's own word list,
and sends every distinct word of a block once to the word's shard. There each
distinct word is encoded once. The ids go back to the blocks, where the streams
of places turn into streams of ids. A word that makes up a third of all tokens
is one entry per block in the shuffle, so it is no hot key.

Decoding joins the ids with the table of token bytes, which has as many rows as
the vocabulary and is sent to every task for that reason.

Defined results: a null text is an empty text and has no ids; repeated rows and
null ids are rows like any other; an empty table gives an empty one; columns
other than the id and the text are ignored. The input must give the same rows
when it is read again (a table, or staged rows), as for every Spark job with
more than one stage.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.common import load_ranks, ragged, small_batches, tidy

#: Characters of text that share one word list.
BLOCK_CHARS = 16_000_000
#: Pre-tokens in one row of places.
PIECE_WORDS = 500_000

MOVED = "block bigint, shard int, kind int, seq int, data binary"
WORDS, PLACES = 0, 1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank, leftmost first, is joined until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2]) for i in range(len(piece) - 1)]
    while True:
        best, at = None, -1
        for i, rank in enumerate(pairs):
            if rank is not None and (best is None or rank < best):
                best, at = rank, i
        if best is None:
            return [ranks[part] for part in parts]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1])
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at])


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long pieces, in n log n steps: a heap of pairs over a linked list of parts."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0: joined to one before
    start_before = list(range(-1, n))  # start of the part before; at n: of the last part
    heap = [(ranks[p], i, i + 2) for i in range(n - 1) if (p := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        start_before[stop] = i
        if stop < n and (rank := ranks.get(piece[i : end[stop]])) is not None:
            heapq.heappush(heap, (rank, i, end[stop]))
        if (left := start_before[i]) >= 0 and (rank := ranks.get(piece[left:stop])) is not None:
            heapq.heappush(heap, (rank, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def chunks(text: str) -> list[str]:
    """``text`` cut before single spaces between two characters that aren't white space.

    No match of a pattern whose matches are white space, or one optional space
    before other characters, reaches over such a place, so that chunks can be
    matched one by one.
    """
    parts = text.split(" ")
    out, held = [], parts[0]
    for part in parts[1:]:
        if part and held and not held[-1].isspace() and not part[0].isspace():
            out.append(held)
            held = " " + part
        else:
            held += " " + part
    out.append(held)
    return out


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as zstd bytes: equal bytes of all numbers side by side."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _pack_places(places: np.ndarray) -> bytes:
    """Places in a list that is sorted by frequency: one byte for the frequent ones, the others apart."""
    press = zstandard.ZstdCompressor(level=9).compress
    rare = places >= 255
    return _framed(press(np.where(rare, 255, places).astype(np.uint8).tobytes()), _pack(places[rare] - 255))


def _unpack_places(data: bytes) -> np.ndarray:
    short, rare = _unframed(data, 2)
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(short), np.uint8).astype(np.uint32)
    places[places == 255] = _unpack(rare) + 255
    return places


def _framed(*fields: bytes) -> bytes:
    sizes = np.array([len(field) for field in fields], dtype="<u8")
    return sizes.tobytes() + b"".join(fields)


def _unframed(data: bytes, n: int) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(data, dtype="<u8", count=n)) + 8 * n
    starts = [8 * n, *ends[:-1].tolist()]
    return [data[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]


class _Block:
    """The word list of a run of texts, and the texts as places in it."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.words: dict[str, int] = {}
        self.known: dict[str, list[int]] = {}
        self.docs: list[tuple[int | None, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str, matches) -> None:
        words, known, places = self.words, self.known, []
        for chunk in chunks(text):
            found = known.get(chunk)
            if found is None:
                found = known[chunk] = [words.setdefault(m, len(words)) for m in matches(chunk)]
            places += found
        self.docs.append((doc_id, np.array(places, dtype=np.uint32)))
        self.chars += len(text)

    def rows(self, shards: int) -> Iterator[tuple]:
        # Frequent words first, which makes the places small numbers.
        none = np.zeros(0, np.uint32)
        often = np.bincount(np.concatenate([none, *(places for _, places in self.docs)]), minlength=len(self.words))
        by_use = np.argsort(-often, kind="stable")
        place = np.empty(len(by_use), np.uint32)
        place[by_use] = np.arange(len(by_use), dtype=np.uint32)
        words = list(self.words)
        texts = [words[i].encode() for i in by_use.tolist()]
        shard_of = np.fromiter((zlib.crc32(t) % shards for t in texts), np.uint32, len(texts))
        order = np.argsort(shard_of, kind="stable")
        press = zstandard.ZstdCompressor(level=3).compress
        for run in np.split(order, np.flatnonzero(np.diff(shard_of[order])) + 1) if len(order) else ():
            own = [texts[i] for i in run]
            sizes = np.array([len(t) for t in own], dtype=np.uint32)
            yield self.number, int(shard_of[run[0]]), WORDS, 0, _framed(_pack(sizes), press(b"".join(own)))
        # The first row of places also has the shards, from which the words' order follows.
        head, seq, held, size = _pack(shard_of), 0, [], 0
        for i, doc in enumerate(self.docs):
            held.append((doc[0], place[doc[1]]))
            size += len(doc[1])
            if size >= PIECE_WORDS or i + 1 == len(self.docs):
                route = zlib.crc32(b"%d/%d" % (self.number, seq)) % shards
                yield self.number, route, PLACES, seq, _framed(head if not seq else b"", *_packed_docs(held))
                seq, held, size = seq + 1, [], 0


def _packed_docs(docs: list[tuple[int | None, np.ndarray]]) -> tuple[bytes, bytes, bytes]:
    ids = pa.array([d for d, _ in docs], pa.int64())
    sizes = np.array([len(p) for _, p in docs], dtype=np.uint32)
    nulls = np.asarray(ids.is_null()).astype(np.uint8).tobytes()
    plain = np.asarray(ids.fill_null(0)).astype("<i8").tobytes()
    press = zstandard.ZstdCompressor(level=3).compress
    return press(nulls + plain), _pack(sizes), _pack_places(np.concatenate([p for _, p in docs]))


def _unpacked_docs(ids: bytes, sizes: bytes, places: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(ids)
    n = len(raw) // 9
    plain = np.frombuffer(raw[n:], dtype="<i8")
    return pa.array(plain, pa.int64(), mask=np.frombuffer(raw[:n], np.uint8) == 1), _unpack(sizes), _unpack_places(places)


MOVED_ARROW = pa.schema(
    [("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()), ("seq", pa.int32()), ("data", pa.binary())]
)


def _moved(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, MOVED_ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=MOVED_ARROW)


def _gathered(rows: Iterator[tuple], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``most`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[4])
        if size >= most:
            yield _moved(held)
            held, size = [], 0
    if held:
        yield _moved(held)


def _split(pattern: str, shards: int, block_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = regex.compile(pattern).findall
        first = TaskContext.get().partitionId() << 32

        def rows() -> Iterator[tuple]:
            block = _Block(first)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    block.add(doc_id, text.as_py() or "", matches)
                    if block.chars >= block_chars:
                        yield from block.rows(shards)
                        block = _Block(block.number + 1)
            yield from block.rows(shards)

        yield from _gathered(rows())

    return split


def _encode(ranks_sent):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_sent.value
        inflate = zstandard.ZstdDecompressor().decompress

        def rows() -> Iterator[tuple]:
            known: dict[bytes, list[int]] = {}
            shard_now = None
            for batch in batches:
                for block, shard, kind, seq, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if kind == PLACES:
                        yield block, shard, kind, seq, data
                        continue
                    if shard != shard_now:
                        known, shard_now = {}, shard
                    sizes, blob = _unframed(data, 2)
                    text, at, ids, counts = inflate(blob), 0, [], []
                    for size in _unpack(sizes).tolist():
                        word = text[at : at + size]
                        at += size
                        found = known.get(word)
                        if found is None:
                            found = known[word] = merge(word, ranks)
                        ids += found
                        counts.append(len(found))
                    packed = _framed(_pack(np.array(counts, np.uint32)), _pack(np.array(ids, np.uint32)))
                    yield block, shard, kind, seq, packed

        yield from _gathered(rows())

    return encode


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block_now, counts, ids = None, [], []
    starts = lengths = flat = np.zeros(0, np.int64)
    for batch in batches:
        for block, _, kind, seq, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if block != block_now:
                block_now, counts, ids = block, [], []
            if kind == WORDS:
                some_counts, some_ids = _unframed(data, 2)
                counts.append(_unpack(some_counts))
                ids.append(_unpack(some_ids))
                continue
            head, *docs = _unframed(data, 4)
            if seq == 0:
                order = np.argsort(_unpack(head), kind="stable")
                by_shard = np.concatenate([np.zeros(0, np.int64), *counts]).astype(np.int64)
                if len(by_shard) != len(order):
                    raise RuntimeError(f"block {block} got {len(by_shard)} of {len(order)} words back")
                flat = np.concatenate([np.zeros(0, np.uint32), *ids])
                lengths = np.zeros(len(order), np.int64)
                starts = np.zeros(len(order), np.int64)
                lengths[order] = by_shard
                starts[order] = np.cumsum(by_shard) - by_shard
                counts, ids = [], []
            doc_ids, sizes, places = _unpacked_docs(*docs)
            items, ends = ragged(starts[places], lengths[places])
            doc_ends = np.concatenate([[0], np.concatenate([[0], ends])[np.cumsum(sizes, dtype=np.int64)]])
            lists = pa.ListArray.from_arrays(doc_ends.astype(np.int32), pa.array(flat[items].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([doc_ids, lists], names=["doc_id", "ids"])


def encode(
    spark: SparkSession,
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int): each text by the ranks of the file, without special tokens.

    ``shards`` (8 for each shuffle partition, 256 at least) bounds memory: a
    task holds the distinct words of one shard, or of one block, at a time.
    """
    blocks = _coded_blocks(spark, docs, ranks_path, pattern, id_col, text_col, shards, block_chars)
    return blocks.mapInArrow(tidy(_assemble), "doc_id bigint, ids array<int>")


def round_trip(
    spark: SparkSession,
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``encode`` and then ``decode`` in one go: the ids' way back starts in the task that has put them together."""
    blocks = _coded_blocks(spark, docs, ranks_path, pattern, id_col, text_col, shards, block_chars)
    back = _decode(spark.sparkContext.broadcast(load_ranks(ranks_path)), 1)
    return blocks.mapInArrow(tidy(lambda batches: back(_assemble(batches))), "doc_id bigint, ids array<int>, decoded binary")


def _coded_blocks(
    spark: SparkSession, docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, shards: int | None, block_chars: int
) -> DataFrame:
    """Blocks in order: their words' ids, then their texts as places in the word list."""
    small_batches(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or max(256, 8 * partitions)
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    texts = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    split = texts.mapInArrow(tidy(_split(pattern, shards, block_chars)), MOVED)
    words = split.repartition("shard").sortWithinPartitions("shard", "kind")
    coded = words.mapInArrow(tidy(_encode(ranks)), MOVED)
    by_shard = F.when(F.col("kind") == WORDS, F.col("shard"))
    return coded.repartition("block").sortWithinPartitions("block", "kind", by_shard, "seq")


def _decode(ranks_sent, at: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_sent.value
        size = max(ranks.values(), default=-1) + 1
        lengths, starts, tokens, place = np.zeros(size, np.int64), np.zeros(size, np.int64), [], 0
        for token, number in ranks.items():
            lengths[number], starts[number] = len(token), place
            tokens.append(token)
            place += len(token)
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            for begin, stop in _even_runs(batch.column(at)):
                part = batch.slice(begin, stop - begin)
                lists = part.column(at)
                offsets = np.asarray(lists.offsets).astype(np.int64)
                ids = np.asarray(lists.values)[offsets[0] : offsets[-1]]
                items, ends = ragged(starts[ids], lengths[ids])
                ends = np.concatenate([[0], ends])[offsets - offsets[0]].astype(np.int32)
                decoded = pa.Array.from_buffers(
                    pa.binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(blob[items].tobytes())]
                )
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return decode


def _even_runs(lists: pa.ListArray, most: int = 250_000) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` items, so that working arrays stay small."""
    offsets = np.asarray(lists.offsets).astype(np.int64)
    begin = 0
    while begin < len(lists):
        stop = int(np.searchsorted(offsets, offsets[begin] + most))
        stop = min(max(stop, begin + 1), len(lists))
        yield begin, stop
        begin = stop


def decode(spark: SparkSession, coded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with ``decoded`` (binary): the bytes of its ids. A null list of ids gives no bytes."""
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    whole = coded.withColumn(ids_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.schema) + ", decoded binary"
    return whole.mapInArrow(_decode(ranks, whole.columns.index(ids_col)), schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Number and SHA-256 of the ids (decimal, joined by one space), and SHA-256 of the decoded bytes."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
