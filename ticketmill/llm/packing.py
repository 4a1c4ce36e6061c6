"""Blocks of texts ask shards about sorted keys: packed rows, and the walks over them.

A block is a run of texts of one task. What it wants to know of all texts
together, it asks about sorted distinct keys (hashes of words, n-grams or
shingles), each sent once, to the shards, which are ranges of keys. A shard
gathers the keys of all blocks in sorted arrays and answers each block. A key
that a third of all rows have is one entry for each block, so none is hot.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Bits of a key. Two of n keys are equal by chance in about n * n / 2**57 cases.
KEY_BITS = 56
#: Characters of text in one block.
BLOCK_CHARS = 16_000_000

MOVED = "block bigint, shard int, kind int, seq int, data binary"
MOVED_ARROW = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("kind", pa.int32()), ("seq", pa.int32()), ("data", pa.binary())])

Row = tuple[int, int, int, int, bytes]

_MULTIPLY = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


def pack(values: np.ndarray, size: int = 4) -> bytes:
    """Numbers below 2**(8 * size) as zstd bytes: equal bytes of all numbers side by side."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)
    return bytes([size]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    """The numbers of ``pack`` as uint64."""
    size = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(size, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :size] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return pack(steps, max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def framed(*fields: bytes) -> bytes:
    sizes = np.array([len(field) for field in fields], dtype="<u8")
    return sizes.tobytes() + b"".join(fields)


def unframed(data: bytes, n: int) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(data, dtype="<u8", count=n)) + 8 * n
    starts = [8 * n, *ends[:-1].tolist()]
    return [data[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]


def framed_list(fields: list[bytes]) -> bytes:
    return np.array([len(fields)], "<u8").tobytes() + framed(*fields)


def unframed_list(data: bytes) -> list[bytes]:
    return unframed(data[8:], int(np.frombuffer(data, "<u8", 1)[0]))


def gathered(rows: Iterator[Row], most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about ``most`` bytes."""
    held: list[Row] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[4])
        if size >= most:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[Row]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, MOVED_ARROW, strict=True)], schema=MOVED_ARROW)


def spread(number: int, shards: int) -> int:
    """The shard that rows without keys go through."""
    return int(mixed(np.array([number], np.uint64))[0] % np.uint64(shards))


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """The shards of sorted keys, and the slice that goes to each."""
    if not len(keys):
        return
    shard = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(shards) >> np.uint64(32)
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    for begin, stop in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
        yield int(shard[begin]), slice(begin, stop)


def first_block() -> int:
    """The number of a task's first block; the next ones count on."""
    return TaskContext.get().partitionId() << 32


def in_groups(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[Row]]]:
    """Rows that follow each other with the same block (column 0) or shard (column 1)."""
    held: list[Row] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][column] != row[column]:
                yield held[0][column], held
                held = []
            held.append(row)
    if held:
        yield held[0][column], held


def n_shards(spark: SparkSession) -> int:
    """More shards than tasks, so that one of them fits in memory whatever the input."""
    return max(128, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def asked(
    rows: DataFrame,
    answer: Callable[[list[Row]], Iterator[Row]],
    assemble: Callable[[int, list[Row]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Rows of blocks go to their shards, ``answer`` makes a shard's rows into rows for blocks, ``assemble`` gets a block's."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered(row for _, held in in_groups(batches, 1) for row in answer(held))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in in_groups(batches, 0):
            yield from assemble(block, held)

    answered = rows.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(answers, MOVED)
    return answered.repartition("block").sortWithinPartitions("block", "kind", "shard", "seq").mapInArrow(blocks, schema)
