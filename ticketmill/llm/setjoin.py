"""Jaccard join of the texts' shingle sets by prefixes of token combinations.

Blocks of texts send each distinct shingle with the texts that hold it once to
the shingle's shard, which sends back those that more than one text has, with
their frequency. What no other text has never comes back, yet counts.

A text's shingles are ordered from rare to frequent. If two sets are similar,
few of one's shingles are missing from the other, so that not all of a prefix
can be missing. Rare shingles of the prefix are indexed alone. Frequent ones are
dealt into groups by hash, and the pairs within each group are indexed: all
pairs of a group are missing only when all of its shingles but one are, so the
prefix is extended by one shingle for each group it meets, and two similar texts
still share a signature. A signature of two frequent shingles is met by far
fewer texts than either of them. Beside each signature stands how much two sets
can have in common that share nothing before it, and only sets for which that is
enough are compared. The number of groups follows the size of the
set, in steps; a set uses the steps of all sizes it can be similar to. Sets of a
few shingles index frequent ones alone.

Texts that share a signature are candidates. They are verified and put in
components by ``linking``, on their shared shingles, which are all that
two sets can have in common. Shingles are told apart by 56 bits of their hash.

Defined results: a null text and one without words are empty, and linked with
nothing; equal texts, also repeated rows, are linked; a text of fewer than five words is one
shingle. A component is named by its smallest id, null if it has none; rows of
one id are rows of their own. An empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import linking, packing
from ticketmill.llm.common import ragged, small_batches, staged
from ticketmill.llm.packing import framed, mixed, pack, pack_sorted, unframed, unpack, unpack_sorted

SHINGLE = 5
SIMILAR = 0.8
#: A shingle that more texts than this have is frequent.
OFTEN = 100
#: Sets of fewer shingles index frequent shingles alone; beyond, one group of frequent shingles for so many of the set.
LEAST_GROUPED, PER_GROUP = 32, 8

TEXTS, COPIES, SHINGLES = 0, 1, 2

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(64 - packing.KEY_BITS)


def shingle_keys(numbers: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all shingles of texts, from their words' hashes, and the text of each; a shorter text is one shingle."""
    n_shingles = np.where(sizes >= length, sizes - length + 1, np.minimum(sizes, 1))
    starts = np.cumsum(sizes) - sizes
    at, _ = ragged(starts, n_shingles)
    owner = np.repeat(np.arange(len(sizes)), n_shingles)
    left = np.minimum((starts + sizes)[owner] - at, length)
    padded = np.concatenate([numbers, np.zeros(length, np.uint64)])
    key = np.zeros(len(at), np.uint64)
    for i in range(length):
        key = mixed(key * _STEP + np.where(left > i, padded[at + i], np.uint64(i + 1)))
    return key >> _SHIFT, owner


class _Block:
    """Different texts of a run of rows, as the hashes of their words."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.known: dict[bytes, int] = {}
        self.ids: dict[bytes, list[int | None]] = {}
        self.sizes: list[int] = []
        self.numbers: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: bytes) -> None:
        # Bytes: A-Z are lower-cased and the six characters of white space split, nothing else.
        words = text.lower().split()
        key = md5(b" ".join(words)).digest()
        self.chars += len(text)
        if key in self.ids:
            self.ids[key].append(doc_id)
            return
        self.ids[key] = [doc_id]
        known = self.known
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        self.sizes.append(len(words))
        self.numbers.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))

    def rows(self, shards: int, length: int) -> Iterator[packing.Row]:
        if not self.ids:
            return
        numbers, sizes = np.concatenate(self.numbers), np.array(self.sizes, np.int64)
        key, owner = shingle_keys(numbers, sizes, length)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        key, owner = key[new], owner[new]
        table = pa.table({
            "key": pa.array(list(self.ids), pa.binary()), "ids": pa.array(list(self.ids.values()), pa.list_(pa.int64())),
            "n": np.bincount(owner, minlength=len(sizes)),
        })
        yield self.number, packing.spread(self.number, shards), TEXTS, 0, _to_bytes(table)
        for shard, part in packing.by_shard(key, shards):
            yield self.number, shard, SHINGLES, 0, framed(pack_sorted(key[part]), pack(owner[part]))
        by_shard: dict[int, list[tuple[bytes, int]]] = {}
        for i, text in enumerate(self.ids):
            by_shard.setdefault(int.from_bytes(text[:4], "little") % shards, []).append((text, i))
        for shard, some in by_shard.items():
            yield self.number, shard, COPIES, 0, framed(b"".join(text for text, _ in some), pack(np.array([i for _, i in some], np.uint64)))


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _split(shards: int, length: int, block_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[packing.Row]:
            block = _Block(packing.first_block())
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    block.add(doc_id, text.as_py() or b"")
                    if block.chars >= block_chars:
                        yield from block.rows(shards, length)
                        block = _Block(block.number + 1)
            yield from block.rows(shards, length)

        yield from packing.gathered(rows())

    return split


def _answer(held: list[packing.Row]) -> Iterator[packing.Row]:
    """For each block: its texts that an earlier block has, and its shingles that other texts have, with their frequency."""
    first: dict[bytes, int] = {}
    copies = [(row, *unframed(row[4], 2)) for row in held if row[2] == COPIES]
    for row, texts, _ in copies:
        for i in range(0, len(texts), 16):
            text = texts[i : i + 16]
            first[text] = min(first.get(text, row[0]), row[0])
    for (block, shard, kind, seq, _), texts, places in copies:
        later = [i // 16 for i in range(0, len(texts), 16) if first[texts[i : i + 16]] != block]
        if later:
            yield block, shard, kind, seq, pack(unpack(places)[later])
    yield from (row for row in held if row[2] == TEXTS)
    asked = [row for row in held if row[2] == SHINGLES]
    if not asked:
        return
    keys, owners = zip(*(unframed(row[4], 2) for row in asked), strict=True)
    keys, owners = [unpack_sorted(k) for k in keys], [unpack(o) for o in owners]
    ends = np.cumsum([len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = every[order][1:] != every[order][:-1]
    group = np.cumsum(new) - 1
    often = np.empty(len(order), np.int64)
    often[order] = np.bincount(group)[group]
    for (block, shard, kind, seq, _), key, owner, stop in zip(asked, keys, owners, ends.tolist(), strict=True):
        mine = often[stop - len(key) : stop]
        shared = mine > 1
        if shared.any():
            yield block, shard, kind, seq, framed(pack_sorted(key[shared]), pack(owner[shared]), pack(mine[shared]))


def step_of(n: int) -> int:
    """The step of sizes that a set of ``n`` shingles is in; 0: frequent shingles are indexed alone."""
    return 0 if n < LEAST_GROUPED else (n // LEAST_GROUPED).bit_length()


def groups_of(step: int) -> int:
    """Groups of frequent shingles at a step: few enough that a set of this step, or a similar one, never runs out of shingles."""
    return (LEAST_GROUPED << (step - 1)) // PER_GROUP


def signatures(
    n: int, keys: np.ndarray, often: np.ndarray, similar: float = SIMILAR, limit: int = OFTEN
) -> tuple[np.ndarray, np.ndarray]:
    """What a set of ``n`` shingles is indexed by. ``keys``: those that other sets have, from rare to frequent (``often``), then by key.

    Two sets of a Jaccard similarity of ``similar`` or more share a signature, or have no shingle that only one of them has.
    Beside each signature stands how many shingles two sets can share for which it is the first one they share;
    of a pair of frequent shingles the second one counts, and before it two sets share one of each group at most.
    """
    least = int(np.ceil(similar * n - 1e-9))
    m = len(keys)
    # More shingles of the prefix than can be missing, less those that no other set has.
    need = m - least + 1
    if need <= 0 or not m:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n_rare = int(np.searchsorted(often, limit, side="right"))
    alone = min(need, n_rare)
    found, bounds = [mixed(keys[:alone] ^ _STEP)], [m - np.arange(alone)]
    need -= n_rare
    if need > 0:
        frequent = keys[n_rare:]
        for step in range(step_of(least), step_of(int(n / similar + 1e-9)) + 1):
            seed = mixed(np.array([step + 1], np.uint64))[0]
            if not step:
                found.append(mixed(frequent[:need] ^ seed))
                bounds.append(m - n_rare - np.arange(min(need, len(frequent))))
                continue
            group = mixed(frequent) % np.uint64(groups_of(step))
            _, first = np.unique(group, return_index=True)
            new = np.zeros(len(frequent), np.int64)
            new[first] = 1
            enough = int(np.searchsorted(np.cumsum(1 - new), need)) + 1
            seen = np.cumsum(new) - new
            one, two = _within(group[:enough])
            shared = seen[two] + (m - n_rare) - two
            one, two, shared = one[shared >= least], two[shared >= least], shared[shared >= least]
            found.append(mixed(mixed(frequent[one] ^ seed) + frequent[two]))
            bounds.append(shared)
    found, bounds = np.concatenate(found), np.concatenate(bounds)
    order = np.lexsort((-bounds, found))
    found, at = np.unique(found[order], return_index=True)
    return found, bounds[order][at]


def _within(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of one group, the earlier place first."""
    order = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[order], group[order], side="right")
    here = np.arange(len(group))
    other, _ = ragged(here + 1, ends - here - 1)
    return order[np.repeat(here, ends - here - 1)], order[other]


SETS = (
    "node bigint, text binary, doc_ids array<bigint>, n bigint, first boolean, weight bigint, "
    "signatures array<bigint>, bounds array<bigint>, cells array<bigint>"
)


def _assemble(similar: float, limit: int):
    def assemble(block: int, held: list[packing.Row]) -> Iterator[pa.RecordBatch]:
        texts = pa.ipc.open_stream(next(row[4] for row in held if row[2] == TEXTS)).read_all().combine_chunks()
        sizes = np.asarray(texts["n"])
        first = np.ones(len(sizes), bool)
        for row in held:
            if row[2] == COPIES:
                first[unpack(row[4]).astype(np.int64)] = False
        none = np.zeros(0, np.uint64)
        parts = [[unpack_sorted(k), unpack(o), unpack(f)] for k, o, f in (unframed(row[4], 3) for row in held if row[2] == SHINGLES)]
        key, owner, often = (np.concatenate([none, *column]) for column in (zip(*parts, strict=True) if parts else ((), (), ())))
        owned = first[owner.astype(np.int64)]
        key, owner, often = key[owned], owner[owned].astype(np.int64), often[owned]
        order = np.lexsort((key, often, owner))
        key, owner, often = key[order], owner[order], often[order]
        ends = np.searchsorted(owner, np.arange(len(sizes)), side="right")
        begins = np.concatenate([[0], ends[:-1]])
        weight = np.concatenate([[0.0], np.cumsum(np.minimum(often, 1 << 20), dtype=np.float64)])
        for begin in range(0, len(sizes), 512):
            some = range(begin, min(begin + 512, len(sizes)))
            signs = [signatures(int(sizes[i]), key[begins[i] : ends[i]], often[begins[i] : ends[i]], similar, limit) for i in some]
            cells = [key[begins[i] : ends[i]] if len(signs[i - begin][0]) else none for i in some]
            columns = {
                "node": pa.array([_node(block, i) for i in some], pa.int64()),
                "text": texts["key"].slice(begin, len(some)).combine_chunks(),
                "doc_ids": texts["ids"].slice(begin, len(some)).combine_chunks(),
                "n": pa.array(sizes[begin : begin + len(some)], pa.int64()),
                "first": pa.array(first[begin : begin + len(some)]),
                "weight": pa.array([int(1000 * (weight[ends[i]] - weight[begins[i]]) / max(int(sizes[i]), 1)) for i in some], pa.int64()),
                "signatures": as_lists([found for found, _ in signs]),
                "bounds": as_lists([shared for _, shared in signs]),
                "cells": as_lists(cells),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return assemble


def _node(block: int, place: int) -> int:
    """Tasks, their blocks (below 2**12) and a block's texts (below 2**24 + 1, as many as characters) side by side."""
    return ((block >> 32) << 37) | ((block & 0xFFF) << 25) | place


def as_lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(arrays).view(np.int64)))


def components(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similar: float = SIMILAR,
    length: int = SHINGLE,
    often: int = OFTEN,
    shards: int | None = None,
    block_chars: int = packing.BLOCK_CHARS,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each row."""
    small_batches(spark)
    shards = shards or packing.n_shards(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = texts.mapInArrow(_split(shards, length, block_chars), packing.MOVED)
    sets = staged(spark, packing.asked(rows, _answer, _assemble(similar, often), SETS), "sets")

    signed = sets.where(F.size("signatures") > 0)
    members = signed.select("node", "weight", F.col("n").alias("size"), F.explode(F.arrays_zip("signatures", "bounds")).alias("s"))
    members = members.select(F.col("s.signatures").alias("bucket"), "node", "weight", "size", F.col("s.bounds").alias("bound"))
    groups = linking.grouped(spark, members, signed.select("node", F.col("n").alias("size"), "cells"), similar)

    copies = sets.where("n > 0").groupBy("text").agg(F.min(F.array_min("doc_ids")).alias("least"), F.min(F.when(F.col("first"), F.col("node"))).alias("node"))
    if groups is None:
        named = copies.select("text", F.col("least").alias("component_id"))
    else:
        copies = copies.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        copies = staged(spark, copies.select("text", "least", "component"), "copies")
        names = copies.groupBy("component").agg(F.min("least").alias("component_id"))
        named = copies.join(names, "component").select("text", "component_id")
    # Once for the different texts of each block, so equal texts are no hot key; their ids follow.
    full = sets.where("n > 0").select("text", "doc_ids", "n").join(named, "text")
    linked = full.select(F.explode("doc_ids").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    empty = sets.where("n = 0").select(F.explode("doc_ids").alias("doc_id"))
    return linked.unionByName(empty.select("doc_id", F.lit(0).cast("bigint").alias("n_shingles"), F.col("doc_id").alias("component_id")))


#: The same by all pairs of texts that share a shingle.
ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), texts AS (SELECT w, row_number() OVER () AS t FROM (SELECT DISTINCT w FROM docs WHERE len(w) > 0)),
places AS (SELECT t, len(w) AS n_words, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
windows AS (
  SELECT t, n_words, i, array_agg(word) OVER (PARTITION BY t ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS w FROM places
), shingles AS (SELECT DISTINCT t, w AS s FROM windows WHERE len(w) = 5 OR n_words < 5 AND i = 1),
sizes AS (SELECT t, count(*) AS n FROM shingles GROUP BY t),
shared AS (
  SELECT a.t AS a, b.t AS b, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.t < b.t GROUP BY a.t, b.t
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.t = a JOIN sizes y ON y.t = b WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT t AS a, t AS b FROM texts UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
ids AS (SELECT t, min(doc_id) AS least FROM docs JOIN texts USING (w) GROUP BY t),
named AS (SELECT a AS t, min(least) AS component_id FROM reach JOIN ids ON ids.t = reach.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN t IS NULL THEN doc_id ELSE component_id END AS component_id
FROM docs LEFT JOIN texts USING (w) LEFT JOIN sizes USING (t) LEFT JOIN named USING (t)
"""
