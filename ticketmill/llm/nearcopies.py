"""Near copies of texts by DartMinHash signatures and banded joining.

A text is the weighted set of its five-word shingles; a shingle's weight is how
often it occurs. Every shingle owns a region, as wide as its weight and endless
in rank, into which hashed darts are thrown at a fixed density. The same region
gets the same darts in every text. A dart hits one of the signature's
coordinates, and each coordinate keeps its earliest dart. Ranks are worked off
in layers that double in height, for all texts of a batch at once, until a
text's coordinates are all hit; that takes about k ln k darts, whatever the
number of shingles. Two texts agree in a coordinate with a probability of their
weighted Jaccard similarity.

Bands of the signature put texts into buckets. In a bucket texts are compared
with leaders, the texts that share most buckets with others, by the exact
similarity of their shingles (``linking``): a group of n near copies costs about n
comparisons and not n squared. Buckets of two bands joined give leaders for closer
relatives. Texts of buckets that are then in different components are indexed by
prefixes of their shingles from rare to frequent, which two similar texts must
share, with bounds on what they can have in common, and compared as far as these
allow it. So no link between texts of one bucket is missed. Components of the
links are the classes.

Texts with the same words in a row are copies; one of them stands for all, so
that thousands of copies are one text in everything that follows. Texts of fewer
than five words are one shingle. Texts without words, also null ones, are copies
of each other. Rows of equal id are rows of their own. A class is named by its
smallest id, null if it has none. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import linking
from ticketmill.llm.common import WORD, free_name, ragged, small_batches, staged, tidy
from ticketmill.llm.setjoin import as_lists
from ticketmill.llm.setjoin import signatures as signatures_of

SHINGLE = 5
BANDS, ROWS = 24, 6
SIMILAR = 0.8
#: Height of the first layer of ranks, as a power of two.
FIRST_LAYER = -8
LAST_LAYER = 8
#: Words whose texts are worked off together.
BATCH_WORDS = 400_000

_WORDS = re.compile(WORD)
_MULTIPLY = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


@cache
def _poisson(layer: int) -> np.ndarray:
    """The distribution of the number of darts in a region of weight 1 and this layer's height, as 32-bit steps."""
    mean = 2.0**layer
    chance, steps, total = np.exp(-mean), [], 0.0
    for n in range(int(mean + 12 * np.sqrt(mean) + 30)):
        total += chance
        steps.append(total)
        chance *= mean / (n + 1)
    return (np.minimum(np.array(steps), 1.0) * 2.0**32).astype(np.uint64)


def _layers() -> Iterator[tuple[int, float, float]]:
    """Layers of ranks: power of two of the height, where it begins, its height. Heights double up to the last one's."""
    layer, begin = FIRST_LAYER, 0.0
    while True:
        yield layer, begin, 2.0**layer
        begin += 2.0**layer
        layer = min(layer + (begin > 2.0**FIRST_LAYER), LAST_LAYER)


def signatures(cells: np.ndarray, owner: np.ndarray, n: int, k: int) -> np.ndarray:
    """For ``n`` texts the earliest dart of each of ``k`` coordinates.

    ``cells`` are hashes of regions of weight 1 (a shingle of weight 3 has
    three), ``owner`` the text of each. A text without cells has no darts.
    """
    unhit = np.uint64(0xFFFFFFFFFFFFFFFF)
    earliest = np.full(n * k, unhit)
    for number, (layer, begin, height) in enumerate(_layers()):
        if not len(cells):
            break
        seed = _mix(cells + np.uint64(int(_STEP) * (number + 1) % 2**64))
        count = np.searchsorted(_poisson(layer), seed >> np.uint64(32), side="right")
        hit = np.flatnonzero(count)
        of = np.repeat(hit, count[hit])
        nth = ragged(np.zeros(len(hit), np.int64), count[hit])[0].astype(np.uint64)
        dart = _mix(seed[of] + _STEP * (nth + np.uint64(1)))
        rank = begin + height * ((dart >> np.uint64(32)).astype(np.float64) / 2.0**32)
        # Positive floats order like their bits: rank first, then the dart's own hash.
        packed = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | (_mix(dart) >> np.uint64(32))
        coordinate = (dart & np.uint64(0xFFFFFFFF)) % np.uint64(k)
        np.minimum.at(earliest, owner[of] * k + coordinate.astype(np.int64), packed)
        open_texts = (earliest.reshape(n, k) == unhit).any(axis=1)
        more = open_texts[owner]
        cells, owner = cells[more], owner[more]
    return earliest.reshape(n, k)


def _cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' weighted shingles, one for each unit of weight, and the text of each."""
    known: dict[str, int] = {}
    numbers, sizes = [], []
    for text in texts:
        words = _WORDS.findall(text)
        sizes.append(len(words))
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        numbers += map(known.__getitem__, words)
    words, sizes = np.array(numbers, np.uint64), np.array(sizes, np.int64)
    # Shingles of a text start at all but its last four words; a shorter text is one shingle.
    n_shingles = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    starts = np.cumsum(sizes) - sizes
    at, _ = ragged(starts, n_shingles)
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    left = np.minimum((starts + sizes)[owner] - at, SHINGLE)
    padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
    hashes = np.zeros(len(at), np.uint64)
    for i in range(SHINGLE):
        hashes = _mix(hashes * _MULTIPLY[0] + np.where(left > i, padded[at + i], np.uint64(i + 1)))
    # The second, third, ... unit of a shingle's weight are cells of their own.
    key = _mix(hashes + owner.astype(np.uint64) * _STEP)
    order = np.argsort(key, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    run = np.flatnonzero(new)
    unit = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
    cells = hashes
    if (unit > 0).any():
        cells = hashes.copy()
        cells[order] = np.where(unit > 0, _mix(hashes[order] + _STEP * unit.astype(np.uint64)), hashes[order])
    return cells, owner


def _even(texts: list[str]) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= 6 * BATCH_WORDS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def _sketch(bands: int, rows: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            texts = ["" if x is None else x for x in column.to_pylist()]
            for begin, stop in _even(texts):
                n = stop - begin
                cells, owner = _cells(texts[begin:stop])
                earliest = signatures(cells, owner, n, bands * rows).reshape(n, bands, rows)
                key = np.zeros((n, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * _STEP
                for r in range(rows):
                    key = _mix(key * _MULTIPLY[1] + earliest[:, :, r])
                weight = np.bincount(owner, minlength=n)
                # A text without words has no bands.
                ends = np.concatenate([[0], np.cumsum(np.where(weight > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, pa.array(key[weight > 0].view(np.int64).ravel()))
                part = batch.slice(begin, n)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=[*part.schema.names[:-1], "bands"])

    return sketch


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = ["" if x is None else x for x in batch.column(batch.num_columns - 1).to_pylist()]
        for begin, stop in _even(texts):
            cells, owner = _cells(texts[begin:stop])
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=stop - begin))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(cells.view(np.int64)))
            part = batch.slice(begin, stop - begin)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=[*part.schema.names[:-1], "cells"])


def same_words(text: Column) -> Column:
    """Equal for texts of the same words in a row."""
    spaced = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.md5(F.trim(spaced).cast("binary"))


def _indexed(spark: SparkSession, texts: DataFrame, similar: float) -> DataFrame:
    """Members of buckets that all ``similar`` texts share, with bounds: prefixes of their shingles from rare to frequent."""
    every = staged(spark, texts.select("node", "size", F.explode("cells").alias("cell")), "apart_cells")
    often = every.groupBy("cell").agg(F.count("*").alias("often")).where("often > 1")
    shared = every.join(often, "cell").groupBy("node").agg(F.first("size").alias("size"), F.sort_array(F.collect_list(F.struct("often", "cell"))).alias("c"))
    shared = shared.select("node", "size", F.col("c.often").alias("often"), F.col("c.cell").alias("cells"))
    weight = F.aggregate("often", F.lit(0).cast("bigint"), lambda x, y: x + y) * 1000 / F.col("size")
    kind = "node bigint, size bigint, weight bigint, buckets array<bigint>, bounds array<bigint>"
    shared = shared.select("node", F.col("size").cast("bigint"), weight.cast("bigint").alias("weight"), "often", "cells")
    signed = shared.mapInArrow(tidy(_signed(similar)), kind)
    members = signed.select("node", "size", "weight", F.explode(F.arrays_zip("buckets", "bounds")).alias("s"))
    return staged(spark, members.select(F.col("s.buckets").alias("bucket"), "node", "weight", "size", F.col("s.bounds").alias("bound")), "indexed")


def _signed(similar: float):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, often, cells in zip(batch.column("size").to_pylist(), batch.column("often"), batch.column("cells"), strict=True):
                keys = np.asarray(cells.values).astype(np.int64).view(np.uint64)
                found.append(signatures_of(n, keys, np.asarray(often.values), similar))
            columns = [as_lists([one[i].view(np.int64) for one in found]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "size", "weight")), *columns], names=["node", "size", "weight", "buckets", "bounds"])

    return signed


def classes(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similar: float = SIMILAR,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """``doc_id``, ``class_id`` and ``n_texts`` (different texts of the class), one row for each row."""
    found = _classed(spark, docs, id_col, text_col, similar, bands, rows)
    return found.select("doc_id", "class_id", "n_texts")


def _classed(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, similar: float, bands: int, rows: int) -> DataFrame:
    """The same with ``component``, which tells classes apart when ids repeat, and ``words_md5``."""
    small_batches(spark)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), same_words(F.col(text_col)).alias("words_md5"), F.col(text_col).cast("string").alias("text")
    )
    sketched = texts.mapInArrow(tidy(_sketch(bands, rows)), "doc_id bigint, words_md5 string, bands array<bigint>")
    sketched = staged(spark, sketched, "sketches")
    nodes = sketched.groupBy("words_md5").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    nodes = staged(spark, nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    members = _shared(members)
    # Neighbouring bands joined: smaller buckets, of closer relatives.
    involved = nodes.join(members.select("node").distinct(), "node", "left_semi")
    i = F.sequence(F.lit(0), F.lit(bands - 1))
    joined = F.transform(i, lambda x: F.xxhash64(F.get("bands", x), F.get("bands", (x + 1) % bands)))
    finer = _shared(involved.select("node", F.explode(joined).alias("bucket")))
    members = staged(spark, members.unionByName(finer), "members")
    popular = members.groupBy("node").agg(F.sum("n").alias("weight"))

    chosen = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "words_md5", "first_id")
    again = texts.join(
        chosen.select("node", F.col("words_md5").alias("md5"), "first_id"),
        (F.col("words_md5") == F.col("md5")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    )
    cells = again.select("node", "text").mapInArrow(tidy(_shingles), "node bigint, cells array<bigint>")
    cells = staged(spark, cells.groupBy("node").agg(F.first("cells").alias("cells")), "cells").withColumn("size", F.size("cells"))
    # What a text can share with another one of its bucket is all that it has.
    sizes = cells.select("node", "size", F.col("size").alias("bound"))
    members = staged(spark, members.select("bucket", "node").join(popular, "node").join(sizes, "node"), "members")
    links, met = linking.led(spark, members, cells, similar)
    groups = linking.grouped_by(spark, links)
    apart = staged(spark, linking.apart(spark, members, groups, similar).select("node").distinct(), "apart")
    groups = linking.finished(spark, _indexed(spark, cells.join(apart, "node"), similar), cells, similar, links, met)

    if groups is None:
        grouped = nodes.withColumn("component", F.col("node"))
    else:
        grouped = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    grouped = staged(spark, grouped.select("words_md5", "first_id", "component"), "grouped")
    named = grouped.groupBy("component").agg(F.min("first_id").alias("class_id"), F.count("*").alias("n_texts"))
    classed = staged(spark, grouped.join(named, "component").select("words_md5", "component", "class_id", "n_texts"), "classes")
    return sketched.select("doc_id", "words_md5").join(classed, "words_md5")


def _shared(members: DataFrame) -> DataFrame:
    """``node``, ``bucket`` and ``n`` of the buckets with more than one node."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return members.join(sizes, "bucket").select("node", "bucket", "n")


def deduplicated(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """``docs`` with one row of each class: the one of the smallest id; of rows alike in id and words, one."""
    found = _classed(spark, docs, id_col, text_col, similar, BANDS, ROWS)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "words_md5")).alias("first")
    kept = staged(spark, found.groupBy("component").agg(first).select("first.doc_id", "first.words_md5"), "kept")
    key = free_name(docs, "words_md5")
    keyed = docs.withColumn(key, same_words(F.col(text_col)))
    same = (F.col(f"d.{key}") == F.col("k.words_md5")) & F.col(f"d.{id_col}").cast("bigint").eqNullSafe(F.col("k.doc_id"))
    rows = keyed.alias("d").join(kept.alias("k"), same).select("d.*")
    return rows.dropDuplicates([id_col, key]).drop(key)
