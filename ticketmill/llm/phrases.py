"""Collocations: phrases whose words occur together more often than apart, from Rabin-Karp fingerprints.

Texts are streams of words, broken at the ends of pieces. A prefix polynomial of
the words' hashes, one running sum in numpy, gives the fingerprint of every
n-gram at once: the difference of two prefixes, divided by the power where the
n-gram begins (the base is odd, so it has an inverse modulo 2**64).

Blocks of texts send each distinct fingerprint once, with its count, to the
shard that has its range, and get back one bit: whether all blocks together have
it often enough. A block's occurrences of frequent fingerprints are then pointers
into its own text: the words at each pointer are compared with those at the
first one, what differs is a collision and counted apart, and only these phrases
become text. They go to their shard once more, compressed, and counts are summed
by text, so collisions between blocks cannot mix phrases either: the counts are
exact.

A phrase is scored by how much more often it occurs than its parts would let
expect, at its weakest cut. Frequencies of parts are joined from the same table, as
a part of a frequent phrase is as frequent at least.

Defined results: a null text is empty; a null language is ``und``; repeated rows count as
often as they come, whatever their ids; an empty table gives an empty one;
columns other than the text and the language are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm import packing
from ticketmill.llm.common import small_batches, staged
from ticketmill.llm.packing import framed, mixed, pack, pack_sorted, unframed, unpack, unpack_sorted

#: What ends a piece, and what stands between words.
BREAKS, SPACES = b".,;:!?\n\x0b\x0c\r", b" \t"
LONGEST = 3
LEAST = 10
TOP = 2000
#: A phrase inside a longer one that has this share of its occurrences is dropped, in percent.
WITHIN = 50
UNKNOWN = "und"

TEXTS, GRAMS = 0, 1
COUNTS = "lang string, words int, phrase string, n bigint"

_BASE = 0x9E3779B97F4A7C15
_SHIFT = np.uint64(64 - packing.KEY_BITS)
_TABLE = bytes(ord(".") if i in BREAKS else ord(" ") if i in SPACES else i for i in range(256))


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse, modulo 2**64; ``n`` is a power of two."""

    def powers(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_BASE), powers(pow(_BASE, -1, 2**64))


def fingerprints(hashes: np.ndarray, n: int) -> np.ndarray:
    """The fingerprint of the n-gram that begins at each place where one fits."""
    size = 1 << max(len(hashes), 1).bit_length()
    power, inverse = (p[: len(hashes)] for p in _powers(size))
    prefix = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power, out=prefix[1:])
    return (prefix[n:] - prefix[: max(len(prefix) - n, 0)]) * inverse[: max(len(hashes) - n + 1, 0)]


def broken(text: bytes) -> list[bytes]:
    """The text's words, with ``.`` where a piece ends. Only A-Z are lower-cased."""
    return text.lower().translate(_TABLE).replace(b".", b" . ").split(b" ")


class _Block:
    """Texts of a run of rows: one stream of word numbers for each language. Number 0 is the end of a piece."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.known: dict[bytes, int] = {b".": 0}
        self.streams: dict[str, list[np.ndarray]] = {}

    def add(self, lang: str | None, text: bytes) -> None:
        known = self.known
        words = [word for word in broken(text) if word]
        for word in set(words):
            if word not in known:
                known[word] = len(known)
        stream = self.streams.setdefault(UNKNOWN if lang is None else lang, [])
        stream.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        stream.append(np.zeros(1, np.int64))
        self.chars += len(text)

    def texts(self) -> tuple[list[bytes], list[str], list[np.ndarray]]:
        """Words by frequency, languages and their streams."""
        streams = [np.concatenate(parts) for parts in self.streams.values()]
        often = np.bincount(np.concatenate(streams), minlength=len(self.known))
        often[0] = often.max() + 1
        by_use = np.argsort(-often, kind="stable")
        place = np.empty(len(by_use), np.int64)
        place[by_use] = np.arange(len(by_use))
        words = list(self.known)
        return [words[i] for i in by_use.tolist()], list(self.streams), [place[stream] for stream in streams]


class _Keys:
    """Keys of the n-grams of a block's streams."""

    def __init__(self, words: list[bytes], langs: list[str], streams: list[np.ndarray]):
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(word) for word in words), np.uint64, len(words))
        self.langs, self.streams = langs, streams

    def of(self, lang: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the n-grams of a language (by place) begin, and their keys."""
        stream = self.streams[lang]
        ends = np.concatenate([[0], np.cumsum(stream == 0, dtype=np.int32)])
        whole = np.flatnonzero(ends[n:] == ends[: len(ends) - n])
        own = mixed(np.array([(xxhash.xxh64_intdigest(self.langs[lang].encode()) + n) % 2**64], np.uint64))[0]
        return whole, mixed(fingerprints(self.hashes[stream], n)[whole] ^ own) >> _SHIFT

    def distinct(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The block's different keys of n-grams, in order, and their counts."""
        keys = [self.of(lang, n)[1] for lang in range(len(self.langs))]
        return np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_counts=True)


def _rows(block: _Block, shards: int, longest: int) -> Iterator[packing.Row]:
    if not block.streams:
        return
    texts = block.texts()
    words, langs, streams = texts
    head = pa.table({"words": pa.array([words], pa.list_(pa.binary())), "langs": pa.array([langs], pa.list_(pa.string()))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, head.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(head)
    whole = framed(sink.getvalue().to_pybytes(), framed(*(pack(stream) for stream in streams)))
    yield block.number, packing.spread(block.number, shards), TEXTS, 0, whole
    own = _Keys(words, langs, streams)
    for n in range(1, longest + 1):
        keys, counts = own.distinct(n)
        for shard, part in packing.by_shard(keys, shards):
            yield block.number, shard, GRAMS, n, framed(pack_sorted(keys[part]), pack(counts[part]))


def _split(shards: int, longest: int, block_chars: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[packing.Row]:
            block = _Block(packing.first_block())
            for batch in batches:
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    block.add(lang, text.as_py() or b"")
                    if block.chars >= block_chars:
                        yield from _rows(block, shards, longest)
                        block = _Block(block.number + 1)
            yield from _rows(block, shards, longest)

        yield from packing.gathered(rows())

    return split


def _answer(least: int):
    def answer(held: list[packing.Row]) -> Iterator[packing.Row]:
        """One bit for each fingerprint of a block, in order: all blocks together have it ``least`` times or more."""
        yield from (row for row in held if row[2] == TEXTS)
        asked = [row for row in held if row[2] == GRAMS]
        if not asked:
            return
        keys, counts = zip(*(unframed(row[4], 2) for row in asked), strict=True)
        keys = [unpack_sorted(k) for k in keys]
        every, counts = np.concatenate(keys), np.concatenate([unpack(c) for c in counts]).astype(np.int64)
        order = np.argsort(every, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = every[order][1:] != every[order][:-1]
        first = np.flatnonzero(new)
        enough = np.empty(len(order), bool)
        enough[order] = np.repeat(np.add.reduceat(counts[order], first) >= least, np.diff(np.append(first, len(order))))
        begin = 0
        for (block, shard, kind, seq, _), key in zip(asked, keys, strict=True):
            bits = np.packbits(enough[begin : begin + len(key)]).astype(np.uint64)
            yield block, shard, kind, seq, framed(pack(np.array([len(key)])), pack(bits, 1))
            begin += len(key)

    return answer


def _assemble(longest: int, shards: int):
    def found(block: int, held: list[packing.Row]) -> Iterator[packing.Row]:
        """The block's phrases whose fingerprints are frequent, with their counts, for the shards of their keys."""
        head, packed = unframed(next(row[4] for row in held if row[2] == TEXTS), 2)
        table = pa.ipc.open_stream(head).read_all()
        words, langs = table["words"][0].as_py(), table["langs"][0].as_py()
        streams = [unpack(field).astype(np.int32) for field in unframed(packed, len(langs))]
        own = _Keys(words, langs, streams)
        parts: dict[int, list[bytes]] = {}
        for i, lang in enumerate(langs):
            total = np.array([np.count_nonzero(streams[i])])
            parts.setdefault(packing.spread(xxhash.xxh32_intdigest(lang.encode()), shards), []).append(_texts_of(lang, 0, [b""], total))
        for n in range(1, longest + 1):
            known, _ = own.distinct(n)
            bits = [unframed(row[4], 2) for row in held if row[2] == GRAMS and row[3] == n]
            flags = [np.unpackbits(unpack(bit).astype(np.uint8), count=int(unpack(size)[0])) for size, bit in bits]
            often = known[np.concatenate([np.zeros(0, np.uint8), *flags]).astype(bool)]
            del known, flags
            if not len(often):
                continue
            for i, lang in enumerate(langs):
                begins, keys = own.of(i, n)
                at = np.minimum(np.searchsorted(often, keys), len(often) - 1)
                hit = often[at] == keys
                begins, at = begins[hit], at[hit].astype(np.int32)
                del keys, hit
                grams = np.stack([streams[i][begins + k] for k in range(n)], axis=1)
                prints, grams, counts = _phrases(at, grams)
                for shard, part in packing.by_shard(often[prints], shards):
                    texts = [b" ".join([words[w] for w in gram]) for gram in grams[part].tolist()]
                    parts.setdefault(shard, []).append(_texts_of(lang, n, texts, counts[part]))
        # One row for each shard.
        for shard, some in parts.items():
            yield block, shard, GRAMS, 0, packing.framed_list(some)

    def assemble(block: int, held: list[packing.Row]) -> Iterator[pa.RecordBatch]:
        yield from packing.gathered(found(block, held))

    return assemble


def _texts_of(lang: str, words: int, texts: list[bytes], counts: np.ndarray) -> bytes:
    # No word holds the end of a line.
    return framed(lang.encode(), bytes([words]), pack(counts, 8), zstandard.ZstdCompressor(level=1).compress(b"\n".join(texts)))


def _sum(least: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of a shard's phrases, by their text: blocks' phrases with one fingerprint are one only if their words are."""
        for _, held in packing.in_groups(batches, 1):
            totals: dict[tuple[bytes, int], dict[bytes, int]] = {}
            for part in (part for row in held for part in packing.unframed_list(row[4])):
                lang, words, counts, texts = unframed(part, 4)
                own = totals.setdefault((lang, words[0]), {})
                for text, n in zip(zstandard.ZstdDecompressor().decompress(texts).split(b"\n"), unpack(counts).tolist(), strict=True):
                    own[text] = own.get(text, 0) + n
            for (lang, words), own in totals.items():
                enough = {text.decode(): n for text, n in own.items() if n >= least or not words}
                columns = [
                    pa.array([lang.decode()] * len(enough), pa.string()), pa.array(np.full(len(enough), words, np.int32)),
                    pa.array(enough, pa.string()), pa.array(list(enough.values()), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

    return summed


def _phrases(prints: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different phrases by fingerprint: its number, the phrase's word numbers, its count."""
    order = np.argsort(prints, kind="stable")
    prints, grams = prints[order], grams[order]
    new = np.ones(len(prints), bool)
    new[1:] = prints[1:] != prints[:-1]
    first = np.flatnonzero(new)
    # Each occurrence is compared with the words that its fingerprint's first pointer has.
    same = (grams == grams[first][np.cumsum(new) - 1]).all(axis=1)
    counts = np.add.reduceat(same.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    prints_of, grams_of = prints[first], grams[first]
    if not same.all():
        others, n_others = np.unique(np.column_stack([prints[~same], grams[~same]]), axis=0, return_counts=True)
        prints_of, counts = np.concatenate([prints_of, others[:, 0]]), np.concatenate([counts, n_others])
        grams_of = np.concatenate([grams_of, others[:, 1:]])
        order = np.argsort(prints_of, kind="stable")
        prints_of, grams_of, counts = prints_of[order], grams_of[order], counts[order]
    return prints_of, grams_of, counts


def frequencies(
    spark: SparkSession,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    shards: int | None = None,
    block_chars: int = packing.BLOCK_CHARS,
) -> DataFrame:
    """``lang``, ``words``, ``phrase`` and ``n`` of all phrases of up to ``longest`` words that occur ``least`` times; for 0 words all words."""
    small_batches(spark)
    shards = shards or packing.n_shards(spark)
    texts = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = texts.mapInArrow(_split(shards, longest, block_chars), packing.MOVED)
    found = packing.asked(rows, _answer(least), _assemble(longest, shards), packing.MOVED)
    return found.repartition("shard").sortWithinPartitions("shard").mapInArrow(_sum(least), COUNTS)


def _part(begin: int, n: int) -> Column:
    return F.concat_ws(" ", F.slice(F.split("phrase", " "), begin, n))


def _inside(longest: int) -> Column:
    """The phrases of two words or more inside a longer one."""
    out = F.array().cast("array<string>")
    for words in range(3, longest + 1):
        parts = [_part(begin, n) for n in range(2, words) for begin in range(1, words - n + 2)]
        out = F.when(F.col("words") == words, F.array_distinct(F.array(*parts))).otherwise(out)
    return out


def collocations(
    spark: SparkSession,
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    within: int = WITHIN,
    longest: int = LONGEST,
    shards: int | None = None,
    block_chars: int = packing.BLOCK_CHARS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of the ``top`` best phrases of two words or more of each language."""
    counts = staged(spark, frequencies(spark, docs, text_col, lang_col, least, longest, shards, block_chars), "frequencies")
    phrases = counts.where("words > 1").withColumnRenamed("n", "a")
    parts = counts.where((F.col("words") > 0) & (F.col("words") < longest))
    cuts = phrases.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"), F.split("phrase", " ").alias("w"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("left"),
        F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.size("w"))).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    # Decimals of 38 digits hold the products exactly, and their integral quotient is exact.
    a, l, r = (f"cast({name} as decimal(19, 0))" for name in "alr")  # noqa: E741
    cuts = cuts.withColumn("score", F.expr(f"(cast(1000000 as decimal(7, 0)) * {a} * {a}) div ({l} * {r})"))
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    longer = phrases.select("lang", F.col("a").alias("longest"), F.explode(_inside(longest)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    left = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < within * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    placed = left.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", "n")
    return placed.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


#: The same from lists of words.
ORACLE_SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), texts AS (SELECT row_number() OVER () AS t, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
places AS (SELECT t, lang, unnest(w) AS one, unnest(range(1, len(w) + 1)) AS i FROM texts),
rows AS (SELECT lang, one, lead(one) OVER (PARTITION BY t ORDER BY i) AS two, lead(one, 2) OVER (PARTITION BY t ORDER BY i) AS three FROM places),
grams AS (
  SELECT lang, 1 AS words, one AS phrase FROM rows
  UNION ALL SELECT lang, 2, one || ' ' || two FROM rows WHERE two IS NOT NULL
  UNION ALL SELECT lang, 3, one || ' ' || two || ' ' || three FROM rows WHERE three IS NOT NULL
), counts AS (SELECT lang, words, phrase, count(*) AS f, lang || chr(10) || phrase AS id FROM grams GROUP BY lang, words, phrase),
candidates AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE words > 1 AND f >= 10),
parts AS (
  SELECT *, lang || chr(10) || array_to_string(w[1 : k], ' ') AS left_id, lang || chr(10) || array_to_string(w[k + 1 :], ' ') AS right_id
  FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)
), cuts AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM parts c JOIN counts x ON x.id = left_id JOIN counts y ON y.id = right_id
), weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE words = 3
  UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE words = 3
), remaining AS (
  SELECT * FROM weakest x WHERE NOT EXISTS (SELECT 1 FROM longer y WHERE y.lang = x.lang AND y.phrase = x.phrase AND 100 * y.a >= 50 * x.a)
), placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM remaining),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM texts GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""
