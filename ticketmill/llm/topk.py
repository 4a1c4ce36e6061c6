"""Exact top-k by inner product over an impact-ordered index, score at a time.

The index has blocks of vectors. In a block each dimension's values are
quantised to levels; a segment of postings holds the vectors of one dimension
and level. A query gives each segment an impact: how much it lies above the
least contribution of that dimension. Segments are processed by descending
impact, over all dimensions at once; each adds its impact to its vectors. What a
vector can still gain is then at most the next impact for every dimension not
yet seen, so that each vector has a lower and an upper bound. Processing stops
when the bounds prove that all but a few vectors are outside the top k; those
few are scored exactly. Without such a proof all segments are processed.

Every query visits every block; a visit leaves k rows, and the best k of these
are the result.

Defined results: vectors that are null, or hold a null or a component that is
not finite, take no part; shorter vectors count as filled up with zeros; a row
without id is a candidate but no query, and comes last among ties; repeated rows
are rows of their own, also as queries; fewer than k candidates give fewer rows;
an empty table gives an empty result. Inner products must fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.common import staged

BLOCK_ROWS = 8_192
LEVELS = 12
LAST = np.iinfo(np.int64).max


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id`` and ``vector``: floor(scale * x) of each component; rows that take no part are left out."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    return df.where(x.isNotNull()).where(~bad).select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v.cast("double") * F.lit(float(scale)))).cast("array<bigint>").alias("vector"),
    )


def _matrix(lists: list[np.ndarray]) -> np.ndarray:
    dims = max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), dims), np.int64)
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


class Index:
    """The postings of a block: for each dimension its rows by descending level."""

    def __init__(self, vectors: np.ndarray, levels: int):
        n, dims = vectors.shape
        self.vectors, self.levels = vectors, levels
        self.low, self.high = (vectors.min(axis=0), vectors.max(axis=0)) if n else (np.zeros(dims, np.int64),) * 2
        self.step = np.maximum(1, -((self.low - self.high - 1) // levels))
        level = (vectors - self.low) // self.step
        self.orders = np.ascontiguousarray(np.argsort(-level, axis=0, kind="stable").T)
        counts = [np.bincount(level[:, d], minlength=levels)[::-1] for d in range(dims)]
        self.ends = np.cumsum(np.array(counts, np.int64).reshape(dims, levels), axis=1)
        self.starts = np.concatenate([np.zeros((dims, 1), np.int64), self.ends[:, :-1]], axis=1)
        # The largest and smallest value that a segment can hold.
        steps = np.arange(levels - 1, -1, -1)
        self.bottom = self.low[:, None] + self.step[:, None] * steps
        self.top_edge = np.minimum(self.bottom + self.step[:, None] - 1, self.high[:, None])

    def segments(self, query: np.ndarray) -> tuple[list[tuple[int, int, int, int]], int]:
        """(most, least, dimension, segment) by descending impact, and the number of dimensions that count.

        Most and least are how far a contribution lies above the dimension's least one.
        """
        q = query[:, None]
        ends = q * self.top_edge, q * self.bottom
        most, least = np.maximum(*ends), np.minimum(*ends)
        full = (self.ends > self.starts) & (q != 0)
        floor = np.where(full, least, LAST).min(axis=1, initial=LAST)[:, None]
        dims, places = np.nonzero(full)
        most, least = (most - floor)[dims, places], (least - floor)[dims, places]
        order = np.argsort(-most, kind="stable")
        found = zip(*(a[order].tolist() for a in (most, least, dims, places)), strict=True)
        return list(found), int(full.any(axis=1).sum())

    def top(self, query: np.ndarray, tie: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the best ``k`` rows, and the number of postings processed.

        ``tie`` orders equal scores; the row at ``own`` takes no part.
        """
        n, dims = self.vectors.shape
        segments, counting = self.segments(query)
        upper, lower = np.zeros(n, np.int64), np.zeros(n, np.int64)
        unseen = np.full(n, counting, np.int64)
        alive = np.ones(n, bool)
        if own >= 0:
            alive[own] = False
        possible = alive
        prunable = int(alive.sum()) > k
        done, check, often, enough = 0, 0, n * max(1, dims // 8), max(4 * k, n // 64)
        for most, least, d, s in segments if prunable else ():
            if done >= check:
                # What a row has not shown yet adds this segment's impact at most in each dimension.
                bound = np.partition(lower[alive], -k)[-k]
                possible = alive & (upper + unseen * most >= bound)
                if int(possible.sum()) <= enough:
                    break
                check = done + often
            at = self.orders[d, self.starts[d, s] : self.ends[d, s]]
            upper[at] += most
            lower[at] += least
            unseen[at] -= 1
            done += len(at)
        else:
            if prunable:
                possible = alive & (upper >= np.partition(lower[alive], -k)[-k])
        places = np.flatnonzero(possible)
        scores = self.vectors[places] @ query
        best = np.lexsort((tie[places], -scores))[:k]
        return places[best], scores[best], done


def _search(k: int, levels: int):
    """Rows of a block come sorted: first its vectors (no query id), then the queries that visit it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, uids, held = None, [], [], []
        index = None
        for batch in batches:
            block, kind, uid, vec_id, lists = batch.columns
            offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
            out: list[tuple] = []
            for i, (b, is_query, u, v) in enumerate(zip(*(c.to_pylist() for c in (block, kind, uid, vec_id)), strict=True)):
                vector = values[offsets[i] : offsets[i + 1]]
                if b != now:
                    now, ids, uids, held, index = b, [], [], [], None
                if not is_query:
                    ids.append(v)
                    uids.append(u)
                    held.append(vector)
                    continue
                if index is None:
                    vectors = _matrix(held)
                    index = Index(vectors, levels)
                    tie = np.array([LAST if x is None else x for x in ids], np.int64)
                    place = {x: at for at, x in enumerate(uids)}
                    held = []
                dims = vectors.shape[1]
                query = np.zeros(dims, np.int64)
                query[: min(dims, len(vector))] = vector[:dims]
                places, scores, _ = index.top(query, tie, k, place.get(u, -1))
                out += [(u, v, ids[p], s) for p, s in zip(places.tolist(), scores.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query", "query_id", "vec_id", "score"]
            )

    return search


def top_k(
    spark: SparkSession,
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    block_rows: int = BLOCK_ROWS,
    levels: int = LEVELS,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: for each row whose id is
    divisible by ``every`` the ``k`` other rows of highest inner product, ties to the smaller id."""
    rows = whole_vectors(df, id_col, vector_col, scale).withColumn("uid", F.monotonically_increasing_id())
    rows = staged(spark, rows, "vectors")
    blocks = max(1, -(-rows.count() // block_rows))
    columns = ("block", "is_query", "uid", "vec_id", "vector")
    # A row's number is its own, so that blocks are even whatever the vectors are.
    vectors = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int")).withColumn("is_query", F.lit(False))
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        .withColumn("is_query", F.lit(True))
    )
    visits = vectors.select(*columns).unionByName(queries.select(*columns))
    visits = visits.repartition(blocks, "block").sortWithinPartitions("block", "is_query")
    found = visits.mapInArrow(_search(k, levels), "query bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = """
WITH whole AS (
  SELECT vec_id, embedding, row_number() OVER () AS uid FROM embeddings WHERE embedding IS NOT NULL
), parts AS (
  SELECT uid, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM whole
), fit AS (
  SELECT uid FROM parts GROUP BY uid HAVING count(*) = count(x) AND bool_and(isfinite(x))
), ints AS (
  SELECT uid, vec_id, d, floor(1024 * x)::BIGINT AS x FROM parts SEMI JOIN fit USING (uid)
), scored AS (
  SELECT q.uid AS query, q.vec_id AS query_id, c.uid, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM ints q JOIN ints c ON q.d = c.d AND q.uid <> c.uid
  WHERE q.vec_id % 100 = 0 GROUP BY ALL
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
) WHERE rank <= 10
"""
