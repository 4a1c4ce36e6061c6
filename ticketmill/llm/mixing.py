"""Mixing sources to target weights by repeating documents.

Sizes are summed for each source. A source's share of all sizes follows its
weight, but stops at a number of repetitions of the source; what is then left
over goes to the other sources by weight, until none is above its stop. Target
over size is the source's repetition rate. A document is taken floor(rate) times,
and once more when a number drawn from its id's hash is below the fraction.

Source-level steps are jobs over one row for each source; only two sums and a
count come to the driver. Everything is DataFrame functions.

Defined results: a null text has size 0; a null source is a source of its own
and comes last; sources without any words have target 0; rows without id, or of
an id that comes more than once, each draw a number of their own, from their
text's digest and their place among such rows; an empty table gives an empty one; other
columns are ignored by ``repetitions`` and kept by ``repeated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm.common import WORD, free_name, staged, with_ordinal

DRAW_DIGITS = 13


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(doc_id: Column, seed: int, own: Column | None = None) -> Column:
    """A number in [0, 1) from the hash of the seed, the id and, where given, what tells rows of one id apart."""
    parts = [F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))]
    key = F.concat(*parts, *([] if own is None else [F.lit(":"), own]))
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("double")
    return digits / F.lit(float(16**DRAW_DIGITS))


def drawn(spark: SparkSession, rows: DataFrame, id_col: str, digest: Column, source_col: str, name: str, seed: int) -> DataFrame:
    """``rows`` with a draw ``name``. An id of its own has its own draw; rows without id or with a repeated one differ by their text's digest and their place."""
    id_of, same = F.col(id_col), free_name(rows, "same_id")
    ids = rows.where(id_of.isNotNull()).groupBy(id_of.alias(same)).agg(F.count("*").alias("n"))
    twice = staged(spark, ids.where("n > 1").select(same), "repeated_ids")
    single = rows.where(id_of.isNotNull()).join(twice, id_of == F.col(same), "left_anti").withColumn(name, draw(id_of, seed))
    others = rows.join(twice, id_of == F.col(same), "left_semi").unionByName(rows.where(id_of.isNull()))
    text, place = free_name(rows, "_digest"), free_name(rows, "_place")
    others = with_ordinal(spark, others.withColumn(text, digest), [id_col, text, source_col], place, "drawn")
    own = F.concat(F.col(text), F.lit(":"), F.col(place).cast("string"))
    return single.unionByName(others.withColumn(name, draw(id_of, seed, own)).drop(text, place))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def source_targets(
    spark: SparkSession, sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3
) -> DataFrame:
    """``source``, ``source_size``, ``weight`` and ``target`` from rows of ``source`` and ``size``.

    Sources in the order of their code points, null last, have the weights in
    turn. Sums stay whole numbers; each target is one division of two of them.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_ordinal(spark, summed, ["source"], "place", "sources")
    by_place = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = staged(
        spark, placed.select("source", "source_size", by_place.cast("bigint").alias("weight")), "weights"
    )
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    stop = F.col("source_size") * most
    left, share = total, placed.agg(F.sum("weight")).first()[0] or 1
    stopped = 0
    while True:
        # A source is above its stop when weight * left / share is.
        above = F.col("weight") * F.lit(left) >= stop * F.lit(share)
        row = placed.where(above).agg(F.count("*"), F.sum(stop), F.sum("weight")).first()
        if row[0] == stopped:
            break
        stopped = row[0]
        whole = placed.agg(F.sum("weight")).first()[0]
        left, share = total - row[1], whole - row[2]
        if not share:
            break
    even = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(share or 1))
    target = F.when(F.lit(share == 0) | above, stop.cast("double")).otherwise(even)
    return placed.withColumn("target", target)


def repetitions(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 17,
) -> DataFrame:
    """``doc_id``, ``size``, ``source``, ``source_size``, ``target`` and ``copies`` of each row."""
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"),
        text_digest(F.col(text_col)).alias("digest"),
    )
    sized = staged(spark, sized, "sizes")
    targets = staged(spark, source_targets(spark, sized, weights, most), "targets")
    sized = drawn(spark, sized, "doc_id", F.col("digest"), "source", "draw", seed)
    joined = sized.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("rate") + F.when(F.col("draw") < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    return (
        joined.select("d.doc_id", "d.size", "d.source", "t.source_size", "t.target", "d.draw")
        .withColumn("rate", rate)
        .withColumn("copies", copies.cast("bigint"))
        .drop("rate", "draw")
    )


def repeated(
    spark: SparkSession,
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    seed: int = 17,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the mix takes it, with the columns of ``docs``."""
    sized = docs.select(F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
    targets = staged(spark, source_targets(spark, sized, weights, most), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.select("source", rate.alias("rate")).alias("r")
    fraction = F.col("r.rate") - F.floor("r.rate")
    copy, own = free_name(docs, "copy"), free_name(docs, "draw")
    copies = F.floor("r.rate") + F.when(F.col(f"d.{own}") < fraction, 1).otherwise(0)
    return (
        drawn(spark, docs, id_col, text_digest(F.col(text_col)), source_col, own, seed).alias("d")
        .join(rates, F.col(f"d.{source_col}").eqNullSafe(F.col("r.source")))
        .select("d.*", F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias(copy))
        .drop(copy, own)
    )


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size, md5(coalesce(text, '')) AS digest,
         doc_id IS NOT NULL AND count(*) OVER (PARTITION BY doc_id) = 1 AS single
  FROM documents
), named AS (
  -- Rows without an id of their own differ by their text's digest and their place.
  SELECT *, '17:' || coalesce(doc_id::VARCHAR, '') || CASE WHEN single THEN '' ELSE ':' || digest || ':' ||
    (row_number() OVER (PARTITION BY single ORDER BY doc_id NULLS LAST, digest, source NULLS LAST) - 1)::VARCHAR END AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS s,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source
), run AS (
  -- Sources in the order in which they reach their stop; the first that stays below it ends the list.
  SELECT *, (sum(s) OVER ())::BIGINT AS total,
         coalesce(sum(3 * s) OVER before, 0)::BIGINT AS stopped, (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS share
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * s / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT total - stopped AS rest, share FROM run
  WHERE w * (total - stopped) < 3 * s * share
  ORDER BY 3.0 * s / w, w, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, s, CASE WHEN rest IS NULL OR w * rest >= 3 * s * share THEN (3 * s)::DOUBLE
                         ELSE (w * rest)::DOUBLE / share::DOUBLE END AS target
  FROM sources LEFT JOIN level ON true
), drawn AS (
  SELECT doc_id, size, s, target, CASE WHEN s > 0 THEN target / s::DOUBLE ELSE 0 END AS rate,
         ('0x' || substr(md5(key), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM named d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
       ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM drawn
"""
