"""Logged conversations: cumulative snapshots collapsed, the rest rendered as training text.

Logs often hold a conversation again and again, each time with the turns so far.
A rolling hash runs over the turns: the prefix of k turns has the sum, modulo
2**32 and four times over, of hashes that depend on a turn's place, role and
text. A conversation whose whole hash is the hash of a longer one's first turns
is a snapshot of it and goes; of equal conversations the smallest id stays. An
anti join on (number of turns, hash) finds that, with each prefix there once
however many conversations begin alike. What stays is rendered turn by turn.

Everything is DataFrame functions. Places come from one sort by range, and sums
run over chunks of a conversation's turns, so a conversation with a third of all
turns is no task of its own; its text is given in parts.

Defined results: turns are in the order of turn number, role and content; a null
role or text differs from an empty one in the comparison and is rendered empty;
turns without conversation id are one conversation without id; a turn that is
there twice counts twice; an empty table gives an empty one; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.common import staged, with_ordinal

#: Turns whose hashes are summed up in one window.
CHUNK = 4096
#: Turns in one part of a rendered conversation.
PART = 256
LOW = (1 << 32) - 1


def _hashes(*columns: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *columns) for seed in (1, 2)]


def _same(left: str, right: str, *names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return out


def placed_turns(
    spark: SparkSession, df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id``, ``role``, ``text``, two hashes of them, and ``at``: places in the order of all turns, staged."""
    role, text = F.col(role_col).cast("string"), F.col(text_col).cast("string")
    h1, h2 = _hashes(role.isNull(), F.coalesce(role, F.lit("")), text.isNull(), F.coalesce(text, F.lit("")))
    turns = df.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), h1.alias("h1"), h2.alias("h2"),
    )
    placed = with_ordinal(spark, turns, ["conv_id", "turn", "role", "text"], "at", "turns")
    return staged(spark, placed, "placed")


def prefixes(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """``conv_id``, ``first_at``, ``n`` (turns), ``k`` and the hash ``a``, ``b`` of its first k turns, staged."""
    stats = placed.groupBy("conv_id").agg(F.min("at").alias("first_at"), F.count("*").alias("n"))
    turns = placed.select("conv_id", "at", "h1", "h2").alias("t").join(stats.alias("s"), _same("t", "s", "conv_id"))
    turns = turns.select("s.conv_id", "s.first_at", "s.n", (F.col("at") - F.col("first_at") + 1).alias("k"), "h1", "h2")
    x, y = _hashes(F.col("k"), F.col("h1"), F.col("h2"))
    halves = {"s0": x.bitwiseAND(LOW), "s1": F.shiftrightunsigned(x, 32), "s2": y.bitwiseAND(LOW), "s3": F.shiftrightunsigned(y, 32)}
    # The conversation's first place is its own, also where the id is null.
    turns = turns.withColumns(halves).withColumn("chunk", F.floor((F.col("k") - 1) / CHUNK))
    running = Window.partitionBy("first_at", "chunk").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    inside = turns.select("conv_id", "first_at", "n", "k", "chunk", *[F.sum(s).over(running).alias(s) for s in halves])
    totals = turns.groupBy("first_at", "chunk").agg(*[F.sum(s).alias(s) for s in halves])
    earlier = Window.partitionBy("first_at").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("first_at", "chunk", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in halves])
    total = {s: (F.col(s) + F.col(f"{s}_before")).bitwiseAND(LOW) for s in halves}
    summed = inside.join(before, ["first_at", "chunk"]).select(
        "conv_id", "first_at", "n", "k",
        F.shiftleft(total["s0"], 32).bitwiseOR(total["s1"]).alias("a"),
        F.shiftleft(total["s2"], 32).bitwiseOR(total["s3"]).alias("b"),
    )
    return staged(spark, summed, "prefixes")


def maximal(spark: SparkSession, rolled: DataFrame) -> DataFrame:
    """``conv_id``, ``first_at`` and ``n`` of the conversations that begin no longer one, one of each content."""
    whole = rolled.where("k = n").groupBy("n", "a", "b")
    whole = whole.agg(F.min(F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "first_at")).alias("one"))
    begins = rolled.where("k < n").select(F.col("k").alias("n"), "a", "b").distinct()
    return staged(spark, whole.join(begins, ["n", "a", "b"], "left_anti").select("one.conv_id", "one.first_at", "n"), "maximal")


def rendered(
    spark: SparkSession, df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part: int = PART
) -> DataFrame:
    """``conv_id``, ``n_turns``, ``part`` (from 0, of ``part`` turns each) and ``text`` of the maximal conversations."""
    placed = placed_turns(spark, df, conv_col, turn_col, role_col, text_col)
    kept = maximal(spark, prefixes(spark, placed))
    turns = placed.alias("t").join(kept.alias("m"), _same("t", "m", "conv_id"))
    line = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n"))
    place = F.col("at") - F.col("first_at")
    turns = turns.select("m.conv_id", "first_at", "n", F.floor(place / part).alias("part"), F.struct(place.alias("k"), line.alias("line")).alias("turn"))
    # A group has at most ``part`` turns.
    joined = turns.groupBy("conv_id", "first_at", "n", "part").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return joined.select("conv_id", F.col("n").alias("n_turns"), "part", F.array_join("turns.line", "").alias("text"))


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations
), marked AS (
  SELECT *, md5(coalesce('r' || role, 'n') || '/' || md5(coalesce('t' || text, 'n'))) AS h FROM turns
), prefixes AS (
  SELECT conv_id, n, k, md5(string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY k)) AS p FROM marked
), maximal AS (
  SELECT min(conv_id) AS conv_id, n FROM prefixes w
  WHERE k = n AND NOT EXISTS (SELECT 1 FROM prefixes o WHERE o.k = w.n AND o.p = w.p AND o.k < o.n)
  GROUP BY n, p
)
SELECT t.conv_id, m.n AS n_turns, ((t.k - 1) // 256)::BIGINT AS part,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY t.k) AS text
FROM turns t JOIN maximal m ON t.conv_id IS NOT DISTINCT FROM m.conv_id
GROUP BY ALL
"""
