"""First-wins choices. Order always comes from explicit columns, never from input order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.sources.storage import is_small, reads_little


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str | Column]
) -> DataFrame:
    """The first row per key in the given order.

    Planned with a group limit on both sides of the shuffle: each map task
    sends at most one row per key, so a hot key costs no more than a cold one.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn("_place", F.row_number().over(window))
    return ranked.where(F.col("_place") == 1).drop("_place")


def without_present(
    df: DataFrame, target: DataFrame, keys: Sequence[str], source: DataFrame | None = None
) -> DataFrame:
    """Rows whose key the target lacks; a null key is in no target.

    The target is cut down to the keys at hand first. Where these are few that
    is a broadcast of them (the planner's choice, by their size) and the
    target, which keeps growing, is never shuffled. The keys are read from
    ``source`` where that is cheaper to read than ``df``.
    """
    at_hand = (df if source is None else source).select(*keys).distinct()
    if is_small(at_hand) and not reads_little(at_hand):
        # The planner doesn't see how many rows an exploded list gives.
        at_hand = at_hand.hint("merge")
    present = target.select(*keys).join(at_hand, list(keys), "left_semi")
    return df.join(present, list(keys), "left_anti")


def first_board_wins(listed: DataFrame) -> DataFrame:
    """One copy per (project, issue id): that of the first board in listing
    order, then of the first place in that board's listing.

    The scope is the project, so an issue reached from two projects stays
    twice. Rows without an issue id are all kept: they are rejects, not copies
    of one another.
    """
    own_place = F.when(F.col("issue_ref").isNull(), F.struct("board_ord", "ord"))
    return first_per_key(listed, ["project_id", "issue_ref", own_place], ["board_ord", "ord"])


def first_places(listed: DataFrame) -> DataFrame:
    """Where each issue that a project lists more than once stands first: ``first``, a struct like ``place``.

    ``listed`` holds ``project_id``, ``issue_ref`` and ``place``, nothing that is wide. Places are
    combined before the shuffle, so an issue that many boards list is one row for each map task.
    """
    named = listed.where(F.col("issue_ref").isNotNull())
    places = named.groupBy("project_id", "issue_ref").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    return places.where("n > 1").drop("n")


def only_first_places(listed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``listed`` without the entries that ``first_places`` names another place for."""
    firsts = repeated.select(
        F.col("project_id").alias("first_project"), F.col("issue_ref").alias("first_ref"), "first"
    )
    same = (F.col("project_id") == F.col("first_project")) & (F.col("issue_ref") == F.col("first_ref"))
    joined = listed.join(firsts, same, "left")
    return joined.where(F.col("first").isNull() | (F.col("first") == F.col("place"))).drop(
        "first_project", "first_ref", "first"
    )


#: Rows of marks, of 4 KB each for 32,768 entries, that are sent to every task at most: 64 MB for some 500 million entries.
MOST_MARKS = 16_384


def entry_marks(chosen: DataFrame) -> DataFrame:
    """The numbers in ``entry`` as bits: ``mark_row``, ``marks``. It takes one bit for each entry, chosen or not."""
    rows = chosen.groupBy(F.bitmap_bucket_number("entry").alias("mark_row"))
    return rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("entry")).alias("marks"))


def marked_only(entries: DataFrame, marks: DataFrame) -> DataFrame:
    """The entries whose bit is set, found without moving them; all of them where the marks are too many to send."""
    if marks.limit(MOST_MARKS + 1).count() > MOST_MARKS:
        return entries
    place = F.bitmap_bit_position("entry").cast("int")
    byte = F.conv(F.hex(F.substr("marks", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, place % 8) == 1
    same = F.bitmap_bucket_number("entry") == F.col("mark_row")
    return entries.join(F.broadcast(marks), same).where(is_set).drop("mark_row", "marks")
