"""Board listings of good projects -> checked boards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import safe_int, variant_text
from ticketmill.operators.validity import first_reason
from ticketmill.schemas import BOARD_WIRE


def check_boards(boards: DataFrame, good_projects: DataFrame) -> DataFrame:
    """``boards(project_key, ord, body)`` joined with their project.

    Carries the project's id, key and name (``owner_*``) for the issue join and
    ``board_ord``, the board's place in its project's listing. Neither side is
    broadcast: the planner takes parsed bodies for far smaller than they are.
    """
    parsed = boards.select(
        "project_key",
        F.col("ord").alias("board_ord"),
        F.col("body").alias("raw"),
        F.inline(F.array(F.from_json("body", BOARD_WIRE))),
    )
    owners = good_projects.select(
        F.col("id").alias("project_id"),
        F.col("key").alias("owner_key"),
        F.col("name").alias("owner_name"),
    )
    flat = parsed.join(owners.hint("merge"), parsed.project_key == owners.owner_key, "inner").select(
        safe_int(F.col("id")).alias("board_id"),
        "project_id",
        variant_text(F.col("name"), "").alias("name"),
        variant_text(F.col("type"), "").alias("board_type"),
        "owner_key",
        "owner_name",
        "board_ord",
        F.col("id").alias("entity_id"),
        "raw",
    )
    return flat.withColumn(
        "reason",
        first_reason(
            (F.col("board_id").isNull(), "id is not an integer"),
            (F.col("name").isNull(), "name is null"),
            (F.col("board_type").isNull(), "type is null"),
        ),
    )
