"""Raw projects and their detail documents -> checked projects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill.functions import (
    clean_ws,
    first_truthy,
    lax_bool,
    pii_hash,
    safe_int,
    strip_text,
    variant_text,
)
from ticketmill.operators.validity import first_reason
from ticketmill.schemas import DETAILS_WIRE, PROJECT_WIRE


def project_details(projects: DataFrame, details: DataFrame) -> DataFrame:
    """Projects joined with their details on the path of the project's own URL.

    ``projects(body)`` x ``details(path, body)``. Every string of the project
    object is stripped, those of the details are not. A project whose details
    are missing or empty drops out, and so do all its children. The planner takes
    parsed bodies for far smaller than they are, so it is told not to broadcast them.
    """
    wire = T.StructType.fromDDL(PROJECT_WIRE)
    parsed = projects.select(
        F.col("body").alias("raw"), F.inline(F.array(F.from_json("body", wire)))
    )
    cleaned = parsed.select(
        "raw", *[clean_ws(F.col(f.name), f.dataType).alias(f.name) for f in wire.fields]
    )
    with_path = cleaned.withColumn("path", F.try_parse_url("self", F.lit("PATH")))
    filled = details.where(F.size(F.json_object_keys("body")) > 0).select(
        F.col("path").alias("detail_path"),
        F.inline(F.array(F.from_json("body", DETAILS_WIRE))),
    )
    return with_path.join(filled.hint("merge"), F.col("path") == F.col("detail_path"), "inner").drop(
        "detail_path"
    )


def check_projects(projects: DataFrame, details: DataFrame) -> DataFrame:
    """The projects relation's columns plus ``versions``, ``reason`` and ``raw``."""
    archived = F.when(F.col("archived").isNull(), F.lit(False)).otherwise(
        lax_bool(strip_text(variant_text(F.col("archived"), "")))
    )
    flat = project_details(projects, details).select(
        safe_int(F.col("id")).alias("id"),
        "key",
        "name",
        strip_text(variant_text(F.col("projectTypeKey"), "")).alias("project_type_key"),
        archived.alias("archived"),
        first_truthy(F.col("projectCategory.id")).alias("project_category_id"),
        F.col("projectCategory.name").alias("project_category_name"),
        F.col("projectCategory.description").alias("project_category_description"),
        # The lead is hashed by name and key only; an account id is not used here.
        pii_hash(F.col("lead.displayName"), F.col("lead.key")).alias("lead_hash"),
        "versions",
        F.col("id").alias("entity_id"),
        "raw",
    )
    return flat.withColumn(
        "reason",
        first_reason(
            (F.col("id").isNull(), "id is not an integer"),
            (F.col("key").isNull(), "key is missing"),
            (F.col("name").isNull(), "name is missing"),
            (F.col("project_type_key").isNull(), "project_type_key is null"),
            (F.col("archived").isNull(), "archived is not a boolean"),
        ),
    )
