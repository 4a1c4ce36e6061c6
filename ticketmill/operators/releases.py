"""Versions of good projects -> checked releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import first_truthy, lax_bool, release_date, safe_int, variant_text
from ticketmill.operators.validity import first_reason


def _flag(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(False)).otherwise(lax_bool(variant_text(value, "")))


def check_releases(good_projects: DataFrame) -> DataFrame:
    """One row per version. Unlike an issue's times, a date in no known form
    rejects the row. ``good_projects`` are checked projects without a reason."""
    versions = good_projects.select(
        F.col("id").alias("project_id"),
        F.col("key").alias("project_key"),
        F.posexplode("versions").alias("version_ord", "v"),
    )
    release_text = first_truthy(F.col("v.releaseDate"))
    user_text = first_truthy(F.col("v.userReleaseDate"))
    flat = versions.select(
        safe_int(F.col("v.id")).alias("release_id"),
        variant_text(F.col("v.name"), "").alias("release_name"),
        "project_id",
        "project_key",
        _flag(F.col("v.archived")).alias("archived"),
        _flag(F.col("v.released")).alias("released"),
        release_date(release_text).alias("release_date"),
        release_date(user_text).alias("user_release_date"),
        "version_ord",
        F.col("v.id").alias("entity_id"),
        release_text.alias("release_text"),
        user_text.alias("user_text"),
        "v",
    )
    unknown_date = (F.col("release_text").isNotNull() & F.col("release_date").isNull()) | (
        F.col("user_text").isNotNull() & F.col("user_release_date").isNull()
    )
    checked = flat.withColumn(
        "reason",
        first_reason(
            (F.col("release_id").isNull(), "id is not an integer"),
            (F.col("release_name").isNull(), "name is null"),
            (F.col("archived").isNull(), "archived is not a boolean"),
            (F.col("released").isNull(), "released is not a boolean"),
            (unknown_date, "unknown date form"),
        ),
    )
    raw = F.when(F.col("reason").isNotNull(), F.to_json("v"))
    return checked.withColumn("raw", raw).drop("v", "release_text", "user_text")
