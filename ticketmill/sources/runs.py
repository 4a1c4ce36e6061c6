"""Reading written runs back: a folder of parts is one relation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import params
from ticketmill.schemas import RECORDS
from ticketmill.sinks.files import TEXT_TIME, run_path
from ticketmill.sources.storage import current, folders, has_files


def _scan(spark: SparkSession, paths: str | list[str], data_type: str, fmt: str) -> DataFrame:
    schema = RECORDS[params.one_data_type(data_type)]
    params.choice("format", fmt, params.FORMATS)
    reader = spark.read.option("recursiveFileLookup", True)
    if fmt == "parquet":
        return reader.schema(schema).format("parquet").load(paths)
    reader = reader.option("timestampFormat", TEXT_TIME)
    if fmt == "jsonl":
        return reader.schema(schema).json(paths)
    flat = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name == "custom_fields" else f.dataType)
            for f in schema.fields
        ]
    )
    rows = reader.schema(flat).options(header=True, multiLine=True, escape='"').csv(paths)
    if data_type == "issues":
        as_map = F.from_json("custom_fields", schema["custom_fields"].dataType)
        rows = rows.withColumn("custom_fields", as_map)
    return rows


def read_run(
    spark: SparkSession, uri: str, data_type: str, suffix: str, fmt: str = "parquet"
) -> DataFrame:
    """One relation of one run, every part under its folder, in its declared schema.

    A relation that wrote no part reads as no rows.
    """
    path = current(spark, run_path(uri, data_type, suffix))
    if not has_files(spark, path):
        return spark.createDataFrame([], RECORDS[data_type])
    return _scan(spark, path, data_type, fmt)


def read_runs(spark: SparkSession, uri: str, data_type: str, fmt: str = "parquet") -> DataFrame:
    """One relation of all runs under ``uri``, with each row's ``run`` suffix."""
    root = f"{params.root(uri)}/{params.one_data_type(data_type)}"
    names = [name for name in folders(spark, root) if name.startswith(f"{data_type}_")]
    paths = [path for path in (current(spark, f"{root}/{name}") for name in names) if has_files(spark, path)]
    if not paths:
        return spark.createDataFrame([], RECORDS[data_type]).withColumn("run", F.lit(None).cast("string"))
    # A relation's name has no underscore, so the suffix is all behind the first one.
    run = F.regexp_extract("_metadata.file_path", f"/{data_type}/{data_type}_([^/]+)/", 1)
    return _scan(spark, paths, data_type, fmt).withColumn("run", run)


def written_types(
    spark: SparkSession, uri: str, suffix: str, data_types: str | Iterable[str] | None = None
) -> tuple[str, ...]:
    """The asked-for relations that have at least one part in this run."""
    chosen = params.data_types(data_types)
    return tuple(name for name in chosen if has_files(spark, current(spark, run_path(uri, name, suffix))))


def bulk_prefixes(
    spark: SparkSession, uri: str, suffix: str, data_types: str | Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """Per relation of a Parquet run, all its parts; relations without parts are skipped."""
    names = written_types(spark, uri, suffix, data_types)
    return {name: read_run(spark, uri, name, suffix) for name in names}
