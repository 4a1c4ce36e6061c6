"""Writing a run: {uri}/{type}/{type}_{suffix}/part-* in Parquet, CSV or JSON Lines."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ticketmill import params
from ticketmill.functions import json_text
from ticketmill.operators.validity import typed
from ticketmill.sources import storage

# Fixed value: time stamps in text formats, with the offset as +00:00.
TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"


def run_path(uri: str, data_type: str, suffix: str) -> str:
    """The folder that holds one relation of one run."""
    params.one_data_type(data_type)
    return f"{params.root(uri)}/{data_type}/{data_type}_{suffix}"


def write_run(
    relations: Mapping[str, DataFrame],
    uri: str,
    suffix: str | None = None,
    fmt: str = "parquet",
    mode: str = "replace",
    max_rows: int = params.DEFAULT_MAX_ROWS,
    swap: bool = False,
) -> dict[str, int]:
    """Write every given relation; other relations and other suffixes stay as they are.

    ``replace`` leaves exactly this run's rows, none at all for an empty
    relation; ``append`` adds parts next to the ones there. Parts hold at most
    ``max_rows`` rows. Each relation is first asked whether it has a row, or
    counted where ``max_rows`` is below the default, so give frames that are cheap to start, such as staged ones. With ``swap``,
    a replaced run is written to a folder of its own inside the run's, and a
    pointer file that ``read_run`` follows is set to it when it is complete. A
    crash at any point leaves the old run or the new one, whole; what the pointer
    doesn't name is deleted last. Returns the rows written of each relation,
    counted while they are written.
    """
    counts: dict[str, int] = {}
    run_suffix = params.suffix(suffix)
    params.choice("format", fmt, params.FORMATS)
    params.choice("mode", mode, params.MODES)
    params.max_rows(max_rows)
    for data_type, df in relations.items():
        path = run_path(uri, data_type, run_suffix)
        spark = df.sparkSession
        counts[data_type] = 0
        df = _dealt(df, max_rows)
        if df.isEmpty():
            if mode == "replace":
                if swap and storage.has_files(spark, path):
                    # A version without files, so that half a deletion is no half run.
                    storage.point(spark, path, "_none")
                storage.delete(spark, path)
        elif swap and mode == "replace":
            version = f"_v-{uuid.uuid4().hex}"
            counts[data_type] = save_parts(df, data_type, f"{path}/{version}", fmt, max_rows, "error")
            storage.point(spark, path, version)
            storage.keep_only(spark, path, version, storage.POINTER)
        else:
            how = "overwrite" if mode == "replace" else "append"
            target = path if mode == "replace" else storage.current(spark, path)
            counts[data_type] = save_parts(df, data_type, target, fmt, max_rows, how)
    return counts


def _dealt(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` over the session's shuffle partitions where its parts are smaller than usual and enough for all of them.

    A task writes its parts one after the other, and staged rows of few bytes are few tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if max_rows >= params.DEFAULT_MAX_ROWS or df.count() <= max_rows * tasks:
        return df
    return df.repartition(tasks)


def save_parts(
    df: DataFrame, data_type: str, path: str, fmt: str, max_rows: int, how: str
) -> int:
    """Part files of one relation in one folder, in its declared schema; the rows written."""
    seen = Observation()
    out = typed(df, data_type).observe(seen, F.count(F.lit(1)).alias("rows"))
    if fmt == "csv" and data_type == "issues":
        out = out.withColumn("custom_fields", json_text(F.col("custom_fields")))
    writer = out.write.mode(how).option("maxRecordsPerFile", max_rows)
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        writer.options(
            header=True, escape='"', emptyValue="", nullValue="", timestampFormat=TEXT_TIME
        ).csv(path)
    else:
        writer.options(ignoreNullFields=False, timestampFormat=TEXT_TIME).json(path)
    return int(seen.get["rows"])


def rejects_path(uri: str, suffix: str) -> str:
    return f"{params.root(uri)}/rejects/rejects_{params.suffix(suffix)}"


def write_rejects(
    rejected: DataFrame, uri: str, suffix: str, mode: str = "replace", part: str = ""
) -> None:
    """Rejected rows as JSON Lines under {uri}/rejects/rejects_{suffix}."""
    path = f"{rejects_path(uri, suffix)}{part}"
    rejected.write.mode("overwrite" if mode == "replace" else "append").json(path)
