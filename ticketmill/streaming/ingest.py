"""Incremental ingest: landed issue pages -> parts and tables, batch by batch."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ticketmill.functions import safe_int
from ticketmill.params import RunParams, name_list
from ticketmill.plans.pipeline import make_tables
from ticketmill.plans.relations import Raw, Relations, build, issue_items, landed_dimensions
from ticketmill.schemas import REJECTS
from ticketmill.sinks.files import rejects_path, run_path, save_parts, write_rejects, write_run
from ticketmill.sinks.tables import PREFIX, load_all
from ticketmill.sources import storage
from ticketmill.sources.pages import ledger, stream_pages, torn_rejects, whole_pages
from ticketmill.streaming.state import StateTable

_SEEN = "project_id BIGINT, entity_id STRING"
_LEDGER = "request_id STRING, start_at BIGINT, total BIGINT, is_last BOOLEAN, received BIGINT"
_PARKED = "board_id BIGINT, ord STRUCT<start_at: BIGINT, pos: INT>, body STRING"
_KNOWN = "board_id BIGINT"


def run_stream(
    spark: SparkSession,
    landing_uri: str,
    params: RunParams,
    checkpoint: str,
    files_per_batch: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Follow ``{landing_uri}/issues`` and ingest each micro-batch of pages.

    Projects, details and boards are checked when their landed files have changed
    since the last batch, and rewritten whole then; a batch of issue pages alone
    takes up what the batch before has checked. Issues and transitions of batch n go to the
    folder ``batch_id=n`` of their run, so a batch that is run again after a
    failure replaces its own parts; the first batch of a new checkpoint clears
    what an earlier run of the same suffix has left there. Rejects are kept
    alike: each batch's own, and those of projects, boards and releases once.

    What spans batches is kept as tables under ``checkpoint`` (``StateTable``): the
    issues emitted (the first copy of an issue in a project wins), a ledger of
    the pages read (a page behind its request's stop is not read, whichever batch
    holds the stop; one that came in a batch before its stop has been read), and
    the entries whose board has not landed yet. These wait, unread, until their
    board has landed; a board whose project was not selected, or is a reject, drops them.

    Only ``mode="replace"`` and keyed loads hold up when a batch is run again,
    so others are refused. With ``once`` the query stops when the landed files
    are read.
    """
    if params.mode != "replace" or params.load_mode != "keyed":
        raise ValueError("a stream takes mode='replace' and load_mode='keyed' only")
    prefix = make_tables(spark, params) if params.database else PREFIX

    def ingest(pages: DataFrame, batch_id: int) -> None:
        session = pages.sparkSession
        _clear_once(session, checkpoint, params)
        folder = storage.work_folder(session, "batch")
        try:
            _ingest(session, landing_uri, params, checkpoint, prefix, pages, batch_id, folder)
        finally:
            storage.delete(session, folder)

    writer = (
        stream_pages(spark, f"{landing_uri}/issues", files_per_batch, params.multi_line)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def _ingest(
    spark: SparkSession, landing_uri: str, params: RunParams, checkpoint: str, prefix: str,
    pages: DataFrame, batch_id: int, folder: str,
) -> None:
    stage = storage.stage_in(spark, folder)
    pages = stage(pages, "issue_pages")
    read = StateTable(checkpoint, "ledger", _LEDGER, "request_id")
    seen = StateTable(checkpoint, "seen", _SEEN, "project_id")
    parked = StateTable(checkpoint, "parked", _PARKED, "board_id")
    known = StateTable(checkpoint, "known", _KNOWN, "board_id")
    dimensions = Dimensions(spark, landing_uri, params, checkpoint)
    for table in (read, seen, known):
        table.merge(spark, batch_id)
    settled_before = known.before(spark, batch_id)
    parked.merge(spark, batch_id, settled_before)

    entries = issue_items(pages, stage, read.before(spark, batch_id, whole_pages(pages)))
    # Read from the staged pages each time: a second copy would hold every body once more.
    own = entries
    wants_issues = bool({"issues", "transitions"} & set(params.data_types))
    if wants_issues:
        settled = dimensions.settled()
        if settled_before is not None:
            settled = settled.join(settled_before, "board_id", "left_anti")
        settled = stage(settled, "settled")
        waiting = parked.before(spark, batch_id, settled)
        if waiting is not None:
            # Their board has landed since the last batch.
            entries = entries.unionByName(waiting.join(settled, "board_id", "left_semi"))
    raw = replace(dimensions.raw, issues=entries)
    boards = dimensions.checked["boards"].select("board_id", "project_id")
    at_hand = entries.select("board_id").distinct().join(boards, "board_id").select("project_id").distinct()
    built = build(
        raw,
        params.data_types,
        params.project_keys,
        params.start_date,
        params.end_date,
        params.custom_fields,
        stage=stage,
        seen=seen.before(spark, batch_id, at_hand),
        ready=dimensions.checked if params.data_types else None,
    )
    facts = built.only("issues", "transitions", torn=torn_rejects(pages))
    boards_too = ["boards"] if wants_issues or "boards" in params.data_types else []
    whole = built.only("projects", "releases", *boards_too, torn=dimensions.raw.torn)
    _write_batch(facts, params, batch_id)
    if params.keep_rejects and built.checked:
        write_rejects(facts.rejects(), params.uri, params.suffix, part=f"/batch_id={batch_id}")
    if dimensions.changed:
        write_run(whole.as_dict(), params.uri, params.suffix, params.fmt, "replace", params.max_rows, params.swap)
        if params.keep_rejects and built.checked:
            write_rejects(whole.rejects(), params.uri, params.suffix, part="/dimensions")
    if params.database:
        load_all((built if dimensions.changed else facts).loadable(), params.database, prefix=prefix)
    # Last, so that a batch which failed earlier does not see itself.
    read.keep(batch_id, ledger(pages))
    if wants_issues:
        taken = built.checked["issues"].where(F.col("entity_id").isNotNull())
        seen.keep(batch_id, taken.select("project_id", "entity_id"))
        unknown = own.where(F.col("board_id").isNotNull()).join(dimensions.settled(), "board_id", "left_anti")
        parked.keep(batch_id, unknown)
        known.keep(batch_id, settled)
    dimensions.finish()


class Dimensions:
    """Checked projects and boards of the landed files, kept under the checkpoint until these files change."""

    def __init__(self, spark: SparkSession, landing_uri: str, params: RunParams, checkpoint: str):
        uri = landing_uri.rstrip("/")
        files = storage.state_of(spark, *(f"{uri}/{kind}" for kind in ("projects", "details", "boards")))
        self.spark, self.root = spark, f"{checkpoint.rstrip('/')}/dimensions"
        self.uri = f"{self.root}/{files[:32]}"
        self.changed = not storage.exists(spark, f"{self.uri}/finished/_SUCCESS")
        if self.changed:
            storage.delete(spark, self.uri)
            self._build(landing_uri, params)
        schemas = spark.read.schema("name STRING, json STRING").parquet(f"{self.uri}/schemas").collect()
        kinds = {row.name: T.StructType.fromJson(json.loads(row.json)) for row in schemas}
        self.checked = {name: spark.read.schema(kind).parquet(f"{self.uri}/{name}") for name, kind in kinds.items()}
        torn = spark.read.schema(REJECTS).parquet(f"{self.uri}/torn")
        none = spark.createDataFrame([], "body STRING")
        self.raw = Raw(projects=none, details=none, boards=none, torn=torn)

    def _build(self, landing_uri: str, params: RunParams) -> None:
        stage = storage.stage_in(self.spark, self.uri)
        raw = landed_dimensions(self.spark, landing_uri, stage, params.multi_line)
        boards = stage(raw.boards, "board_entries")
        built = build(replace(raw, boards=boards), ["boards"], params.project_keys, stage=stage)
        kinds = [(name, df.schema.json()) for name, df in built.checked.items()]
        stage(self.spark.createDataFrame(kinds, "name STRING, json STRING"), "schemas")
        stage(raw.torn, "torn")
        # A board is settled once its project has landed or is known to be not selected.
        listed = boards.select("project_key", safe_int(F.get_json_object("body", "$.id")).alias("board_id"))
        listed = listed.where(F.col("board_id").isNotNull())
        landed_keys = raw.projects.select(F.get_json_object("body", "$.key").alias("project_key")).distinct()
        settled = listed.join(landed_keys, "project_key", "left_semi")
        if keys := name_list(params.project_keys):
            settled = settled.unionByName(listed.where(~F.col("project_key").isin(*keys)))
        stage(settled.select("board_id").distinct(), "settled_boards")

    def settled(self) -> DataFrame:
        """Boards whose entries need not wait any more."""
        return self.spark.read.schema(_KNOWN).parquet(f"{self.uri}/settled_boards")

    def finish(self) -> None:
        """From now on these are taken up as they are; older ones go."""
        if self.changed:
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.uri}/finished")
            for name in storage.folders(self.spark, self.root):
                if not self.uri.endswith(name):
                    storage.delete(self.spark, f"{self.root}/{name}")


def _clear_once(spark: SparkSession, checkpoint: str, params: RunParams) -> None:
    """A new checkpoint replaces the run: an earlier one's parts and rejects go, once."""
    mark = f"{checkpoint.rstrip('/')}/started"
    if storage.has_files(spark, mark):
        return
    for name in ("issues", "transitions"):
        storage.delete(spark, run_path(params.uri, name, params.suffix))
    storage.delete(spark, rejects_path(params.uri, params.suffix))
    spark.range(1).write.mode("overwrite").parquet(mark)


def _write_batch(facts: Relations, params: RunParams, batch_id: int) -> None:
    for name, df in facts.items():
        path = f"{run_path(params.uri, name, params.suffix)}/batch_id={batch_id}"
        if df.isEmpty():
            storage.delete(df.sparkSession, path)
        else:
            save_parts(df, name, path, params.fmt, params.max_rows, "overwrite")


def first_seen(
    stream: DataFrame,
    keys: list[str],
    watermark: tuple[str, str] | None = None,
    lanes: int = 1,
) -> DataFrame:
    """One row per key over the life of a stream, whichever arrives first.

    Without a watermark the state keeps every key, as the exact rule needs;
    with ``(column, delay)`` keys older than the delay are forgotten. Copies of
    a key are first thinned out within ``lanes`` groups of map tasks where one
    key may hold much of the stream. Which copy of one micro-batch stays is
    open: where the first board must win use ``run_stream``.
    """
    if watermark is not None:
        return stream.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)
    if lanes > 1:
        lane = F.spark_partition_id() % lanes
        stream = stream.withColumn("_lane", lane).dropDuplicates([*keys, "_lane"]).drop("_lane")
    return stream.dropDuplicates(keys)
