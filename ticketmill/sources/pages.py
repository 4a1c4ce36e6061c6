"""Landed response pages: scan, stop rule, completeness audit, explode to items.

A page is one row: ``request_id`` (endpoint and query string), ``start_at``,
``total``, ``is_last``, ``payload``, the array of raw JSON texts, and ``torn``,
the raw text of a landed line that is no JSON; such a row has nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketmill.schemas import CORRUPT, DETAIL_ENVELOPE, ENVELOPE
from ticketmill.sources.storage import Stage, unstaged


def _as_pages(envelopes: DataFrame) -> DataFrame:
    whole = F.col(CORRUPT).isNull()
    return envelopes.select(
        F.when(whole, F.col("request_id")).alias("request_id"),
        F.when(whole, F.coalesce("startAt", F.lit(0))).alias("start_at"),
        F.when(whole, F.col("total")).alias("total"),
        F.when(whole, F.col("isLast")).alias("is_last"),
        F.when(whole, F.coalesce("issues", "values")).alias("payload"),
        F.col(CORRUPT).alias("torn"),
    )


def _json(reader, schema: str, multi_line: bool):  # noqa: ANN001, ANN202
    options = {"multiLine": multi_line, "columnNameOfCorruptRecord": CORRUPT}
    return reader.schema(schema).options(**options)


def scan_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed page files under ``path``: one envelope per line, or one per file."""
    return _as_pages(_json(spark.read, ENVELOPE, multi_line).json(path))


def stream_pages(
    spark: SparkSession, path: str, files_per_batch: int | None = None, multi_line: bool = False
) -> DataFrame:
    """The same scan as an unbounded source: page files as they land."""
    reader = _json(spark.readStream, ENVELOPE, multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _as_pages(reader.json(path))


def parse_pages(texts: DataFrame, column: str = "page") -> DataFrame:
    """Pages from a column that holds one envelope's JSON text per row."""
    parsed = F.from_json(column, ENVELOPE, {"columnNameOfCorruptRecord": CORRUPT})
    return _as_pages(texts.select(F.inline(F.array(parsed))))


def scan_details(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed detail responses: ``path`` of the request, the raw ``body``, and ``torn``."""
    landed = _json(spark.read, DETAIL_ENVELOPE, multi_line).json(path)
    whole = F.col(CORRUPT).isNull()
    return landed.select(
        F.when(whole, F.col("request_id")).alias("path"),
        F.when(whole, F.col("body")).alias("body"),
        F.col(CORRUPT).alias("torn"),
    )


def torn_rejects(pages: DataFrame, key: str = "request_id") -> DataFrame:
    """Landed lines that are no JSON, as rejects of the relation ``pages``."""
    return pages.where(F.col("torn").isNotNull()).select(
        F.lit("pages").alias("relation"),
        F.col(key).alias("entity_id"),
        F.lit("line is no readable page").alias("reason"),
        F.col("torn").alias("raw"),
    )


def whole_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("torn").isNull()) if "torn" in pages.columns else pages


def ledger(pages: DataFrame) -> DataFrame:
    """What the stop rule needs of each page, without its payload."""
    return whole_pages(pages).select(
        "request_id", "start_at", "total", "is_last", _received().alias("received")
    )


def _received() -> Column:
    return F.coalesce(F.size("payload"), F.lit(0)).cast("bigint")


def _stops() -> Column:
    """This page, a row of the ledger, is the last one the paged read would have asked for."""
    empty = F.col("received") <= 0
    reached = F.col("start_at") + F.col("received") >= F.col("total")
    return F.coalesce("is_last", F.lit(False)) | empty | F.coalesce(reached, F.lit(False))


def until_stop(
    pages: DataFrame,
    stage: Stage = unstaged,
    name: str = "strays",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Pages at or before the first stopping page of their request.

    Only requests that hold a page past their stop need a cut. They come from
    the ledger, an aggregate of narrow rows that is combined map-side, and are
    joined back; no window, for that would gather one request's whole payload
    in one task. Staged, their true size is known: there are hardly ever any,
    so the join is a broadcast and payloads stay where they are. ``earlier`` is
    the ledger of pages that earlier batches have read.
    """
    narrow = ledger(pages)
    if earlier is not None:
        narrow = narrow.unionByName(earlier)
    starts = narrow.select("request_id", "start_at", F.when(_stops(), F.col("start_at")).alias("s"))
    cuts = (
        starts.groupBy(F.col("request_id").alias("cut_request"))
        .agg(F.min("s").alias("stop_at"), F.max("start_at").alias("last_at"))
        .where(F.col("last_at") > F.col("stop_at"))
        .select("cut_request", "stop_at")
    )
    read = whole_pages(pages)
    joined = read.join(stage(cuts, name), F.col("request_id") == F.col("cut_request"), "left")
    within = F.col("stop_at").isNull() | (F.col("start_at") <= F.col("stop_at"))
    return joined.where(within).drop("cut_request", "stop_at")


def items(pages: DataFrame) -> DataFrame:
    """One row per payload entry: ``request_id``, ``ord`` (its place) and ``body``."""
    exploded = pages.select("request_id", "start_at", F.posexplode("payload").alias("pos", "body"))
    return exploded.select("request_id", F.struct("start_at", "pos").alias("ord"), "body")


def paged_items(
    pages: DataFrame,
    stage: Stage = unstaged,
    name: str = "strays",
    earlier: DataFrame | None = None,
) -> DataFrame:
    """The items a paged read returns: the stop rule, then the union of payloads."""
    return items(until_stop(pages, stage, name, earlier))


#: Places of a request's positions that one window goes over.
AUDIT_SPAN = 100_000


def audit_pages(pages: DataFrame) -> DataFrame:
    """Per request: pages, positions received, announced total, gaps, completeness.

    A gap is a page that starts beyond the furthest end of the pages before it,
    and positions that two pages cover count once. Without an announced total a
    request is complete when it has a page that stops the read. The running
    furthest end goes over spans of a request's positions, and over one row for
    each span, so one request with very many pages is spread over many tasks;
    payloads are not carried along, and torn lines belong to no request.
    """
    narrow = ledger(pages).where(F.col("request_id").isNotNull())
    narrow = narrow.withColumn("ends", F.col("start_at") + F.col("received"))
    narrow = narrow.withColumn("span", F.floor(F.col("start_at") / AUDIT_SPAN))
    spans = narrow.groupBy("request_id", "span").agg(F.max("ends").alias("span_end"))
    earlier = Window.partitionBy("request_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("request_id", "span", F.max("span_end").over(earlier).alias("reach_before"))
    inside = (
        Window.partitionBy("request_id", "span")
        .orderBy("start_at", "ends")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = narrow.withColumn("reach_inside", F.max("ends").over(inside)).join(spans, ["request_id", "span"])
    reach = F.greatest(F.coalesce("reach_inside", F.lit(0)), F.coalesce("reach_before", F.lit(0)))
    new = F.greatest(F.col("ends") - F.greatest(reach, F.col("start_at")), F.lit(0))
    per_request = marked.groupBy("request_id").agg(
        F.count("*").alias("pages"),
        F.sum(new).alias("received"),
        F.max("total").alias("announced"),
        F.sum((F.col("start_at") > reach).cast("bigint")).alias("gaps"),
        F.max(_stops()).alias("stopped"),
    )
    enough = F.coalesce(F.col("received") >= F.col("announced"), F.col("stopped"))
    return per_request.withColumn("complete", (F.col("gaps") == 0) & enough).drop("stopped")


# --- what a request id says ----------------------------------------------


def board_of_request(request_id: Column) -> Column:
    """Board id in an issue-listing request; null for another request."""
    return F.regexp_extract(request_id, "/board/([0-9]+)/issue", 1).try_cast("bigint")


def project_of_request(request_id: Column) -> Column:
    """Project key in a board-listing request."""
    return F.url_decode(F.try_parse_url(request_id, F.lit("QUERY"), F.lit("projectKeyOrId")))


def projects_by_key(projects: DataFrame, keys: list[str] | None) -> DataFrame:
    """Projects whose raw ``key`` is in ``keys``, case-sensitive; no keys means all."""
    if not keys:
        return projects
    return projects.where(F.get_json_object("body", "$.key").isin(*keys))


def projects_in_table(projects: DataFrame, keys: DataFrame) -> DataFrame:
    """The same filter for keys held in a table with a ``key`` column."""
    keyed = projects.withColumn("raw_key", F.get_json_object("body", "$.key"))
    wanted = keys.select(F.col("key").alias("wanted_key"))
    return keyed.join(wanted, F.col("raw_key") == F.col("wanted_key"), "left_semi").drop("raw_key")
