"""The registered queries: every operator run over the driver's tables.

Each takes (spark, sf_dir) and returns a frame whose columns the oracle SQL
names alike. Instants come out as epoch micros (BIGINT).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill import functions as X
from ticketmill.operators import issues as issue_ops
from ticketmill.operators import transitions as transition_ops
from ticketmill.operators.dedupe import first_places, only_first_places
from ticketmill.operators.projects import project_details
from ticketmill.params import RunParams
from ticketmill.plans.pipeline import run
from ticketmill.plans.relations import Relations, board_items, build, issue_items, summary
from ticketmill.schemas import DATA_TYPES
from ticketmill.sinks import tables
from ticketmill.sinks.files import write_run
from ticketmill.sources import pages, runs, storage
from ticketmill.streaming.ingest import first_seen, run_stream
from ticketmill.workload import raw as W

Query = Callable[[SparkSession, str], DataFrame]
SUFFIX = "20240601"
START, END = "1996-01-01", "1999-12-31"


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name)).alias(f"{name}_us")


def _flat_times(df: DataFrame) -> DataFrame:
    """Time columns as micros, maps dropped: the form both engines compare."""
    kinds = dict(df.dtypes)
    kept = [name for name in df.columns if not kinds[name].startswith("map")]
    return df.select(*[_micros(n) if kinds[n] == "timestamp" else F.col(n) for n in kept])


def _built(spark: SparkSession, sf_dir: str, **options: object) -> Relations:
    return build(W.raw(spark, sf_dir), **options)


def _relation(name: str, **options: object) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Wide rows are staged and chosen by their keys; others are cheaper to plan as they are.
        made = _staged if name in ("issues", "transitions") else _built
        return _flat_times(made(spark, sf_dir, data_types=[name], one_copy=True, **options)[name])

    return query


def _staged(spark: SparkSession, sf_dir: str, **options: object) -> Relations:
    return _built(spark, sf_dir, stage=_stage(spark), **options)


def _stage(spark: SparkSession) -> storage.Stage:
    return storage.stage_in(spark, storage.work_folder(spark, "query"))


def _records(named: dict[str, DataFrame]) -> DataFrame:
    return summary(named)


# --- pages ------------------------------------------------------------------

REQUEST_SIZE, PAGE_SIZE = 600, 150


def _order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> page envelopes as JSON text: 600 orders a request, 150 a page.

    The page is arithmetic on the unique order key, so a group holds at most
    150 rows. Requests end in four ways: announced total reached, last-page
    flag, an empty page, a total smaller than what is there.
    """
    key = F.col("o_orderkey")
    slots = W.spread(W.table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.floor(key / REQUEST_SIZE).alias("request"),
        F.floor((key % REQUEST_SIZE) / PAGE_SIZE).alias("page"),
        F.to_json(
            F.struct(key.cast("string").alias("id"), F.col("o_orderstatus").alias("state"))
        ).alias("item"),
        key.alias("place"),
    )
    gathered = slots.groupBy("request", "page").agg(
        F.array_sort(F.collect_list(F.struct("place", "item"))).alias("entries")
    )
    kind = F.col("request") % 4
    texts = F.transform("entries", lambda entry: entry.getField("item"))
    emptied = (kind == 2) & (F.col("page") == 1)
    body = F.when(emptied, "").otherwise(F.array_join(texts, ","))
    return gathered.select(
        "request",
        "page",
        F.concat(
            F.lit('{"request_id":"/rest/agile/1.0/board/'),
            F.col("request").cast("string"),
            F.lit('/issue?expand=changelog","maxResults":150,"startAt":'),
            (F.col("page") * PAGE_SIZE).cast("string"),
            F.when(kind == 0, ',"total":600').when(kind == 3, ',"total":300').otherwise(""),
            F.when((kind == 1) & (F.col("page") == 2), ',"isLast":true').otherwise(""),
            F.lit(',"issues":['),
            body,
            F.lit("]}"),
        ).alias("text"),
    )


def s1_paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = _stage(spark)
    read = pages.paged_items(stage(pages.parse_pages(_order_pages(spark, sf_dir), "text"), "pages"), stage)
    return read.select(
        pages.board_of_request(F.col("request_id")).alias("request"),
        (F.col("ord.start_at") + F.col("ord.pos")).alias("place"),
        F.get_json_object("body", "$.id").alias("item"),
    )


def s1b_page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages lost in the middle, last pages lost that carry the flag, and pages that overlap."""
    request, page = F.col("request"), F.col("page")
    lost = ((request % 5 == 0) & (page == 1)) | ((request % 12 == 1) & (page == 2))
    landed = pages.parse_pages(_order_pages(spark, sf_dir).where(~lost), "text")
    board, start = pages.board_of_request(F.col("request_id")), F.col("start_at")
    overlaps = (board % 7 == 0) & (start == 3 * PAGE_SIZE)
    audit = pages.audit_pages(landed.withColumn("start_at", F.when(overlaps, start - 50).otherwise(start)))
    return audit.withColumn("request", pages.board_of_request(F.col("request_id"))).drop(
        "request_id"
    )


def _cut_short(texts: DataFrame) -> DataFrame:
    """Every sixth request's third page as a line whose end is missing."""
    torn = (F.col("request") % 6 == 0) & (F.col("page") == 2)
    short = F.expr("substring(text, 1, length(text) - 9)")
    return texts.withColumn("text", F.when(torn, short).otherwise(F.col("text")))


def s1_torn_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON are rejects; the other pages' items stay."""
    landed = pages.parse_pages(_cut_short(_order_pages(spark, sf_dir)), "text")
    read = pages.paged_items(landed).select(
        F.lit("item").alias("kind"),
        pages.board_of_request(F.col("request_id")).alias("request"),
        F.get_json_object("body", "$.id").alias("value"),
    )
    torn = pages.torn_rejects(landed).select(
        F.lit("torn").alias("kind"),
        pages.board_of_request(F.col("raw")).alias("request"),
        F.col("reason").alias("value"),
    )
    return read.unionByName(torn)


def t4_stop_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop rule over two arrivals: pages 0 and 1 of each request, then the others."""
    texts = _order_pages(spark, sf_dir)
    first = pages.parse_pages(texts.where("page <= 1"), "text")
    second = pages.parse_pages(texts.where("page > 1"), "text")
    read = pages.paged_items(first).unionByName(
        pages.paged_items(second, earlier=pages.ledger(first))
    )
    return read.select(
        pages.board_of_request(F.col("request_id")).alias("request"),
        (F.col("ord.start_at") + F.col("ord.pos")).alias("place"),
        F.get_json_object("body", "$.id").alias("item"),
    )


def s2_projects_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = W.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING")
    wanted = keys.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("key"))
    found = pages.projects_in_table(W.project_bodies(spark, sf_dir), wanted)
    return found.select(
        F.get_json_object("body", "$.id").alias("id"), F.get_json_object("body", "$.key").alias("key")
    )


def s3_project_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = project_details(W.project_bodies(spark, sf_dir), W.detail_bodies(spark, sf_dir))
    return joined.select(
        F.col("id").alias("entity_id"),
        "key",
        "path",
        F.col("lead.displayName").alias("lead_name"),
        F.size("versions").cast("bigint").alias("versions"),
    )


def s4_boards_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = F.concat(F.lit("/rest/agile/1.0/board?projectKeyOrId="), "project_key")
    texts = W.board_bodies(spark, sf_dir).select(
        W._page(request, F.col("ord"), "values", F.lit(W.BOARDS_PER_PROJECT))
    )
    stage = _stage(spark)
    found = board_items(stage(pages.parse_pages(texts, "value"), "pages"), stage)
    return found.select(
        "project_key",
        F.col("ord.start_at").alias("place"),
        F.get_json_object("body", "$.id").alias("board"),
    )


def s5_issues_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = W.issue_page_texts(W.issue_bodies(W.listing(spark, sf_dir)))
    stage = _stage(spark)
    found = issue_items(stage(pages.parse_pages(texts, "value"), "pages"), stage)
    parsed = issue_ops.parse_issues(found, details=False, histories=False)
    flat = issue_ops.flatten_issues(parsed)
    inside = issue_ops.in_date_range(F.col("created"), F.col("updated"), START, END)
    return flat.where(inside).select("board_id", "issue_ref", _micros("updated"))


def _identities(relations: dict[str, DataFrame]) -> DataFrame:
    def text(*names: str) -> Column:
        return F.concat_ws("/", *[F.col(name).cast("string") for name in names])

    keys = {
        "projects": text("id"),
        "releases": text("project_id", "release_id"),
        "boards": text("project_id", "board_id"),
        "issues": text("project_id", "id"),
        "transitions": text("issue_id", "transition_id", "transition_field"),
    }
    parts = [
        df.select(F.lit(name).alias("data_type"), keys[name].alias("entity"))
        for name, df in relations.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def s6_run_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identities(_staged(spark, sf_dir).as_dict())


def f3_selected_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identities(_built(spark, sf_dir, data_types="boards, releases").as_dict())


# --- filters and projections -------------------------------------------------


def f1_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _built(spark, sf_dir, data_types=["issues"], start_date=START, end_date=END, issue_keys_only=True)
    return chosen["issues"].select("id", "project_id", _micros("created"), _micros("updated"))


def _parsed(spark: SparkSession, sf_dir: str, **needs: bool | tuple[str, ...]) -> DataFrame:
    return issue_ops.parse_issues(W.issue_bodies(W.listing(spark, sf_dir)), **needs)


def f4_tracked_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    histories = _parsed(spark, sf_dir, details=False, history_keys_only=True).select(F.explode("changelog.histories").alias("h"))
    kept = histories.select(F.explode(transition_ops.tracked_items(F.col("h.items"))).alias("i"))
    return kept.groupBy(F.col("i.field").alias("field")).agg(F.count("*").alias("items"))


def f5_history_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = F.col("changelog.histories")
    sizes = _parsed(spark, sf_dir, details=False, history_keys_only=True).select(
        "board_id",
        F.size(every).alias("all"),
        F.size(transition_ops.numbered(every)).alias("kept"),
    )
    return sizes.groupBy("board_id").agg(
        F.sum("all").alias("histories"), F.sum("kept").alias("kept")
    )


def f6_issue_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = issue_ops.flatten_issues(_parsed(spark, sf_dir, details=False, histories=False))
    named = flat.where(F.col("issue_ref").isNotNull())
    return named.groupBy("board_id", "issue_ref").agg(F.count("*").alias("entries"))


def p6_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = issue_ops.flatten_issues(_parsed(spark, sf_dir, details=("labels",), histories=False))
    return flat.groupBy("board_id", "labels").agg(F.count("*").alias("entries"))


def p7_custom_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _staged(spark, sf_dir, data_types=["issues"], custom_fields=W.CUSTOM_FIELDS, one_copy=True)["issues"]
    return found.select(
        "id",
        "project_id",
        *[F.col("custom_fields")[name].alias(name) for name in W.CUSTOM_FIELDS],
    )


def p8_assignee_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _built(spark, sf_dir, data_types=["transitions"], transition_fields=["assignee"])["transitions"]
    people = found.where(F.col("transition_field") == "assignee")
    return people.select(
        "transition_id", "issue_id", "from_id", "from_string", "to_id", "to_string"
    )


def p9_issue_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _built(spark, sf_dir, data_types=["issues"], issue_keys_only=True)["issues"]
    return found.select("id", "key", "project_id", "project_key", "project_name")


# --- validation ---------------------------------------------------------------


def _good_ids(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = _built(spark, sf_dir, data_types=[name], transition_keys_only=True, issue_keys_only=True)
        return _identities({name: chosen[name]}).drop("data_type")

    return query


def v_rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _staged(spark, sf_dir).rejects()
    return rejected.groupBy("relation", "reason").agg(F.count("*").alias("rejects"))


def v_rejected_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = _built(spark, sf_dir, data_types=["issues"], issue_keys_only=True).rejects()
    return chosen.where(F.col("relation") == "issues").select(
        F.coalesce("entity_id", F.lit("")).alias("entity_id"),
        "reason",
        F.get_json_object("raw", "$.fields.summary").alias("summary"),
    )


def v_rejected_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second items of a history whose field type is an explicit null on the wire."""
    source = W.raw(spark, sf_dir)
    nulled = F.regexp_replace("body", '"fieldtype":"second"', '"fieldtype":null')
    source = replace(source, issues=source.issues.withColumn("body", nulled))
    built = build(source, data_types=["transitions"], stage=_stage(spark), one_copy=True)
    rejected = built.rejects().where(F.col("relation") == "transitions")
    return rejected.select("entity_id", "reason", F.get_json_object("raw", "$.field").alias("field"))


def v_nulled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad nested ids and bad times that became null without rejecting the row."""
    read = ("issuetype", "status", "parent")
    flat = issue_ops.flatten_issues(_parsed(spark, sf_dir, details=read, histories=False))

    def nulls(name: str) -> Column:
        return F.count(F.when(F.col(name).isNull(), 1)).alias(name)

    names = ["issuetype_id", "status_category_id", "parent_task_id", "created", "updated"]
    return flat.groupBy("issue_type").agg(*[nulls(name) for name in names])


# --- dedupe, summaries, keyed load --------------------------------------------


def j3_first_board_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, stage = W.raw(spark, sf_dir), _stage(spark)
    good_boards = build(source, data_types=["boards"], stage=stage).checked["boards"].where("reason IS NULL")
    flat = issue_ops.flatten_issues(issue_ops.parse_issues(source.issues)).where(F.col("issue_ref").isNotNull())
    flat = stage(flat.withColumn("entry", F.monotonically_increasing_id()), "entries")
    listed = issue_ops.list_issues(flat, good_boards).withColumn("place", F.struct("board_ord", "ord", "entry"))
    repeated = stage(first_places(listed.select("project_id", "issue_ref", "place")), "repeated")
    return only_first_places(listed, repeated).select("project_id", "issue_ref", "board_id", "ord", "summary")


def l3_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged(spark, sf_dir, data_types=["transitions"]).loadable()["transitions"]
    return absent_transitions(spark, sf_dir, batch)


def absent_transitions(spark: SparkSession, sf_dir: str, batch: DataFrame) -> DataFrame:
    """Loadable transitions that a target made of earlier line items lacks."""
    early = W.table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") < "1998-06-01")
    target = early.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transition_id"),
        F.col("l_orderkey").alias("issue_id"),
        F.element_at(
            F.array(*[F.lit(name) for name in W.HISTORY_FIELDS]), F.col("l_linenumber")
        ).alias("transition_field"),
    )
    fresh = tables.absent_rows(
        batch, target, tables.KEYS["transitions"], tables.LOAD_ORDER["transitions"]
    )
    return fresh.select(
        "transition_id", "issue_id", "transition_field", "project_id", "from_string", "to_id"
    )


def a1_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(_staged(spark, sf_dir))


def _database(spark: SparkSession) -> str:
    """A new database in the shared work folder."""
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{storage.work_folder(spark, 'db')}'")
    return name


def a2_load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the same rows: the second one inserts nothing."""
    database = _database(spark)
    relations = _staged(spark, sf_dir).loadable()
    tables.ensure_tables(spark, database)
    first = tables.load_summary(spark, tables.load_all(relations, database))
    again = tables.load_summary(spark, tables.load_all(relations, database))
    return first.join(again.withColumnRenamed("inserted", "inserted_again"), "data_type")


def u3_align_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = W.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_mktsegment"
    )
    suppliers = W.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")
    )
    parts = W.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_type")
    return tables.align(customers, suppliers, parts)


# --- files --------------------------------------------------------------------


def _outbox(spark: SparkSession) -> str:
    return storage.work_folder(spark, "out")


def _readback(fmt: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        uri = _outbox(spark)
        chosen = _staged(
            spark, sf_dir, data_types=["issues"], custom_fields=W.CUSTOM_FIELDS
        ).as_dict()
        write_run(chosen, uri, SUFFIX, fmt)
        back = runs.read_run(spark, uri, "issues", SUFFIX, fmt)
        custom = [F.col("custom_fields")[name].alias(name) for name in ("team", "sprints")]
        return _flat_times(back.select("*", *custom))

    return query


def _small(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return _staged(spark, sf_dir, data_types=list(names)).as_dict()


def _none(relations: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    return {**relations, name: relations[name].where(F.lit(False))}


def s8_bulk_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    write_run(_none(_small(spark, sf_dir, "projects", "releases", "boards"), "boards"), uri, SUFFIX)
    return _records(runs.bulk_prefixes(spark, uri, SUFFIX))


def k4_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    relations = _small(spark, sf_dir, "projects", "boards")
    write_run(relations, uri, SUFFIX)
    write_run({"boards": relations["boards"]}, uri, "20240602")
    parts = [
        runs.read_runs(spark, uri, name).select(F.lit(name).alias("data_type"), "run")
        for name in relations
    ]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("data_type", "run").agg(F.count("*").alias("records"))


def k5_append_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    relations = _small(spark, sf_dir, "projects", "boards")
    write_run(relations, uri, SUFFIX)
    write_run({"boards": relations["boards"]}, uri, SUFFIX, mode="append")
    return _identities(runs.bulk_prefixes(spark, uri, SUFFIX))


def k6_replace_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    relations = _small(spark, sf_dir, "projects", "releases", "boards")
    write_run(relations, uri, SUFFIX)
    archived = relations["projects"].where("archived")
    write_run(_none({**relations, "projects": archived}, "releases"), uri, SUFFIX, swap=True)
    return _identities(runs.bulk_prefixes(spark, uri, SUFFIX))


def k7_part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    write_run(_small(spark, sf_dir, "boards"), uri, SUFFIX, max_rows=100)
    back = runs.read_run(spark, uri, "boards", SUFFIX)
    sizes = back.groupBy(F.col("_metadata.file_path").alias("part")).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.sum("n").alias("records"), F.count(F.when(F.col("n") > 100, 1)).alias("oversize")
    )


def k8_typed_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    releases = _small(spark, sf_dir, "releases")["releases"]
    blanked = releases.drop("release_date", "project_key").withColumn("released", F.lit(None))
    write_run({"releases": blanked}, uri, SUFFIX)
    # Read without a schema: the types are those in the files.
    back = spark.read.parquet(f"{uri}/releases/releases_{SUFFIX}")
    names = ["release_date", "project_key", "released"]
    kinds = [F.typeof(name).alias(f"{name}_type") for name in names]
    return back.groupBy(*kinds).agg(
        F.count("*").alias("records"), *[F.count(name).alias(f"{name}_filled") for name in names]
    )


def k9_empty_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    write_run(_small(spark, sf_dir, "issues"), uri, SUFFIX)
    back = runs.read_run(spark, uri, "issues", SUFFIX)
    return back.agg(F.count("*").alias("records"), F.count("custom_fields").alias("filled"))


def k10_empty_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = _outbox(spark)
    relations = _small(spark, sf_dir, "projects", "releases")
    write_run(_none(relations, "releases"), uri, SUFFIX)
    write_run({"projects": _none(relations, "projects")["projects"]}, uri, SUFFIX, mode="append")
    written = set(runs.written_types(spark, uri, SUFFIX))
    parts = [
        runs.read_run(spark, uri, name, SUFFIX).agg(
            F.lit(name).alias("data_type"),
            F.lit(name in written).alias("has_parts"),
            F.count("*").alias("records"),
        )
        for name in DATA_TYPES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def r1_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run: build, write JSON Lines, load tables, read tables back; and its rejects."""
    database = _database(spark)
    params = RunParams(
        _outbox(spark), SUFFIX, "jsonl", database=database, swap=True, prefix="own_",
        custom_as="variant", keep_rejects=True,
    )
    result = run(spark, W.raw(spark, sf_dir), params)
    loaded = {name: spark.table(tables.table_name(name, database, "own_")) for name in DATA_TYPES}
    good = result.summary.join(
        summary(loaded).withColumnRenamed("records", "in_table"), "data_type"
    ).select("data_type", F.lit(None).cast("string").alias("reason"), "records", "in_table")
    dropped = result.rejects.select(
        F.col("relation").alias("data_type"), "reason", "records", F.lit(0).cast("bigint").alias("in_table")
    )
    return good.unionByName(dropped)


# --- tables -------------------------------------------------------------------


def l1_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed tables with a semi-structured column; creating them twice is harmless."""
    database = _database(spark)
    chosen = _staged(
        spark, sf_dir, data_types=["issues"], custom_fields=W.CUSTOM_FIELDS
    ).loadable()
    for _ in range(2):
        tables.ensure_tables(spark, database, custom_as="variant", widths=True, buckets=8)
    tables.load_all(chosen, database)
    found = spark.table(tables.table_name("issues", database))
    return found.select(
        "id",
        "project_id",
        F.try_variant_get("custom_fields", "$.team", "string").alias("team"),
        F.try_variant_get("custom_fields", "$.story_points", "bigint").alias("story_points"),
        F.typeof("id").alias("id_type"),
        F.typeof("custom_fields").alias("custom_type"),
    )


def l4_plain_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _database(spark)
    tables.ensure_tables(spark, database)
    relations = _small(spark, sf_dir, "boards")
    for _ in range(2):
        tables.load_all(relations, database, "plain")
    found = spark.table(tables.table_name("boards", database))
    return found.groupBy("board_id", "name").agg(F.count("*").alias("copies"))


def l5_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _built(spark, sf_dir, data_types=["issues"], issue_keys_only=True).checked["issues"]
    lacking = tables.missing_required(every, "issues")
    return lacking.groupBy("missing_column").agg(F.count("*").alias("records"))


def l6_bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk loads of a written run, twice: no key is looked at."""
    uri, database = _outbox(spark), _database(spark)
    tables.ensure_tables(spark, database, custom_as="json")
    write_run(_staged(spark, sf_dir, custom_fields=W.CUSTOM_FIELDS).as_dict(), uri, SUFFIX)
    wanted = ["issues", "transitions"]
    tables.bulk_load(spark, uri, SUFFIX, wanted, database)
    counts = tables.bulk_load(spark, uri, SUFFIX, wanted, database)
    loaded = {name: spark.table(tables.table_name(name, database)) for name in DATA_TYPES}
    return summary(loaded).join(tables.load_summary(spark, counts), "data_type")


# --- scalar functions ----------------------------------------------------------


def x_hash_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = W.table(spark, sf_dir, "documents")
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return docs.select("doc_id", X.pii_hash(F.col("text"), source).alias("hashed"))


def x_safe_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = W.table(spark, sf_dir, "orders")
    some = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey"))
    return orders.select("o_orderkey", X.safe_str(some).alias("text"))


def x_safe_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = W.table(spark, sf_dir, "lineitem")
    part = F.col("l_partkey").cast("string")
    form = (F.col("l_orderkey") + F.col("l_linenumber")) % 9
    text = (
        F.when(form == 0, F.concat(F.lit("  "), part, F.lit(" ")))
        .when(form == 1, F.concat(part, F.lit(".9")))
        .when(form == 2, "")
        .when(form == 3, "None")
        .when(form == 4, F.concat(F.lit("-"), part))
        .when(form == 5, F.concat(part, F.lit("99999999999999999999")))
        .when(form == 6, F.concat(F.lit("+"), part))
        .when(form == 7, F.concat(F.lit("n"), part))
    )
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", X.safe_int(text).alias("number")
    )


def x_safe_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = ["true", "TRUE", "1", "Yes", "false", "False", "0", "NO", "maybe", "t"]
    events = W.table(spark, sf_dir, "events")
    slot = (F.col("event_id") % 11).cast("int")
    word = F.when(slot < 10, F.element_at(F.array(*[F.lit(w) for w in words]), slot + 1))
    return events.select("event_id", X.safe_bool(word).alias("flag"))


def x_clean_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = W.table(spark, sf_dir, "conversations")
    padded = F.concat(F.lit(" \t \x1f"), F.col("text"), F.lit("\n  \r\n"))
    nested = talks.select(
        "conv_id",
        "turn",
        F.struct(
            padded.alias("text"),
            F.struct(F.array(F.lit(" a "), F.col("role"), padded).alias("list")).alias("inner"),
        ).alias("doc"),
    )
    cleaned = X.clean_ws(F.col("doc"), nested.schema["doc"].dataType)
    return nested.select(
        "conv_id",
        "turn",
        cleaned["text"].alias("text"),
        F.array_join(cleaned["inner"]["list"], "|").alias("joined"),
    )


def x_release_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = W.table(spark, sf_dir, "orders")
    day = F.date_add(
        F.lit("1969-01-01").cast("date"), ((F.col("o_orderkey") * 37) % 36500).cast("int")
    )
    form = F.col("o_orderkey") % 5
    text = (
        F.when(form == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(day, "dd/MMM/yy"))
        .when(form == 2, F.concat(F.date_format(day, "d/MMM/yy"), F.lit(" 7:05")))
        .when(form == 3, F.date_format(day, "MM-dd-yyyy"))
        .otherwise("")
    )
    return orders.select("o_orderkey", F.unix_micros(X.release_date(text)).alias("date_us"))


def x_iso_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = W.table(spark, sf_dir, "events")
    # The tables' times carry no zone; as written they are UTC.
    form = F.col("event_id") % 6
    six = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    whole = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(form == 0, F.concat(six, F.lit("+0000")))
        .when(form == 1, F.concat(six, F.lit("-03:30")))
        .when(form == 2, F.concat(whole, F.lit("Z")))
        .when(form == 3, whole)
        .when(form == 4, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0545")))
    )
    return events.select("event_id", F.unix_micros(X.iso_ts(text)).alias("ts_us"))


def x_first_truthy(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = W.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    first = F.when(key % 3 == 0, F.col("p_name")).when(key % 3 == 1, "")
    second = F.when(key % 5 == 0, "").otherwise(F.col("p_brand"))
    return part.select("p_partkey", X.first_truthy(first, second).alias("picked"))


def x_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = W.table(spark, sf_dir, "events")
    kept = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    value = F.create_map(F.lit("kind"), kept, F.lit("user"), F.col("user_id").cast("string"))
    some = F.when(F.col("event_id") % 7 != 0, value)
    return events.select("event_id", X.json_text(some).alias("json"))


def x_parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = W.table(spark, sf_dir, "events")
    text = F.when(F.col("event_id") % 5 == 0, F.lit('{"k": ')).otherwise(F.col("props"))
    value = X.semi_structured(text)
    return events.select("event_id", F.try_variant_get(value, "$.k", "bigint").alias("k"))


# --- streaming ------------------------------------------------------------------


# The board places of every project that land together.
ARRIVALS = ((0, 1), (2, 3))


def _land_boards(spark: SparkSession, sf_dir: str, uri: str, places: tuple[int, ...]) -> None:
    """Land the issue pages of every project's boards at these places."""
    place = F.col("board_id") % W.BOARDS_PER_PROJECT
    entries = W.listing(spark, sf_dir).where(place.isin(*places))
    texts = W.issue_page_texts(W.issue_bodies(entries))
    texts.write.mode("append").text(f"{uri}/issues", compression="gzip")


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Two arrivals of pages, each followed by the query's next run. Earlier
    boards arrive first, so the outcome is that of a batch."""
    landing, out = storage.work_folder(spark, "landing"), _outbox(spark)
    checkpoint = storage.work_folder(spark, "stream")
    W.land_dimensions(spark, sf_dir, landing)
    params = RunParams(out, SUFFIX)
    for places in ARRIVALS:
        _land_boards(spark, sf_dir, landing, places)
        run_stream(spark, landing, params, checkpoint).awaitTermination()
    return out


def t1_stream_matches_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _streamed(spark, sf_dir)
    return _identities({name: runs.read_run(spark, out, name, SUFFIX) for name in DATA_TYPES})


def t1_stream_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole issue rows, of entries that landed before any board had."""
    landing, out = storage.work_folder(spark, "landing"), _outbox(spark)
    checkpoint, params = storage.work_folder(spark, "stream"), RunParams(out, SUFFIX)
    W.land_dimensions(spark, sf_dir, landing, names=("projects", "details"))
    storage.make_folder(spark, f"{landing}/boards")
    _land_boards(spark, sf_dir, landing, (0, 1))
    run_stream(spark, landing, params, checkpoint).awaitTermination()
    W.land_dimensions(spark, sf_dir, landing, names=("boards",))
    _land_boards(spark, sf_dir, landing, (2, 3))
    run_stream(spark, landing, params, checkpoint).awaitTermination()
    return _flat_times(runs.read_run(spark, out, "issues", SUFFIX))


def t2_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (project, issue) pairs of a page stream, state kept across batches."""
    landing, out = storage.work_folder(spark, "landing"), _outbox(spark)
    for places in ARRIVALS:
        _land_boards(spark, sf_dir, landing, places)
    found = pages.items(pages.stream_pages(spark, f"{landing}/issues", files_per_batch=8)).select(
        pages.board_of_request(F.col("request_id")).alias("board_id"),
        F.get_json_object("body", "$.id").alias("issue_ref"),
    )
    boards = _staged(spark, sf_dir, data_types=["boards"])["boards"]
    owned = found.join(boards.select("board_id", "project_id"), "board_id").drop("board_id")
    query = (
        first_seen(owned, ["project_id", "issue_ref"], lanes=4)
        .writeStream.format("parquet")
        .option("checkpointLocation", storage.work_folder(spark, "stream"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


def t3_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages streamed twice from scratch into one set of tables."""
    database, landing = _database(spark), storage.work_folder(spark, "landing")
    W.land(spark, sf_dir, landing)
    for _ in range(2):
        params = RunParams(_outbox(spark), SUFFIX, database=database)
        checkpoint = storage.work_folder(spark, "stream")
        run_stream(spark, landing, params, checkpoint).awaitTermination()
    return summary({name: spark.table(tables.table_name(name, database)) for name in DATA_TYPES})


def queries() -> dict[str, Query]:
    named = [
        s1_paged_scan, s1_torn_pages, s1b_page_audit, s2_projects_by_key, s3_project_details, s4_boards_scan,
        s5_issues_scan, s6_run_relations, s8_bulk_prefixes, f1_date_range, f3_selected_relations,
        f4_tracked_fields, f5_history_id, f6_issue_id, p6_labels, p7_custom_fields,
        p8_assignee_mask, p9_issue_project, v_rejects_by_reason, v_rejected_issues, v_rejected_transitions,
        v_nulled_values, j3_first_board_wins, l3_insert_if_absent, a1_run_summary,
        a2_load_summary, u3_align_columns, k4_layout, k5_append_run, k6_replace_run,
        k7_part_sizes, k8_typed_nulls, k9_empty_custom, k10_empty_type, r1_run, l1_tables,
        l4_plain_insert, l5_required_columns, l6_bulk_load, x_hash_pii, x_safe_str, x_safe_int,
        x_safe_bool, x_clean_ws, x_release_date, x_iso_ts, x_first_truthy, x_to_json,
        x_parse_json, t1_stream_matches_batch, t1_stream_issues, t2_stream_dedupe, t3_replay,
        t4_stop_across_batches,
    ]
    out: dict[str, Query] = {query.__name__: query for query in named}
    for place, name in enumerate(DATA_TYPES, start=1):
        out[f"p{place}_{name}"] = _relation(name)
        out[f"v_{name}_good"] = _good_ids(name)
    for fmt in ("parquet", "csv", "jsonl"):
        out[f"s7_readback_{fmt}"] = _readback(fmt)
    return out


