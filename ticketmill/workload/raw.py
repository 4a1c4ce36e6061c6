"""Raw tracker JSON derived from the driver's tables, for queries, tests and the bench.

Every customer is a project with four boards and up to three versions; every
order is an issue and every line item one entry of a board listing, with a
body and a change history of its own. All of it is built row by row from the
tables with one equi-join, so it grows with them and gathers no group. Bad
ids, missing values and odd date forms are spread over it on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.plans.relations import Raw

HOST = "https://tracker.example"
BOARDS_PER_PROJECT = 4
DIMENSIONS = ("projects", "details", "boards")
HISTORY_FIELDS = ("status", "Sprint", "resolution", "Attachment", "assignee", "priority", "Link")
CUSTOM_FIELDS = {
    "type_of_work": "customfield_10100",
    "team": "customfield_10101",
    "story_points": "customfield_10102",
    "sprints": "customfield_10103",
    "flagged": "customfield_10104",
    "nowhere": "customfield_10999",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Dealt out by a unique key over the session's shuffle partitions.

    Table rows grow some twenty-fold when written as JSON, so what one task
    reads is more than one task should write.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, key)


def _text(value: Column) -> Column:
    return value.cast("string")


def _when_mod(value: Column, modulus: int, rest: int) -> Column:
    return value % modulus == rest


def project_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation x region -> ``body`` of one project each."""
    c = F.col("c_custkey")
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = spread(table(spark, sf_dir, "customer"), "c_custkey").join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    category = F.struct(
        F.col("n_nationkey").alias("id"),
        F.concat(F.lit(" "), "n_name").alias("name"),
        F.concat("r_name", F.lit("\n")).alias("description"),
    )
    body = F.struct(
        F.when(_when_mod(c, 24, 23), F.concat(F.lit("x"), _text(c)))
        .otherwise(_text(c))
        .alias("id"),
        F.concat(F.lit("P"), _text(c)).alias("key"),
        F.when(~_when_mod(c, 29, 28), F.concat(F.lit("  "), "c_name", F.lit("\t"))).alias("name"),
        F.when(_when_mod(c, 3, 0), "software")
        .when(_when_mod(c, 3, 1), " business ")
        .alias("projectTypeKey"),
        F.when(~_when_mod(c, 7, 3), _when_mod(c, 7, 0)).alias("archived"),
        F.concat(
            F.lit(f"{HOST}/rest/api/2/project/"),
            _text(c),
            F.when(_when_mod(c, 2, 1), "?expand=lead").otherwise(""),
        ).alias("self"),
        F.when(~_when_mod(c, 6, 5), category).alias("projectCategory"),
    )
    return rows.select(F.to_json(body).alias("body"))


def _version(c: Column, j: Column) -> Column:
    n = c * 10 + j
    day = F.date_add(F.lit("1969-01-01").cast("date"), ((c * 7919 + j * 104729) % 36000).cast("int"))
    form = (c + j) % 4
    written = (
        F.when(_when_mod(c + j, 31, 0), "soon")
        .when(form == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(day, "dd/MMM/yy"))
        .when(form == 2, F.concat(F.date_format(day, "dd/MMM/yy"), F.lit(" 13:45")))
    )
    nine = (c + j) % 9
    archived = (
        F.when(nine == 0, "true").when(nine == 1, "No").when(nine == 8, "maybe")
        .when(nine != 2, "false")
    )
    return F.struct(
        F.when(_when_mod(n, 97, 0), F.concat(F.lit("v"), _text(n))).otherwise(_text(n)).alias("id"),
        F.when((j != 2) | (c % 5 != 0), F.concat(F.lit("v"), _text(j))).alias("name"),
        archived.alias("archived"),
        (j % 2 == 0).alias("released"),
        written.alias("releaseDate"),
        F.when(j != 1, F.date_format(day, "yyyy-MM-dd")).otherwise("").alias("userReleaseDate"),
    )


def detail_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> ``path``, ``body``: lead and 0 to 3 versions; some missing, some empty."""
    c = F.col("c_custkey")
    lead = F.struct(
        F.col("c_name").alias("displayName"),
        F.when(~_when_mod(c, 13, 11), F.concat(F.lit("u"), _text(F.col("c_nationkey")))).alias(
            "key"
        ),
    )
    slots = F.array(*[F.lit(j).cast("bigint") for j in range(3)])
    versions = F.transform(F.slice(slots, 1, (c % 4).cast("int")), lambda j: _version(c, j))
    body = F.struct(
        _text(c).alias("id"),
        F.when(~_when_mod(c, 13, 12), lead).alias("lead"),
        versions.alias("versions"),
    )
    rows = table(spark, sf_dir, "customer").where(~_when_mod(c, 11, 10))
    return rows.select(
        F.concat(F.lit("/rest/api/2/project/"), _text(c)).alias("path"),
        F.when(_when_mod(c, 11, 9), "{}").otherwise(F.to_json(body)).alias("body"),
    )


def board_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> ``project_key``, ``ord``, ``body``: four boards per project."""
    slots = F.array(*[F.lit(k).cast("bigint") for k in range(BOARDS_PER_PROJECT)])
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.explode(slots).alias("k"))
    c, k = F.col("c_custkey"), F.col("k")
    n = c * BOARDS_PER_PROJECT + k
    body = F.struct(
        F.when(_when_mod(n, 53, 52), F.concat(F.lit("b"), _text(n))).otherwise(_text(n)).alias("id"),
        F.when(
            ~_when_mod(c + k, 17, 16), F.concat(F.lit("Board "), _text(k), F.lit(" of "), "c_name")
        ).alias("name"),
        F.when(k % 2 == 1, "kanban").when(k == 0, "scrum").alias("type"),
    )
    return rows.select(
        F.concat(F.lit("P"), _text(c)).alias("project_key"),
        k.alias("ord"),
        F.to_json(body).alias("body"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders: one row per listing entry, with the board that lists it.

    The order's customer is the project; one part in fifty is also listed
    under the next project.
    """
    lines = spread(table(spark, sf_dir, "lineitem"), "l_orderkey").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    own = F.array("o_custkey")
    both = F.array("o_custkey", F.col("o_custkey") + 1)
    owners = F.when(_when_mod(F.col("l_partkey"), 50, 0), both).otherwise(own)
    board = F.col("listed_in") * BOARDS_PER_PROJECT + F.col("l_suppkey") % BOARDS_PER_PROJECT
    # Place in a board's listing. Within one order this sorts by line, part and day.
    days = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date"))
    place = (
        F.col("l_linenumber") * F.lit(10**15) + F.col("l_partkey") * F.lit(10**4) + days
    )
    return (
        lines.withColumn("listed_in", F.explode(owners))
        .withColumn("board_id", board)
        .withColumn("ord", place)
    )


def _iso(instant: Column, form: Column) -> Column:
    """The instant written with a varying kind of offset; form 3 is a bare date."""
    local = instant + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    plain, shifted = "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss"
    return (
        F.when(form == 0, F.concat(F.date_format(instant, plain), F.lit("+0000")))
        .when(form == 1, F.concat(F.date_format(local, plain), F.lit("+05:30")))
        .when(form == 2, F.concat(F.date_format(instant, shifted), F.lit("Z")))
        .otherwise(F.date_format(instant, "yyyy-MM-dd"))
    )


def _utc(instant: Column) -> Column:
    return F.concat(F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000"))


def _item_parts() -> dict[str, Column]:
    """JSON texts that all histories of an entry share: their author, and what an item says behind its field."""
    supplier = _text(F.col("l_suppkey"))
    author = F.struct(
        F.concat(F.lit("S"), supplier).alias("displayName"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("k"), supplier)).alias("key"),
        F.concat(F.lit("s"), supplier).alias("accountId"),
    )
    change = F.struct(
        F.when(F.col("l_suppkey") % 5 == 0, "").otherwise(supplier).alias("from"),
        F.col("l_returnflag").alias("fromString"),
        _text(F.col("l_partkey")).alias("to"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_linestatus")).alias("toString"),
    )
    return {"author_json": F.to_json(author), "change_json": F.to_json(change)}


def _history_parts() -> dict[str, Column]:
    """What every history of an entry repeats, put together once for the entry."""
    change = F.col("change_json")
    rest = F.when(change == "{}", "}").otherwise(F.concat(F.lit(","), F.substr(change, F.lit(2))))
    return {
        "head": F.concat(F.lit('"author":'), F.col("author_json"), F.lit(',"items":[{"field":"')),
        "plain_end": F.concat(F.lit('"'), rest),
        "core_end": F.concat(F.lit('","fieldtype":"core"'), rest),
        "second_end": F.concat(F.lit('","fieldtype":"second"'), rest),
        "ship_text": _utc(F.col("l_shipdate")),
        "ship_day": F.dayofmonth("l_shipdate"),
    }


def _ship_ends() -> dict[str, Column]:
    """The shipping time as text without its day: what stands before the day, and behind it."""
    return {
        "ship_month": F.expr("left(ship_text, length(ship_text) - 20)"),
        "ship_time": F.expr("right(ship_text, 18)"),
    }


def _days_later(i: Column) -> Column:
    """The shipping time ``i`` days later; formatted anew only where the month may be another one."""
    day = F.col("ship_day") + i
    numbers = F.array(*[F.lit(f"{n:02}") for n in range(1, 29)])
    near = F.concat(F.col("ship_month"), F.element_at(numbers, day), F.col("ship_time"))
    return F.when(day.between(1, 28), near).otherwise(_utc(F.timestamp_add("DAY", i, F.col("l_shipdate"))))


def _given(name: str, value: Column, end: str = "") -> Column:
    """A JSON member as text, of a value that needs no escapes; nothing for null, as ``to_json`` does."""
    return F.coalesce(F.concat(F.lit(f'"{name}":'), value, F.lit(end)), F.lit(""))


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _histories() -> Column:
    """The array of an entry's change histories, as JSON text.

    A lambda is interpreted for every element, so the few histories that an
    entry has are written out one by one; only more than these go through one.
    """
    line, order, ship = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_shipdate")
    names = F.array(*[F.lit(name) for name in HISTORY_FIELDS])

    def history(i: Column) -> Column:
        extra = F.when(i == 7, "Link").when(i == 3, "Attachment").otherwise("status")
        has_two = i.isin(3, 7) | ((order + i) % 9 == 0)
        number = F.when((order + i) % 61 != 0, order * 10 + i)
        created = F.when(i != 6, _days_later(i)).otherwise(F.date_format(ship, "yyyy-MM-dd"))
        return F.concat(
            F.lit("{"),
            _given("id", _text(number), ","),
            _given("created", _quoted(created), ","),
            F.col("head"),
            F.element_at(names, i),
            F.when(i != 2, F.col("core_end")).otherwise(F.col("plain_end")),
            F.when(has_two, F.concat(F.lit(',{"field":"'), extra, F.col("second_end"))).otherwise(""),
            F.lit("]}"),
        )

    usual = range(1, len(HISTORY_FIELDS) + 1)
    few = F.concat_ws(",", *[F.when(line >= i, history(F.lit(i))) for i in usual])
    any_number = F.array_join(F.transform(F.sequence(F.lit(1), line), history), ",")
    return F.concat(F.lit("["), F.when(line.between(1, len(usual)), few).otherwise(any_number), F.lit("]"))


def _custom_values() -> dict[str, Column]:
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    choice = F.struct(
        F.when(part % 3 == 0, F.lit("feature")).when(part % 3 == 1, "").alias("value"),
        F.when(part % 2 == 0, F.concat(F.lit("opt"), _text(line))).alias("name"),
        supplier.alias("id"),
    )
    most = len(HISTORY_FIELDS)
    numbered = F.slice(F.array(*[F.lit(f"s{i}") for i in range(1, most + 1)]), 1, line)
    any_number = F.transform(F.sequence(F.lit(1), line), lambda i: F.concat(F.lit("s"), _text(i)))
    sprints = F.when(line.between(1, most), numbered).otherwise(any_number)
    return {
        "customfield_10100": choice,
        "customfield_10101": F.concat(F.lit('Team "'), "l_returnflag", F.lit('"')),
        "customfield_10102": F.col("l_quantity").cast("bigint"),
        "customfield_10103": sprints,
        "customfield_10104": F.when(line % 2 == 0, part % 2 == 0),
        "customfield_10200": F.lit("not mapped"),
    }


def issue_bodies(entries: DataFrame) -> DataFrame:
    """Listing entries -> ``board_id``, ``ord``, ``body`` with change history."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier, state = F.col("l_partkey"), F.col("l_suppkey"), F.col("o_orderstatus")
    status_id = F.when(state == "F", "1").when(state == "O", "2").otherwise("3")
    status = F.struct(
        status_id.cast("bigint").alias("id"),
        state.alias("name"),
        F.struct(
            F.when(state == "P", "None").otherwise(status_id).alias("id"),
            F.concat(F.lit("Cat "), state).alias("name"),
            F.when(state == "F", "green").when(state == "O", "yellow").alias("colorName"),
        ).alias("statusCategory"),
    )
    epic = F.struct(
        supplier.alias("id"),
        F.concat(F.lit("E-"), _text(supplier)).alias("key"),
        F.col("l_returnflag").alias("name"),
        F.when(part % 4 == 0, "").otherwise(F.concat(F.lit("about "), "l_returnflag")).alias("summary"),
        F.when(part % 7 == 0, "yes").when(part % 7 == 1, "False").when(part % 7 == 2, "maybe")
        .alias("done"),
    )
    updated = F.expr("l_shipdate + make_dt_interval(0, l_linenumber, 0, 0)")
    fields = F.struct(
        F.concat(F.lit("Order "), _text(order), F.lit(" line "), _text(line)).alias("summary"),
        F.when(line != 6, F.array("o_orderpriority", F.lit(""), F.lit(None), "l_returnflag")).alias(
            "labels"
        ),
        _iso(F.col("o_orderdate"), order % 4).alias("created"),
        F.when(part % 23 == 0, "yesterday").otherwise(_utc(updated)).alias("updated"),
        status.alias("status"),
        F.struct(
            F.when(line == 7, "abc").otherwise(_text(line)).alias("id"),
            F.concat(F.lit("Type "), _text(line)).alias("name"),
        ).alias("issuetype"),
        F.struct(
            F.substring("o_orderpriority", 1, 1).alias("id"),
            F.expr("substring(o_orderpriority, 3)").alias("name"),
        ).alias("priority"),
        F.when(
            line % 5 == 0,
            F.struct(part.alias("id"), F.concat(F.lit("P-"), _text(part)).alias("key")),
        ).alias("parent"),
        F.when(part % 10 == 0, epic).alias("epic"),
        *[value.alias(name) for name, value in _custom_values().items()],
    )
    issue_id = (
        F.when(order % 43 == 42, "")
        .when(order % 41 == 40, F.concat(F.lit("y"), _text(order)))
        .otherwise(_text(order))
    )
    key = F.when(
        (order % 47 != 46) | (line % 2 == 1),
        F.concat(F.lit("P"), _text(F.col("o_custkey")), F.lit("-"), _text(order)),
    )
    body = F.concat(
        F.lit("{"),
        _given("id", _quoted(issue_id), ","),
        _given("key", _quoted(key), ","),
        F.lit('"fields":'),
        F.to_json(fields),
        F.lit(',"changelog":{'),
        _given("histories", _histories()),
        F.lit("}}"),
    )
    # Read seven times each, so the planner computes these columns once.
    shared = entries.withColumns(_item_parts()).withColumns(_history_parts()).withColumns(_ship_ends())
    return shared.select("board_id", "ord", body.alias("body"))


def raw(spark: SparkSession, sf_dir: str) -> Raw:
    return Raw(
        projects=project_bodies(spark, sf_dir),
        details=detail_bodies(spark, sf_dir),
        boards=board_bodies(spark, sf_dir),
        issues=issue_bodies(listing(spark, sf_dir)),
    )


def _page(request: Column, start_at: Column, payload: str, total: Column | None = None) -> Column:
    announced = F.concat(F.lit(',"total":'), _text(total)) if total is not None else F.lit("")
    return F.concat(
        F.lit('{"request_id":"'),
        request,
        F.lit('","startAt":'),
        _text(start_at),
        announced,
        F.lit(f',"{payload}":['),
        F.col("body"),
        F.lit("]}"),
    ).alias("value")


def issue_page_texts(bodies: DataFrame) -> DataFrame:
    """One page envelope (JSON text) per listing entry."""
    request = F.concat(F.lit("/rest/agile/1.0/board/"), _text(F.col("board_id")), F.lit("/issue"))
    return bodies.select(_page(request, F.col("ord"), "issues"))


def land_dimensions(
    spark: SparkSession, sf_dir: str, uri: str, names: tuple[str, ...] = DIMENSIONS
) -> None:
    """Landing files of projects, details and boards, one response per line."""
    projects = project_bodies(spark, sf_dir).select(
        _page(F.lit("/rest/api/2/project"), F.lit(0), "values")
    )
    details = detail_bodies(spark, sf_dir).select(
        F.concat(
            F.lit('{"request_id":"'), "path", F.lit('","body":'), "body", F.lit("}")
        ).alias("value")
    )
    request = F.concat(F.lit("/rest/agile/1.0/board?projectKeyOrId="), "project_key")
    total = F.lit(BOARDS_PER_PROJECT)
    boards = board_bodies(spark, sf_dir).select(_page(request, F.col("ord"), "values", total))
    for name, texts in zip(DIMENSIONS, (projects, details, boards), strict=True):
        if name in names:
            texts.write.mode("append").text(f"{uri}/{name}")


def land(spark: SparkSession, sf_dir: str, uri: str) -> str:
    """The whole raw input as landing files under ``uri``."""
    land_dimensions(spark, sf_dir, uri)
    bodies = issue_bodies(listing(spark, sf_dir))
    issue_page_texts(bodies).write.text(f"{uri}/issues", compression="gzip")
    return uri
