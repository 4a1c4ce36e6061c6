"""WARC archives with a Merkle fixity audit of their replicas.

An archive's records lie in files one behind the other, in the order of their
pages. What is staged and moved of a record is its digest, taken while the pages
are read, with its file and offset range; the record itself is not.

A replica's tree has a leaf for each page id. A leaf is hashed from its records'
URLs and digests, every run of FANOUT neighbouring ids is hashed again from the
hashes below it, and so on to one root; every node has the offset range that it
covers in its replica. So a tree depends on the records and not on the places
that they have got, and a replica that has lost one record, and has been archived
on its own, differs from the first in one leaf and what is above it. Two replicas
with equal roots are equal. Where the roots differ, only the children of nodes
that differ are compared, level by level, down to the records: what is read of
the lower levels follows the damage and not the archive.

A leaf is an aggregate that is combined before the shuffle, so one id with a third
of all rows is no hot key; a node has at most FANOUT children. Levels are staged
tables; only counts come to the driver, one for each level.

Defined results: records are in the order of page id (nulls last), URL and
content; a null URL or page is an empty one, and rows without a page id share one
leaf; repeated rows are records of their own. Of the records of one page id and
URL, equal ones are matched first, then the others in the order of their digests:
a record with a different partner is ``altered``, one that a replica lacks
``missing``, one that only the replica has ``added``. Two empty archives have no
differences; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.common import staged, with_ordinal

#: Records in one file, and children of one node.
FILE_RECORDS = 1000
FANOUT = 16
#: When the pages were read, for tables that don't say it.
DATE = "2024-01-01T00:00:00Z"


def _record(page_id: Column, url: Column, html: Column, date: str) -> Column:
    """The record's bytes: header lines, an empty line, the page, two empty lines."""
    lines = [
        F.lit("WARC/1.0"),
        F.lit("WARC-Type: resource"),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(html).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n")).cast("binary")


def records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE
) -> DataFrame:
    """``page_id``, ``url`` and ``record``, the bytes of each page's WARC record; nothing is moved."""
    url, html = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (url_col, html_col))
    page_id = F.col(id_col).cast("bigint")
    return pages.select(page_id.alias("page_id"), url.alias("url"), _record(page_id, url, html, date).alias("record"))


def archive(
    spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE
) -> DataFrame:
    """``at`` (place in the archive), ``warc_file``, ``start`` (offset), ``length``, ``page_id``, ``url`` and ``digest``, staged."""
    rows = records(pages, id_col, url_col, html_col, date)
    rows = rows.select("page_id", "url", F.sha2("record", 256).alias("digest"), F.length("record").cast("bigint").alias("length"))
    placed = with_ordinal(spark, rows, ["page_id", "url", "digest"], "at", "records")
    placed = placed.withColumn("warc_file", F.floor(F.col("at") / FILE_RECORDS))
    # A file has FILE_RECORDS records at most.
    before = Window.partitionBy("warc_file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("start")
    return staged(spark, placed.select("at", "warc_file", start, "length", "page_id", "url", "digest"), "archive")


def _range() -> list[Column]:
    """The first and the last place that a node covers."""
    return [F.min("from").alias("from"), F.max("to").alias("to")]


def height_of(*listings: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the leaves until only negative ids, the others and null are left."""
    tops = [listed.agg(F.max(F.abs("page_id"))).first()[0] or 0 for listed in listings]
    height = 0
    while fanout**height <= max(tops, default=0):
        height += 1
    return height


def tree(spark: SparkSession, listed: DataFrame, height: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of a replica's tree, leaves first: ``node``, ``hash``, and ``from`` and ``to``, each a file and an offset.

    Leaves are page ids, null for rows without one; a node above covers ``fanout`` of those below, the root all of them.
    """
    ends = F.struct("warc_file", (F.col("start") + F.col("length")).alias("offset"))
    begins = F.struct("warc_file", F.col("start").alias("offset"))
    rows = listed.select(F.col("page_id").alias("node"), "url", "digest", begins.alias("from"), ends.alias("to"))
    # A leaf's records in any order: their number, and sums of numbers from their hashes.
    whole = F.sha2(F.concat_ws("\n", "digest", "url").cast("binary"), 256)
    parts = [F.conv(F.substring(whole, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    sums = F.concat_ws(":", F.count("*").cast("string"), *[F.sum(part).cast("string") for part in parts])
    levels = [staged(spark, rows.groupBy("node").agg(F.sha2(sums.cast("binary"), 256).alias("hash"), *_range()), "level")]
    for level in range(height + 1):
        parent = F.floor(F.col("node") / fanout) if level < height else F.lit(0).cast("bigint")
        children = F.array_sort(F.collect_list(F.struct(F.coalesce(F.col("node").cast("string"), F.lit("")).alias("node"), "hash")))
        up = levels[-1].groupBy(parent.alias("parent")).agg(children.alias("c"), *_range())
        # A child's number is part of what is hashed, so that a lacking one shows.
        lines = F.transform("c", lambda x: F.concat_ws(":", x["node"], x["hash"]))
        up = up.select(F.col("parent").alias("node"), F.sha2(F.array_join(lines, "|").cast("binary"), 256).alias("hash"), "from", "to")
        levels.append(staged(spark, up, "level"))
    return levels


def differing(spark: SparkSession, ours: list[DataFrame], theirs: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """``node``: the leaves in which two trees of one height differ, found from the root down."""
    suspects: DataFrame | None = None
    for level in range(len(ours) - 1, -1, -1):
        sides = []
        for levels in (ours, theirs):
            rows = levels[level].select("node", "hash")
            # Below the root every node is a child of it.
            if suspects is not None and level < len(ours) - 2:
                above = suspects.select(F.col("node").alias("parent"))
                rows = rows.join(above, F.floor(F.col("node") / fanout).eqNullSafe(F.col("parent")), "left_semi")
            sides.append(rows)
        both = sides[0].alias("o").join(sides[1].alias("t"), F.col("o.node").eqNullSafe(F.col("t.node")), "full_outer")
        changed = ~F.col("o.hash").eqNullSafe(F.col("t.hash"))
        suspects = staged(spark, both.where(changed).select(F.coalesce("o.node", "t.node").alias("node")), "suspects")
        if suspects.isEmpty():
            return suspects
    return suspects


def _same(left: str, right: str, *names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return out


def _ranked(spark: SparkSession, rows: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: places 0, 1, ... among the rows of equal keys. No group is gathered in one task."""
    placed = staged(spark, with_ordinal(spark, rows, [*keys, *order], "place", "ranks"), "ranks")
    first = placed.groupBy(*keys).agg(F.min("place").alias("first"))
    joined = placed.alias("r").join(first.alias("f"), _same("r", "f", *keys))
    return joined.select(*[f"r.{c}" for c in rows.columns], (F.col("place") - F.col("first")).alias(name))


def audit(spark: SparkSession, ours: DataFrame, theirs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The records in which the replica ``theirs`` differs: place, file, offset range, page and state.

    Places and ranges are those of ``ours``; an added record has its own.
    """
    height = height_of(ours, theirs, fanout=fanout)
    leaves = differing(spark, tree(spark, ours, height, fanout), tree(spark, theirs, height, fanout), fanout)
    sides = [staged(spark, side.join(leaves, F.col("page_id").eqNullSafe(F.col("node")), "left_semi"), "differing") for side in (ours, theirs)]
    record, left = ["page_id", "url", "digest"], []
    for own, other in (sides, sides[::-1]):
        counts = other.groupBy(*record).agg(F.count("*").alias("n"))
        rest = _ranked(spark, own, record, ["at"], "rank").alias("r").join(counts.alias("c"), _same("r", "c", *record), "left")
        rest = rest.where(F.col("rank") >= F.coalesce("n", F.lit(0))).select(*[f"r.{c}" for c in own.columns])
        left.append(_ranked(spark, rest, ["page_id", "url"], ["digest", "at"], "nth"))
    both = left[0].alias("o").join(left[1].alias("t"), _same("o", "t", "page_id", "url", "nth"), "full_outer")
    state = F.when(F.col("t.at").isNull(), "missing").when(F.col("o.at").isNull(), "added").otherwise("altered")
    pick = {name: F.when(F.col("o.at").isNull(), F.col(f"t.{name}")).otherwise(F.col(f"o.{name}")) for name in ("at", "warc_file", "start", "length", "page_id")}
    stop = (pick["start"] + pick["length"]).alias("stop")
    return both.select(pick["at"].alias("place"), pick["warc_file"].alias("warc_file"), pick["start"].alias("start"), stop, pick["page_id"].alias("page_id"), state.alias("state"))


def with_faults(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The pages with faults that follow from their ids: of 128 one is lost, and one has another character in its middle."""
    draw = F.substring(F.md5(F.concat(F.lit("fault:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")), 1, 2)
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    middle = F.floor(F.length(html) / 2).cast("int")
    changed = F.concat(F.substring(html, F.lit(1), middle), F.lit("\u0000"), F.substring(html, middle + 2, F.length(html)))
    return pages.where(~draw.isin("00", "01")).withColumn(html_col, F.when(draw.isin("02", "03"), changed).otherwise(F.col(html_col)))


ORACLE_SQL = """
WITH pages_read AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), records AS (
  SELECT page_id, url,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
         || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
         || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10)
         || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
         || 'Content-Length: ' || octet_length(encode(html))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
         || html || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages_read
), placed AS (
  SELECT page_id, octet_length(encode(record))::BIGINT AS length,
         row_number() OVER (ORDER BY page_id NULLS LAST, url, sha256(record)) - 1 AS place
  FROM records
), ranged AS (
  SELECT place, place // 1000 AS warc_file, page_id, length,
         coalesce(sum(length) OVER (PARTITION BY place // 1000 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         substr(md5('fault:' || coalesce(page_id::VARCHAR, '')), 1, 2) AS draw
  FROM placed
)
SELECT place, warc_file, start, start + length AS stop, page_id, CASE WHEN draw IN ('00', '01') THEN 'missing' ELSE 'altered' END AS state
FROM ranged WHERE draw IN ('00', '01', '02', '03')
"""
