"""Catalog tables for the five relations: create, keyed insert, plain insert, bulk load."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketmill import params
from ticketmill.functions import json_text
from ticketmill.operators.dedupe import first_per_key, without_present
from ticketmill.operators.validity import typed
from ticketmill.schemas import DATA_TYPES, KEYS, LOAD_ORDER, RECORDS, REQUIRED, WIDTHS
from ticketmill.sources.runs import bulk_prefixes

PREFIX = "tracker_"
# How the issues table holds custom fields.
SEMI_STRUCTURED = {"map": "MAP<STRING,STRING>", "variant": "VARIANT", "json": "STRING"}

# The releases table lists its project columns before its name.
_TABLE_ORDER = {
    "releases": (
        "release_id",
        "project_id",
        "project_key",
        "release_name",
        "archived",
        "released",
        "release_date",
        "user_release_date",
    )
}


def table_columns(relation: str) -> tuple[str, ...]:
    return _TABLE_ORDER.get(relation, tuple(RECORDS[params.one_data_type(relation)].names))


def table_name(relation: str, database: str | None = None, prefix: str = PREFIX) -> str:
    name = f"{prefix}{params.one_data_type(relation)}"
    return f"{database}.{name}" if database else name


def create_statement(
    relation: str,
    database: str | None = None,
    prefix: str = PREFIX,
    custom_as: str = "map",
    widths: bool = False,
    buckets: int | None = None,
) -> str:
    """DDL of one table. Ids are BIGINT on every target.

    With ``buckets`` the table is clustered by its key, so a keyed insert need
    not shuffle it. Take at least ``spark.sql.shuffle.partitions`` buckets:
    with fewer the planner shuffles anyway, for more parallel tasks.
    """
    params.choice("custom_as", custom_as, tuple(SEMI_STRUCTURED))
    schema = RECORDS[params.one_data_type(relation)]
    limits = WIDTHS[relation] if widths else {}
    columns = []
    for name in table_columns(relation):
        kind = schema[name].dataType.simpleString()
        if name in limits:
            kind = f"VARCHAR({limits[name]})"
        elif name == "custom_fields":
            kind = SEMI_STRUCTURED[custom_as]
        columns.append(f"`{name}` {kind}")
    ddl = (
        f"CREATE TABLE IF NOT EXISTS {table_name(relation, database, prefix)} "
        f"({', '.join(columns)}) USING parquet"
    )
    if buckets:
        keys = ", ".join(f"`{key}`" for key in KEYS[relation])
        ddl += f" CLUSTERED BY ({keys}) INTO {int(buckets)} BUCKETS"
    return ddl


def ensure_tables(spark: SparkSession, database: str | None = None, **options: object) -> None:
    """Create the five tables where they are missing; existing ones stay as they are."""
    for relation in DATA_TYPES:
        spark.sql(create_statement(relation, database, **options))


# --- what a row must look like before it goes in ---------------------------


def missing_required(df: DataFrame, relation: str) -> DataFrame:
    """Rows that leave a required column null, with the first such column's name."""
    first = F.coalesce(
        *[F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED[relation]]
    )
    return df.withColumn("missing_column", first).where(F.col("missing_column").isNotNull())


def with_required(df: DataFrame, relation: str) -> DataFrame:
    """The same rows; the job fails at a row that leaves a required column null."""

    def guarded(name: str) -> Column:
        message = F.lit(f"{relation}.{name} must not be null")
        return F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(F.col(name))

    return df.withColumns({name: guarded(name) for name in REQUIRED[relation]})


def align(*frames: DataFrame) -> DataFrame:
    """Bag union of frames with differing columns: all columns, missing ones null."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def _fitted(df: DataFrame, relation: str, table: str) -> DataFrame:
    """The table's columns in the table's order and types, required ones guarded."""
    out = with_required(typed(df, relation), relation)
    if relation == "issues":
        target = df.sparkSession.table(table).schema["custom_fields"].dataType
        if isinstance(target, T.StringType):
            out = out.withColumn("custom_fields", json_text(F.col("custom_fields")))
        elif isinstance(target, T.VariantType):
            as_json = json_text(F.col("custom_fields"))
            out = out.withColumn("custom_fields", F.parse_json(as_json))
    return out.select(*table_columns(relation))


def _insert(df: DataFrame, table: str) -> int:
    """Append by position; the rows are counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(table)
    return int(seen.get["rows"])


def absent_rows(
    df: DataFrame, target: DataFrame, keys: Iterable[str], order_by: Iterable[str | Column]
) -> DataFrame:
    """Rows whose key the target lacks; of several with one key, the first."""
    keys = list(keys)
    return without_present(first_per_key(df, keys, list(order_by)), target, keys, source=df)


def load_order(df: DataFrame, relation: str) -> list[str]:
    """The order columns of this relation; plain records, which lack some of
    them, are ordered by all their values, so the choice is still repeatable."""
    if set(LOAD_ORDER[relation]) <= set(df.columns):
        return list(LOAD_ORDER[relation])
    names = [f.name for f in RECORDS[relation].fields if not isinstance(f.dataType, T.MapType)]
    return [name for name in names if name in df.columns]


def insert_if_absent(
    df: DataFrame,
    relation: str,
    table: str,
    keys: Iterable[str] | None = None,
    order_by: Iterable[str | Column] | None = None,
) -> int:
    """Keyed insert: rows there already win, then the first row of the batch.

    Nothing is ever updated, so loading the same batch again adds nothing.
    Returns the number of rows inserted. One writer per table at a time.
    """
    keys = list(keys or KEYS[params.one_data_type(relation)])
    order = list(order_by or load_order(df, relation))
    target = df.sparkSession.table(table)
    return _insert(_fitted(absent_rows(df, target, keys, order), relation, table), table)


def insert_plain(df: DataFrame, relation: str, table: str) -> int:
    """Append every row, duplicates included."""
    return _insert(_fitted(df, relation, table), table)


# --- whole loads ------------------------------------------------------------


def load_all(
    relations: Mapping[str, DataFrame],
    database: str | None = None,
    load_mode: str = "keyed",
    prefix: str = PREFIX,
) -> dict[str, int]:
    """Load each given relation into its table; rows inserted per relation."""
    params.choice("load mode", load_mode, ("keyed", "plain"))
    insert = insert_if_absent if load_mode == "keyed" else insert_plain
    return {
        name: insert(df, name, table_name(name, database, prefix))
        for name, df in relations.items()
    }


def bulk_load(
    spark: SparkSession,
    uri: str,
    suffix: str,
    data_types: str | Iterable[str] | None = None,
    database: str | None = None,
    prefix: str = PREFIX,
) -> dict[str, int]:
    """Append all parts of a written Parquet run, one append per relation.

    No key is looked at. Relations outside ``data_types`` are left alone even
    when an earlier, broader run left parts for them.
    """
    runs = bulk_prefixes(spark, uri, suffix, data_types)
    return {
        name: insert_plain(df, name, table_name(name, database, prefix))
        for name, df in runs.items()
    }


def load_summary(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Rows inserted per relation as a frame, sorted by name."""
    rows = sorted(counts.items())
    return spark.createDataFrame(rows, "data_type STRING, inserted BIGINT").orderBy("data_type")
