"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import base64
import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.sources import storage

#: A word, for every operator here: a run without the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows in one Arrow batch of texts. Spark's own 10,000 rows of long texts would be gigabytes.
TEXT_ROWS = 512
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in small Arrow batches from now on in this session."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, TEXT_ROWS)


def give_back() -> None:
    """Freed memory of this process goes back to the system, where its C library can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def tidy(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function`` over Arrow batches, at whose end its worker gives freed memory back.

    Workers wait to be used again by later stages. Until then the executor lacks what their memory pools keep.
    """

    def run(batches: Batches) -> Batches:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared work folder and read back.

    Later steps read the files, so a lost executor costs a read and not the
    work before it, and the planner sees true sizes.
    """
    path = f"{storage.work_folder(spark, label)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_ordinal(spark: SparkSession, df: DataFrame, keys: Iterable[str], name: str, label: str) -> DataFrame:
    """``df`` with ``name``: its rows' places 0, 1, ... in the order of ``keys`` (nulls last).

    The rows are dealt out by range and numbered inside each partition; only
    one count per partition is summed up in one place. Equal keys are spread
    by a running id, so that a key with a third of all rows is no hot
    partition; their order among each other is fixed by the staged files.
    """
    order = [F.col(key).asc_nulls_last() for key in keys]
    spread = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = (
        spread.repartitionByRange(*order, F.col("_tie"))
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = staged(spark, placed, label)
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One row per partition of the table above: as many as the session's shuffle partitions.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(counts), "_part")
        .withColumn(name, F.col("_before") + inside)
        .drop("_part", "_before", "_at")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where ``df`` has a column of that name in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def load_ranks(path: str) -> dict[bytes, int]:
    """The token bytes and ids of a rank file: a base64 text and a number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For slices of a flat array: the places of all their items, and the ends of the slices."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)
    return shift + np.arange(total, dtype=np.int64), ends
