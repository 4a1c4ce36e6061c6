"""Shared work folders and the few file-system questions a plan cannot answer."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

Stage = Callable[[DataFrame, str], DataFrame]


def _path(spark: SparkSession, uri: str) -> tuple[JavaObject, JavaObject]:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def has_files(spark: SparkSession, uri: str) -> bool:
    """True when at least one data file lies under ``uri``; a missing path has none."""
    fs, path = _path(spark, uri)
    if not fs.exists(path):
        return False
    found = fs.listFiles(path, True)
    while found.hasNext():
        if not found.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def exists(spark: SparkSession, uri: str) -> bool:
    fs, path = _path(spark, uri)
    return bool(fs.exists(path))


def folders(spark: SparkSession, uri: str) -> list[str]:
    """Names of the folders right under ``uri``; a missing one has none."""
    fs, path = _path(spark, uri)
    if not fs.exists(path):
        return []
    return [entry.getPath().getName() for entry in fs.listStatus(path) if entry.isDirectory()]


def state_of(spark: SparkSession, *uris: str) -> str:
    """A digest of the files under ``uris``: their paths, sizes and times. It changes when a file comes, goes or changes."""
    lines = []
    for uri in uris:
        fs, path = _path(spark, uri)
        found = fs.listFiles(path, True) if fs.exists(path) else None
        while found is not None and found.hasNext():
            file = found.next()
            lines.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(lines)).encode()).hexdigest()


def delete(spark: SparkSession, uri: str) -> None:
    fs, path = _path(spark, uri)
    fs.delete(path, True)
    fs.cancelDeleteOnExit(path)


def make_folder(spark: SparkSession, uri: str) -> None:
    fs, path = _path(spark, uri)
    fs.mkdirs(path)


#: A file that names the folder beside it which holds the rows; names with an underscore are hidden from scans.
POINTER = "_current"


def current(spark: SparkSession, uri: str) -> str:
    """The folder that the pointer in ``uri`` names; ``uri`` itself where there is none."""
    fs, path = _path(spark, f"{uri}/{POINTER}")
    if not fs.exists(path):
        return uri
    stream = fs.open(path)
    try:
        return f"{uri}/{spark._jvm.org.apache.commons.io.IOUtils.toString(stream, 'UTF-8')}"
    finally:
        stream.close()


def point(spark: SparkSession, uri: str, name: str) -> None:
    """From now on, and in one step, readers of ``uri`` read the folder ``name`` in it."""
    fs, aside = _path(spark, f"{uri}/_{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    stream.writeBytes(name)
    stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, jvm.org.apache.hadoop.fs.Path(f"{uri}/{POINTER}"), options)


def keep_only(spark: SparkSession, uri: str, *names: str) -> None:
    """Deletes what lies right under ``uri`` but for these names."""
    fs, path = _path(spark, uri)
    for entry in fs.listStatus(path):
        if entry.getPath().getName() not in names:
            fs.delete(entry.getPath(), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = _path(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    if not fs.rename(path, goal):
        raise OSError(f"could not move {source} to {target}")


def work_folder(spark: SparkSession, label: str = "work") -> str:
    """A new folder that every executor can reach, dropped when the driver ends.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _drop_at_exit(spark, folder)
    return folder


def _drop_at_exit(spark: SparkSession, uri: str) -> None:
    fs, path = _path(spark, uri)
    fs.mkdirs(path)
    fs.deleteOnExit(path)


#: Staged frames with texts and histories, which hold most of the bytes. Others stay as the planner knows them: it takes
#: the size of files for the size of rows when it broadcasts.
WIDE = {"issue_pages", "parsed_entries", "issues", "fresh_issues"}


def stage_in(spark: SparkSession, folder: str) -> Stage:
    """A stage: writes a frame once to ``folder`` and continues from the files.

    This cuts lineage (an executor loss re-reads files instead of re-parsing
    the raw input), lets each consumer read only its columns, and gives the
    planner true sizes, so that it broadcasts a side only when it is small.
    """

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.option("compression", "zstd" if name in WIDE else "snappy").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return stage


def is_small(df: DataFrame) -> bool:
    """True when the planner, by the size of the files that ``df`` reads, broadcasts it in a join."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= _broadcast_size(df)


def reads_little(df: DataFrame) -> bool:
    """True when the files that ``df`` reads are no larger, in all, than what the planner broadcasts."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(leaves.apply(n).stats().sizeInBytes()) for n in range(leaves.size()))
    return sum(sizes) <= _broadcast_size(df)


def _broadcast_size(df: DataFrame) -> int:
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def unstaged(df: DataFrame, name: str) -> DataFrame:
    """The stage that does nothing: everything stays one lazy plan."""
    return df
