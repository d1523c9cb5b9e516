"""Stored intermediate tables and the Parquet sink."""

import logging
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def new_folder(spark: SparkSession, root: str | None = None) -> str:
    """Name of a folder for the stored tables of one run, below ``root`` or ``spark.checkpoint.dir``.

    Driver and executors must share it, so there is no default: without either it is an error, on
    every master.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("pass a folder, or set spark.checkpoint.dir to one that all executors share")
    return f"{root.rstrip('/')}/ridemetrics/{spark.sparkContext.applicationId}/{uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession, root: str | None = None) -> Iterator[str]:
    """A new folder, deleted at the end of the block with the tables stored in it, by whichever thread."""
    folder = new_folder(spark, root)
    try:
        yield folder
    finally:
        delete_folder(spark, folder)


def store(df: DataFrame, folder: str, label: str) -> DataFrame:
    """Writes ``df`` once below ``folder`` and reads it back.

    Cuts the lineage, so that a query that reads its input twice does not compute it twice and a
    lost executor costs a re-read only. Unlike a checkpoint, the copy keeps column pruning. One
    file per task: the row number in a file is then the row's place in its partition.
    """
    path = f"{folder.rstrip('/')}/{label}-{uuid4().hex}"
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_result(df: DataFrame, base: str, folder: str, partition_by: list[str] | None = None) -> str:
    """Replaces ``base/folder`` (any Hadoop file system) by ``df`` as Parquet.

    The new files are written aside and take the place of the old ones when all of them are there, so a
    job that fails leaves the old answer. The switch is two renames; if the second fails, the old answer goes back.
    Where a store copies to rename, readers may meet no answer for that long, but never a part of one.
    """
    base = base.rstrip("/")
    path, aside = f"{base}/{folder}", f"{base}/_{folder}-{uuid4().hex}"
    spark = df.sparkSession
    try:
        df.write.partitionBy(*(partition_by or [])).parquet(f"{aside}/new")
        _switch(spark, f"{aside}/new", path, f"{aside}/old")
    finally:
        delete_folder(spark, aside)
    log.info("written: %s", path)
    return path


def _switch(spark: SparkSession, new: str, path: str, old: str) -> None:
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    new, path, old = map(to_path, (new, path, old))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    was_there = files.exists(path)
    if was_there and not files.rename(path, old):
        raise OSError(f"could not move {path} aside")
    moved = False
    try:
        moved = files.rename(new, path)
    finally:
        if was_there and not moved:
            files.rename(old, path)
    if not moved:
        raise OSError(f"could not move the new files to {path}")
