"""Shared helpers: stored tables, Arrow batches of texts, words."""

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemetrics.operators.storage import delete_folder

# Text handled at a time inside a task; some ten times as much is held on the way.
SLICE_BYTES = 1 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


_scope: ContextVar[str] = ContextVar("scope", default="tables")


def _root(spark: SparkSession) -> str:
    """Folder that driver and executors share: below ``spark.checkpoint.dir`` or, where that is unset, as in tests,
    below the warehouse, which Spark itself expects to be shared."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/ridemetrics-llm/{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, label: str) -> str:
    """New folder that driver and executors share, in the current ``scope``."""
    return f"{_root(spark)}/{_scope.get()}/{label}-{uuid4().hex}"


@contextmanager
def scope(spark: SparkSession, name: str) -> Iterator[None]:
    """What is stored within the block lies in one folder, and what the last block of this name stored goes.

    So tables do not pile up; read an answer before the next block of its name begins, or call ``forget`` after it.
    """
    forget(spark, name)
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def forget(spark: SparkSession, name: str) -> None:
    """Deletes what a ``scope`` has stored."""
    delete_folder(spark, f"{_root(spark)}/{name}")


# For rows of a tenth of a megabyte and more: the writer looks at the size of what it holds after every fourth row, where
# it would look after a hundred, and holds less of it.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "4",
    "parquet.page.size.row.check.max": "4",
    "parquet.block.size.row.check.min": "4",
    "parquet.block.size.row.check.max": "4",
    "parquet.block.size": str(16 << 20),
    "parquet.enable.dictionary": "false",
}


def store(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    """Writes ``df`` once and reads it back: lineage ends here, and a lost executor costs a re-read."""
    path = shared_folder(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def set_up(spark: SparkSession) -> None:
    """Prepares a session for Python workers that handle texts.

    Workers can import this package where it was not shipped with ``--py-files``. Batches are bounded
    by bytes, unless the session has a bound of its own: ten thousand long texts at once would not fit.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(SLICE_BYTES))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns, ``doc_id`` long and ``text`` as UTF-8 bytes, null as empty; other columns go."""
    set_up(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"))


def without_rows(docs: DataFrame, id_col: str, text_col: str, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``gone`` (``doc_id``, ``tie``: the text's hash); null ids stay.

    So of rows that share an id only those go that are meant. The rows travel as one column, so no name of
    theirs can clash.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("tie"),
    )
    return rows.join(gone.select("doc_id", "tie"), ["doc_id", "tie"], "left_anti").select("row.*")


def slices(batches, column: str = "text", limit: int = SLICE_BYTES):
    """Cuts record batches so that each piece holds about ``limit`` bytes of ``column``, a row at least.

    At the end of a task what it has freed goes back to the system, as its process waits for further tasks.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)
    _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def together(batches, limit: int, column: str = "text"):
    """Record batches of about ``limit`` bytes, whatever the size of those that come in; a row at least."""
    held, size = [], 0
    for batch in slices(batches, column, limit):
        if held and size + batch.nbytes > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
