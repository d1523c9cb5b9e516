"""Exact deduplication by content hash with a byte comparison, in built-in expressions only."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ridemetrics.llm.common import store


def content_hash(text: Column) -> Column:
    """128-bit hash of a text."""
    return F.unhex(F.md5(text))


def _keyed(docs, hash_of, text_col):
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return {"_text": text, "_hash": hash_of(text), "_sha": F.unhex(F.sha2(text, 256))}


def _equal_texts(keyed: DataFrame, *aggregates: Column) -> DataFrame:
    """One row per distinct text. The text is a grouping key, so equality is decided on its bytes;
    copies collapse in the map task, so even a third of all rows being equal sends one row per task.
    """
    return keyed.groupBy("_hash", "_sha", "_text").agg(*aggregates)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable = content_hash
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by ``hash_of`` and inside a group by their bytes, so texts that merely collide
    stay apart. They are told apart afterwards by SHA-256; two texts equal in both digests and not
    in bytes fail the job rather than being merged. Of equal texts the largest id stays (the
    contract of the query; a null id is smaller than any other).

    Null text counts as empty. Rows that repeat an id together with its text are one document and
    share ``kept``. An empty table gives an empty result; other columns are not read.
    """
    key = F.col(id_col).alias("doc_id")
    keyed = docs.select(key, *[c.alias(n) for n, c in _keyed(docs, hash_of, text_col).items()])
    texts = _equal_texts(keyed, F.max("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    groups = (
        texts.groupBy("_hash", "_sha")
        .agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_texts"))
        .select(
            "_hash",
            "_sha",
            "_keep",
            F.when(F.col("_texts") == 1, F.col("_n"))
            .otherwise(F.raise_error(F.lit("different texts with equal digests")).cast("long"))
            .alias("_n"),
        )
    )
    # A hot group is a hot join key of small rows. Stored, both sides come from a plain shuffle, which
    # adaptive execution can split.
    groups = store(groups, "equal-texts")
    return keyed.select("doc_id", "_hash", "_sha").join(groups, ["_hash", "_sha"]).select(
        "doc_id",
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def drop_exact_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_of: Callable = content_hash
) -> DataFrame:
    """The row with the largest id of each distinct text, with all its columns; one shuffle.

    Rows that repeat an id together with its text leave one of them, the same in every run: that with the largest
    hash of all columns but maps. A null text counts as empty, a null id is smaller than any other.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_row")
    keyed = docs.select(row, *[c.alias(n) for n, c in _keyed(docs, hash_of, text_col).items()])
    hashed = [F.col("_row").getField(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    last = F.max_by("_row", F.struct(F.col("_row").getField(id_col), F.xxhash64(*hashed))).alias("_row")
    return _equal_texts(keyed, last).select("_row.*")
