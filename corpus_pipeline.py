"""Cleaning and encoding of a corpus in five stages, each over all rows that the one before it kept."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ridemetrics.llm.common import store
from ridemetrics.llm.decontaminate import drop_contaminated
from ridemetrics.llm.exact_dedup import drop_exact_copies
from ridemetrics.llm.language_id import identify
from ridemetrics.llm.ngram_join import drop_similar
from ridemetrics.llm.sentencepiece import encode_pieces


def _carried(docs: DataFrame, *columns: str) -> DataFrame:
    """Each row as one column ``row``, so that no name of its columns matters, and beside it ``columns``."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[F.col(f"`{c}`") for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is known with enough confidence, with all their columns.

    Rows are judged one by one, so repeated rows share their fate. Null and empty texts and texts without letters have no
    language and go, and so do texts that a background explains better than any declared language. A null ``lang``
    or ``source`` is a value like others; a text of any length is read as a whole; ties change nothing, as the
    language is not kept.
    """
    found = identify(_carried(docs, "text", "lang", "source"))
    return found.filter("language_id.accepted").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the largest id of each distinct text, with all its columns.

    A null text counts as empty and a null id as smaller than any other. Of rows that repeat an id together
    with its text one is left. Texts of any length are compared as a whole.
    """
    return drop_exact_copies(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of similar documents: 5-word Jaccard similarity of 0.8 or more.

    The smallest id of a class stays. Rows without an id, and texts that are null or without words, stay. Rows that share
    an id are told apart by their texts; rows that repeat both are one document. All columns are kept.
    """
    return drop_similar(docs, n=5, similarity=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that repeat benchmark passages, with all columns of the others.

    Rows without an id stay; of rows that share an id those go whose own text is contaminated. A null text has no
    words and stays. Texts of any length are searched as a whole.
    """
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_ADDED = ["ids", "n_pieces", "round_trip"]


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the token ids of each text, their number, and whether they decode to the text.

    Every row stays, repeated ones too; a null text counts as empty and has no ids. A column that already
    has the name of an added one is an error.
    """
    import public_tokenizers

    taken = {c.lower() for c in docs.columns} & set(_ADDED)
    if taken:
        raise ValueError(f"columns that this stage adds are there already: {sorted(taken)}")
    found = encode_pieces(_carried(docs, "text"), public_tokenizers.path("piece_bpe_32k.model"), into="pieces")
    return found.select("row.*", F.col("pieces.ids").alias("ids"), F.size("pieces.ids").alias("n_pieces"), "pieces.round_trip")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_join", ngram_join),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

# Trained and iterative stages have no SQL; tests/llm/test_pipeline.py compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
