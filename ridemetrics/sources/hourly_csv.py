"""Hourly table from the raw CSV export."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ridemetrics.functions.clock import hour_timestamp, label_date
from ridemetrics.operators.fill import BLOCK_ROWS, last_value, spread
from ridemetrics.operators.scan import totals_ahead
from ridemetrics.operators.storage import store
from ridemetrics.schema import COUNTERS, HOURLY, LABEL_FORMAT, LINE, PLACE_IN_SOURCE, RENAMES, ROW_NO

# Stands for a label that is present but does not parse; two-digit years start at 2000.
_UNREADABLE = "0001-01-01"
# Wide enough for any counter, with room for a fraction, which is then refused.
_NUMBER = "decimal(38,10)"
# Stands for the row as a whole among the columns with rejected values.
_ROW = "(row)"


def read_hourly_csv(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> DataFrame:
    """Raw rows as text, with their place in the source: file, start of the split, number within the scan.

    Columns are matched by header name, read from the first line only, or given as ``header`` where the files
    have none; nothing is inferred, and no value is lost before
    ``standardize`` parses it: a row with more or fewer fields than the header also keeps its line, in ``src_line``.
    """
    names = list(header or spark.read.option("header", True).csv(path).columns)
    missing = [name for name in RENAMES if name not in names]
    if missing:
        raise ValueError(f"columns missing in {path}: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, LINE]])
    return (
        spark.read.schema(schema)
        .option("header", header is None)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", LINE)
        # Else fields are only counted up to the last column that is read.
        .option("columnPruning", False)
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_start"),
            F.monotonically_increasing_id().alias("src_seq"),
        )
    )


def _present(name: str) -> Column:
    """Trimmed text, null when empty."""
    return F.nullif(F.trim(F.col(name).cast("string")), F.lit(""))


def _counter(name: str) -> Column:
    """Whole number of any spelling (``12``, `` 12``, ``12.0``) as a long; null when it is none."""
    number = _present(name).try_cast(_NUMBER)
    return F.when(number == F.floor(number), number).try_cast("long")


def _hour(name: str) -> Column:
    """Hour of day as an integer, a fraction cut off."""
    return _present(name).try_cast(_NUMBER).try_cast("int")


def misshapen_rows(raw: DataFrame) -> DataFrame:
    """``file, start, seq, n_fields, line`` of the rows from ``read_hourly_csv`` with more or fewer fields than the header.

    ``start`` is the first byte of the row's split and ``seq`` ascends within a scan; ``n_fields`` counts what
    stands between commas outside of quotes.
    """
    outside = F.regexp_replace(LINE, r'"(?:[^"\\]|\\.|"")*"', "")
    # The reader only tells damaged rows when a query also reads a field.
    reads_a_field = F.coalesce(F.length(raw.columns[0]), F.lit(0)) >= 0
    return raw.filter(F.col(LINE).isNotNull() & reads_a_field).select(
        F.col("src_file").alias("file"),
        F.col("src_start").alias("start"),
        F.col("src_seq").alias("seq"),
        (F.regexp_count(outside, F.lit(",")) + 1).alias("n_fields"),
        F.col(LINE).alias("line"),
    )


def unreadable_values(rows: DataFrame) -> DataFrame:
    """``column, file, rows``: how many texts of the stored raw rows are present and could not be read.

    Rows of the wrong shape count under the column ``(row)``.
    """
    found = rows.filter(F.size("_rejects") > 0).select(F.explode("_rejects").alias("column"), F.col("src_file").alias("file"))
    return found.groupBy("column", "file").agg(F.count(F.lit(1)).alias("rows"))


def _refuse(rows: DataFrame) -> None:
    """Raises if there is a rejected value; the message shows the files with the most of them."""
    worst = unreadable_values(rows).orderBy(F.desc("rows"), "column", "file").limit(20).collect()
    if worst:
        lines = [
            f"{r['rows']} rows with more or fewer fields than the header of {r['file']}"
            if r["column"] == _ROW
            else f"{r['rows']} in column {r['column']} of {r['file']}"
            for r in worst
        ]
        raise ValueError("unreadable values: " + "; ".join(lines))


def standardize(raw: DataFrame, folder: str, unreadable: str = "raise", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rename, parse, fill the sparse dates down and add the wall-clock timestamp.

    The raw rows are stored below ``folder`` first (this runs now): the fill reads them twice, and both
    times must see the same splits and numbers, which a second scan of the CSV does not promise. Rows
    are filled in blocks of ``block_rows`` by their position in a scan task, so a file that cannot be
    split is not sorted in one piece; the seed of each block and split also says how many rows
    come before it, which gives ``row_no``, the row's number in the whole source. So file names are
    not shuffled.

    Text that is present and is not a whole number, an hour or a label is an error that names
    column, file and count, and so is a row with more or fewer fields than the header. With
    ``unreadable="null"`` such text is read as null, and such a row as far as its fields go (``misshapen_rows`` lists
    them with their lines); a label that does not parse then covers its rows with null, up to the next label. An hour outside 0 to 23 has no time.
    The fill carries dates rather than labels, so that the table of blocks comes from a hash aggregate.
    """
    if unreadable not in ("raise", "null"):
        raise ValueError(f"unreadable must be 'raise' or 'null', not {unreadable!r}")
    missing = [name for name in [*RENAMES, *PLACE_IN_SOURCE] if name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    by_name = {column: name for name, column in RENAMES.items()}
    parsed = {column: _counter(by_name[column]) for column in COUNTERS} | {"hour": _hour(by_name["hour"])}
    day = label_date(_present(by_name["date"]), LABEL_FORMAT)
    rejects = [
        F.when(_present(by_name[column]).isNotNull() & value.isNull(), F.lit(by_name[column].strip()))
        for column, value in {**parsed, "date": day}.items()
    ]
    if LINE in raw.columns:
        rejects.append(F.when(F.col(LINE).isNotNull(), F.lit(_ROW)))
    none = F.lit(_UNREADABLE).cast("date")
    rows = store(
        raw.select(
            F.when(_present(by_name["date"]).isNotNull(), F.coalesce(day, none)).alias("date"),
            *[value.alias(column) for column, value in parsed.items()],
            *PLACE_IN_SOURCE,
            # The number of the scan task is in the upper bits, so blocks of two tasks never meet.
            F.expr(f"src_seq div {block_rows}L").alias("_block"),
            F.spark_partition_id().alias("_task"),
            F.array_compact(F.array(*rejects)).alias("_rejects"),
        ),
        folder,
        "raw",
    )
    if unreadable == "raise":
        _refuse(rows)
    rows = rows.drop("_rejects")

    split = ["src_file", "src_start"]
    block = ["_task", "_block"]
    splits = rows.groupBy(*block, *split).agg(
        last_value("date", "src_seq").alias("_tail"),
        F.count(F.lit(1)).alias("_rows"),
        F.min("src_seq").alias("src_seq"),
    )
    seeds = totals_ahead(splits, ["_rows"], ["_tail"], part=split).select(
        *block,
        "src_seq",
        F.col("_tail_ahead").alias("date"),
        (F.col("_rows_ahead") - F.col("src_seq")).alias("_shift"),
    )
    unfilled = rows.drop(*split).withColumn("_shift", F.lit(None).cast("long"))
    filled = spread(unfilled, seeds, ["date", "_shift"], gather=block, order="src_seq")
    return (
        filled.withColumn("date", F.nullif(F.col("date"), none))
        .withColumn("ts", hour_timestamp("date", "hour"))
        .select(*HOURLY, (F.col("src_seq") + F.col("_shift")).alias(ROW_NO))
    )
