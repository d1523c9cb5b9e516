"""Batch job: hourly CSV in, one Parquet folder per question out."""

import argparse
import logging
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from ridemetrics.operators.storage import scratch, write_result
from ridemetrics.plans.questions import QUESTIONS, answers, prepare
from ridemetrics.sources.hourly_csv import read_hourly_csv, standardize

log = logging.getLogger(__name__)

# Questions whose Spark jobs run side by side.
_AT_ONCE = 4


def session(app_name: str = "ridemetrics") -> SparkSession:
    """Object-store and resource settings come from spark-submit, not from here."""
    return SparkSession.builder.appName(app_name).getOrCreate()


def parse_ids(text: str | None) -> list[int]:
    """Question ids of a comma list, sorted and without repeats; all of them when empty."""
    if not text:
        return list(QUESTIONS)
    ids = sorted({int(part.strip()) for part in text.split(",")})
    unknown = [i for i in ids if i not in QUESTIONS]
    if unknown:
        raise KeyError(f"unknown question ids: {unknown}")
    return ids


def run(
    spark: SparkSession,
    path: str,
    out: str,
    question_id: str | None = None,
    scratch_root: str | None = None,
    unreadable: str = "raise",
) -> list[str]:
    """Answers the questions and returns the folders written.

    Stored tables go below ``scratch_root`` or ``spark.checkpoint.dir`` and are deleted at the end.
    """
    ids = parse_ids(question_id)
    with scratch(spark, scratch_root) as folder:
        table = prepare(standardize(read_hourly_csv(spark, path), folder, unreadable), ids, folder)

        found = answers(table, ids, folder)

        def answer(i):
            log.info("question %d", i)
            return write_result(found[i], out, f"question{i}")

        # The answers do not depend on each other; small last stages of one leave room for the next.
        with ThreadPoolExecutor(_AT_ONCE) as pool:
            return list(pool.map(inheritable_thread_target(spark)(answer), ids))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--question-id", default=None, help="comma list of 1 to 10; all when left out")
    parser.add_argument("--path", required=True, help="hourly CSV, a file or a folder")
    parser.add_argument("--out", required=True, help="folder of the answers, any Hadoop file system")
    parser.add_argument("--scratch", default=None, help="shared folder of stored tables, else spark.checkpoint.dir")
    parser.add_argument("--unreadable", choices=["raise", "null"], default="raise", help="text that is no number or date")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    parse_ids(args.question_id)
    spark = session()
    try:
        run(spark, args.path, args.out, args.question_id, args.scratch, args.unreadable)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
