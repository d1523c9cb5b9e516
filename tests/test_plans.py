"""Shape of the physical plans."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from conftest import SF_SMALL, own_queries
from helpers import plan

# The job's queries only read its answers back.
QUERIES = {key: query for key, query in own_queries().items() if not key.startswith("job_")}


def initial(key, spark):
    return plan(QUERIES[key](spark, SF_SMALL))


@pytest.mark.parametrize("key", QUERIES)
def test_no_python_and_no_loop_join(spark, key):
    text = initial(key, spark)
    for banned in ("Python", "BroadcastNestedLoopJoin", "CartesianProduct", "Expand", "SortAggregate"):
        assert banned not in text


@pytest.mark.parametrize("key", [k for k in QUERIES if k[:3] in ("q1_", "q3_", "q4_", "q5_", "q7_", "q9_", "q10")])
def test_events_are_read_once(spark, key):
    assert initial(key, spark).count("FileScan") == 1


@pytest.mark.parametrize("key", [k for k in QUERIES if "rolling" in k or "forward" in k or "csv" in k])
def test_windows_over_rows_are_partitioned(spark, many_parts, key):
    """The only window without a partition runs over the table of parts or blocks."""
    lines = initial(key, spark).splitlines()
    windows = [line for line in lines if "+- Window [" in line]
    assert len(windows) >= 2
    assert sum("Exchange SinglePartition" in line for line in lines) == 1
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[at + 1]


@pytest.mark.parametrize("key", [k for k in QUERIES if "peak" in k or "busiest" in k or "end_of" in k or "add" in k])
def test_first_row_needs_no_global_sort(spark, key):
    assert "TakeOrderedAndProject" in initial(key, spark)


@pytest.mark.parametrize(
    "key, columns",
    [("q3_peak_hour", "ts:timestamp_ntz,event_type:string"), ("forward_fill", "event_id:bigint,ts:timestamp_ntz")],
)
def test_only_used_columns_are_read(spark, key, columns):
    assert f"ReadSchema: struct<{columns}>" in initial(key, spark)


def test_small_parameters_exercise_the_distributed_branches(spark):
    """More than one file, bucket, block and split at the scale of the benchmark."""
    sf_dir = "/root/testdata/sf0.1"
    for key, part in [("events_rolling_72_parts", "ordered-"), ("csv_ingest_files", "raw-csv"), ("forward_fill_sparse_ids", "ordered-")]:
        QUERIES[key](spark, sf_dir)
        root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
        found = list(Path(root, "ridemetrics", spark.sparkContext.applicationId, key).glob(f"{part}*/part-*"))
        assert len(found) > 1, key
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert events > 2 * contract._BUCKET_ROWS and events > 2 * contract._BLOCK_ROWS


def test_a_query_leaves_only_the_tables_of_its_last_call(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    counts = []
    for _ in range(2):
        QUERIES["q6_busiest_8h"](spark, SF_SMALL).collect()
        counts.append(len(list(Path(root, "ridemetrics", spark.sparkContext.applicationId, "q6_busiest_8h").iterdir())))
    assert counts == [1, 1]
