import random

import pytest
from pyspark.sql import functions as F

from helpers import shuffled
from ridemetrics.operators.fill import fill_ordered, forward_fill
from ridemetrics.operators.frames import order_rows


def sequential(values):
    last, filled = None, []
    for value in values:
        last = value if value is not None else last
        filled.append(last)
    return filled


@pytest.mark.parametrize("block_rows", [1, 3, 50, 1000])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.5])
def test_equals_a_sequential_fill(spark, block_rows, share):
    rng = random.Random(block_rows)
    values = [f"v{i}" if rng.random() < share else None for i in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v string")
    df = shuffled(df.withColumn("block", F.floor(F.col("id") / block_rows)))
    filled = forward_fill(df, "v", block=["block"], order="id")
    assert filled.columns == ["id", "v", "block"]
    assert [r.v for r in filled.orderBy("id").collect()] == sequential(values)


def test_value_crosses_empty_blocks(spark):
    df = spark.createDataFrame([(0, None), (1, "a"), (2, None), (3, None), (4, None), (5, "b")], "id long, v string")
    filled = forward_fill(df.withColumn("block", F.col("id")), "v", block=["block"], order="id")
    assert [r.v for r in filled.orderBy("id").collect()] == [None, "a", "a", "a", "a", "b"]


@pytest.mark.parametrize("block_rows", [7, 100, 10**6])
def test_blocks_by_position_do_not_depend_on_the_keys(spark, folder, block_rows):
    """Keys far apart and keys close together, in one table."""
    rng = random.Random(block_rows)
    keys = sorted({rng.randrange(-(2**63), 2**63) for _ in range(400)} | set(range(400)))
    values = [f"v{i}" if rng.random() < 0.05 else None for i in range(len(keys))]
    df = shuffled(spark.createDataFrame(list(zip(keys, values)), "id long, v string"))
    ordered = order_rows(df, ["id"], folder, parts=5)
    assert ordered.select("_part").distinct().count() > 1
    filled = fill_ordered(ordered, "v", block_rows)
    assert [(r.id, r.v) for r in filled.orderBy("id").collect()] == list(zip(keys, sequential(values)))
    blocks = ordered.groupBy("_part", F.expr(f"_pos div {block_rows}")).count().collect()
    assert max(r["count"] for r in blocks) <= block_rows
    assert len(blocks) <= 5 + len(keys) / block_rows
