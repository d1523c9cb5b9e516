import random

import pytest
from pyspark.sql import functions as F

from helpers import plan, shuffled
from ridemetrics.operators.scan import totals_ahead


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_sequential_scan(spark, seed):
    rng = random.Random(seed)
    blocks = [(p, b, rng.randrange(-5, 9), rng.choice([None, None, p * 100 + b])) for p in (0, 1, 4, 7) for b in range(rng.randrange(1, 20))]
    total, last, expected = 0, None, []
    for p, b, n, tail in blocks:
        expected.append((p, b, total, last))
        total, last = total + n, tail if tail is not None else last
    df = shuffled(spark.createDataFrame(blocks, "_part int, _block long, n long, tail long"))
    found = totals_ahead(df, ["n"], ["tail"])
    assert found.columns == ["_part", "_block", "n", "tail", "n_ahead", "tail_ahead"]
    assert sorted(map(tuple, found.select("_part", "_block", "n_ahead", "tail_ahead").collect()), key=lambda r: r[:2]) == expected


def test_only_the_parts_are_ordered_as_a_whole(spark):
    blocks = spark.range(10).select(F.col("id").alias("_part"), F.col("id").alias("_block"), F.lit(1).alias("n"))
    lines = plan(totals_ahead(blocks, ["n"])).splitlines()
    (at,) = (i for i, line in enumerate(lines) if "Exchange SinglePartition" in line)
    assert "HashAggregate(keys=[_part" in lines[at + 1]


def test_parts_of_several_columns_and_no_rows(spark):
    blocks = [("a", 0, 0, 1), ("a", 0, 1, 2), ("a", 9, 0, 4), ("b", 3, 5, 8)]
    df = shuffled(spark.createDataFrame(blocks, "file string, start long, _block long, n long"))
    found = totals_ahead(df, ["n"], part=["file", "start"]).orderBy("file", "start", "_block").collect()
    assert [r.n_ahead for r in found] == [0, 1, 3, 7]
    assert totals_ahead(df.limit(0), ["n"], part=["file", "start"]).collect() == []
