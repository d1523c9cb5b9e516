import math

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm import topk_search
from ridemetrics.llm.queries import op11_topk_search
from ridemetrics.llm.topk_search import integer_vectors, top_k

SCHEMA = "vec_id long, embedding array<float>"


def _found(spark, rows, k=5, schema=SCHEMA):
    vectors = integer_vectors(spark.createDataFrame(rows, schema).repartition(5))
    return sorted(map(tuple, top_k(vectors, F.col("id") % 50 == 0, k).collect()))


def _random(seed, n, d=8, scale=1.0):
    import random

    rng = random.Random(seed)
    # Few different components, so that scores tie.
    return [(i, [scale * rng.randrange(-3, 4) / 4 for _ in range(d)]) for i in range(n)]


@pytest.mark.parametrize("block, cells, bits", [(2, 7, 1), (3, 1000, 4), (2048, 1 << 20, 10)])
def test_equals_brute_force(spark, monkeypatch, block, cells, bits):
    for name, value in (("BLOCK_QUERIES", block), ("CELLS", cells), ("BIN_BITS", bits)):
        monkeypatch.setattr(topk_search, name, value)
    rows = _random(block, 400)
    assert _found(spark, rows) == sorted(brute.top_k(rows))


def test_all_rows_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r)[:2] for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, op11_topk_search(spark, sf_dir).collect())) == sorted(brute.top_k(rows))


def test_most_rows_tie(spark):
    rows = [(i, [1.0, 0.5]) for i in range(3000)] + [(3000 + i, [2.0, 2.0]) for i in range(3)]
    found = _found(spark, rows)
    assert [r[2:] for r in found if r[0] == 50] == [(3000, 196608), (3001, 196608), (3002, 196608), (0, 81920), (1, 81920)]
    assert found == sorted(brute.top_k(rows))


def test_edges(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (0, [1.0, 2.0]), (50, None), (100, [nan, 1.0]), (150, [1.0, None]), (200, [inf, 0.0]), (250, [0.001, -0.001]),
        (None, [1.0, 2.0]), (7, [1.0, 2.0]), (300, [1.0, 2.0, 3.0]), (8, []), (350, []), (-50, [-1.0, -1.0]),
    ]
    found = _found(spark, rows)
    assert found == sorted(brute.top_k(rows), key=lambda r: r[:2])
    assert [r[2] for r in found if r[0] == 0] == [7, None, 250, -50]  # the null id last among equals
    assert [r for r in found if r[0] == 300] == []  # nothing of its length
    assert [r[1:] for r in found if r[0] == 350] == [(1, 8, 0)]


def test_rows_that_repeat_an_id(spark):
    rows = [(50, [1.0]), (50, [2.0]), (3, [1.0])]
    assert _found(spark, rows, k=2) == [
        (50, 1, 3, 131072), (50, 1, 50, 131072), (50, 2, 3, 65536), (50, 2, 50, 131072),
    ]


def test_large_components_stay_exact(spark):
    rows = [(0, [1.0e6, 3.0]), (1, [1.0e6, 5.0]), (2, [1.0e6, 4.0]), (3, [-1.0e6, 9.0])]
    rows = [(i, [x * 3 for x in v]) for i, v in rows]  # products beyond 2^53
    assert _found(spark, rows, schema="vec_id long, embedding array<double>") == brute.top_k(rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        _found(spark, [(0, [1e300]), (1, [1.0])], schema="vec_id long, embedding array<double>")


def test_no_rows_and_clashing_names(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(1, [1.0])]) == []
    rows = spark.createDataFrame(_random(1, 100), SCHEMA).withColumns({c: F.lit("x") for c in ("row", "id", "v", "block", "score")})
    found = top_k(integer_vectors(rows), F.col("id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(brute.top_k(_random(1, 100)))
