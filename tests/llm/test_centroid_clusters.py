import math
import random

import pytest
from pyspark.sql import functions as F

import brute
from ridemetrics.llm import centroid_clusters
from ridemetrics.llm.centroid_clusters import cluster, with_inertia
from ridemetrics.llm.queries import op13_centroid_clustering

SCHEMA = "vec_id long, embedding array<double>"


def _found(df, **options):
    found = with_inertia(*cluster(df, **options)).collect()
    return {r["id"]: (r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in found}


@pytest.mark.parametrize("block", [1, 7, 2048])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(centroid_clusters, "BLOCK_VECTORS", block)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    found = _found(spark.createDataFrame(rows, SCHEMA).repartition(4), dimensions=6, clusters=9)
    assert found == brute.clusters(rows, 6, 9)


def test_all_rows_of_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = {r["vec_id"]: tuple(r)[1:] for r in op13_centroid_clustering(spark, sf_dir).collect()}
    assert found == brute.clusters(rows)


def test_ties_empty_clusters_and_negative_means(spark):
    # Equal vectors tie for all their centroids, and only the first of these gets them.
    rows = [(i, [-1.0 / 256, 0.5]) for i in range(60)] + [(100 + i, [-i / 256, 0.0]) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "v", "cluster", "ids", "codes")})
    found = _found(df, dimensions=2, clusters=12)
    assert found == brute.clusters(rows, 2, 12)
    assert len({v[0] for v in found.values()}) < 12


def test_edges(spark):
    rows = [(1, [0.5, 0.5]), (2, None), (3, [0.5]), (4, [None, 1.0]), (5, [math.nan, 1.0]), (6, [0.0, -math.inf]), (7, [2.0, 1.0])]
    found = _found(spark.createDataFrame(rows, SCHEMA), dimensions=2, clusters=5)
    assert found == brute.clusters(rows, 2, 5) and set(found) == {1, 7}
    empty = spark.createDataFrame([], SCHEMA)
    assert _found(empty) == {}
    repeated = spark.createDataFrame([(None, [1.0]), (3, [1.0]), (3, [1.0]), (3, [9.0])], SCHEMA)
    assigned, centroids = cluster(repeated, dimensions=1, clusters=2)
    assert sorted(centroids.ravel().tolist()) == [256, 2304] or centroids.ravel().tolist() == [256, 256]
    assert assigned.count() == 4
    with pytest.raises(Exception, match="beyond 64 bits"):
        _found(spark.createDataFrame([(1, [1e12])], SCHEMA), dimensions=1)
