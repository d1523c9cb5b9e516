"""Clustering of integer vectors around centroids, with distances from scalar lookup tables.

Components are whole numbers, and few different ones occur in a dimension. A block of vectors is
therefore stored as codes: per dimension the numbers that occur in it, and per vector the place of
its number among them. A round tabulates, for each dimension, occurring number and centroid, the
squared difference once; a distance is a sum of table entries gathered by code.

Vectors are encoded and stored once. A round is one pass over the blocks that hands on, per task,
a sum and a count for each centroid and dimension, so a cluster with most of the vectors is no
hot key. Only centroids, of a number that the caller sets, come to the driver.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ridemetrics.llm.common import LARGE_ROWS, set_up, store

DIMENSIONS = 64
CLUSTERS = 40
ROUNDS = 5
# Vectors of a block, at most; fewer where their components or distances would be many.
BLOCK_VECTORS = 2048
BLOCK_VALUES = 1 << 18
# Squared distances stay below 2^62 with components below this; beyond it is an error.
_LARGEST = 2.0**60


def kept_vectors(table: DataFrame, dimensions: int, factor: int, id_col: str, vector_col: str) -> DataFrame:
    """``id, v`` of the vectors with exactly ``dimensions`` components, none null or not finite;
    ``v`` holds floor(factor x component) as longs."""
    set_up(table.sparkSession)
    vectors = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    bound = (_LARGEST / dimensions) ** 0.5
    within = F.forall("v", lambda x: F.abs(F.lit(float(factor)) * x) < bound)
    scaled = F.transform("v", lambda x: F.floor(F.lit(float(factor)) * x))
    too_large = F.raise_error(F.lit("squared distances beyond 64 bits")).cast("array<long>")
    kept = vectors.filter(F.col("v").isNotNull() & (F.size("v") == dimensions) & finite)
    return kept.select("id", F.when(within, scaled).otherwise(too_large).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, dimensions: int, seed: str) -> np.ndarray:
    """The vectors whose ids have the smallest digests, a row each; all of them if there are fewer.

    A null id comes last; vectors with equal ids are ordered by their components.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = vectors.orderBy(F.asc_nulls_last(digest), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in first], np.int64).reshape(len(first), dimensions)


_BLOCK = "ids array<long>, numbers array<array<long>>, codes binary"


def _blocks(vectors: DataFrame, dimensions: int, clusters: int) -> DataFrame:
    """A row per block: ids, the numbers that occur in each dimension, and the codes by dimension (16 bits)."""
    size = max(1, min(BLOCK_VECTORS, BLOCK_VALUES // max(dimensions, clusters)))

    def encode(batches):
        for batch in batches:
            values = batch.column("v").flatten().to_numpy().reshape(-1, dimensions)
            for start in range(0, len(values), size):
                numbers, codes = [], []
                for column in values[start : start + size].T:
                    found, code = np.unique(column, return_inverse=True)
                    numbers.append(found)
                    codes.append(code.astype(np.uint16))
                ids = pa.array([batch.column("id")[start : start + size].to_pylist()], pa.list_(pa.int64()))
                nested = pa.array([numbers], pa.list_(pa.list_(pa.int64())))
                codes = pa.array([np.concatenate(codes).tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, nested, codes], ["ids", "numbers", "codes"])

    return store(vectors.mapInArrow(encode, _BLOCK), "blocks", LARGE_ROWS)


def _assigned(batches, centroids: np.ndarray):
    """Per block its ids, its vectors (a row per dimension), and each vector's centroid and distance."""
    dimensions = centroids.shape[1]
    for batch in batches:
        for ids, numbers, codes in zip(batch.column("ids"), batch.column("numbers"), batch.column("codes")):
            codes = np.frombuffer(codes.as_py(), np.uint16).reshape(dimensions, -1)
            numbers = [np.asarray(n, np.int64) for n in numbers.as_py()]
            total = np.zeros((codes.shape[1], len(centroids)), np.int64)
            for d in range(dimensions):
                table = (numbers[d][:, None] - centroids[:, d]) ** 2
                total += table.take(codes[d], axis=0)
            nearest = total.argmin(1)  # the first of equal ones
            vectors = np.stack([numbers[d].take(codes[d]) for d in range(dimensions)])
            yield ids.values, vectors, nearest, total[np.arange(len(total)), nearest]


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after a round: the floor of the mean of their vectors; those without vectors stay."""

    def add(batches):
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for _, vectors, nearest, _ in _assigned(batches, centroids):
            order = np.argsort(nearest, kind="stable")
            found, first = np.unique(nearest[order], return_index=True)
            sums[found] += np.add.reduceat(vectors[:, order], first, axis=1).T
            counts += np.bincount(nearest, minlength=len(centroids))
        cluster, dimension = np.nonzero(np.broadcast_to(counts[:, None] > 0, sums.shape))
        columns = [cluster, dimension, sums[cluster, dimension], counts[cluster]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "dimension", "sum", "n"])

    added = blocks.mapInArrow(add, "cluster long, dimension long, sum long, n long")
    added = added.groupBy("cluster", "dimension").agg(F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in added.collect():  # clusters x dimensions
        moved[row["cluster"], row["dimension"]] = int(row["sum"]) // row["n"]
    return moved


def cluster(
    table: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    factor: int = 256,
    seed: str = "2",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """Stored ``id, cluster, distance`` of each vector that takes part, and the final centroids.

    Vectors are scaled to whole numbers by ``factor``; null ones, those of another length and those
    with a null or not finite component take no part. Each round assigns every vector to the
    nearest centroid by squared Euclidean distance, the smaller number among equals, and moves the
    centroids; a last pass assigns without moving. Fewer vectors than ``clusters`` give as many
    centroids; none give an empty result. Rows that repeat an id are vectors of their own. Other
    columns are not read.
    """
    vectors = kept_vectors(table, dimensions, factor, id_col, vector_col)
    blocks = _blocks(vectors, dimensions, clusters)
    centroids = first_centroids(vectors, clusters, dimensions, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(blocks, centroids)

    def assign(batches):
        for ids, _, nearest, distance in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return store(blocks.mapInArrow(assign, "id long, cluster int, distance long"), "assigned"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia`` and ``inertia``, the distances summed over the cluster and over all, and
    ``centroid_sha256``, the digest of the centroid's components joined by commas."""
    spark = assigned.sparkSession
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    digests = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole: Column = assigned.agg(F.sum("distance")).scalar()
    # One row per centroid.
    sums = F.broadcast(sums.join(digests, "cluster").withColumn("inertia", whole))
    return assigned.join(sums, "cluster")
