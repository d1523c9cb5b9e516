"""Exact top-k search by inner product over integer vectors, by distributed histogram selection.

Every candidate is scored against every query, a block of queries at a time. A round counts the
scores of each query in a histogram over the range that holds its k-th best score; the counts of all
tasks are added up, and the bin of the k-th best score is the next round's range, until a bin is one
whole number. Scores are not kept: a round computes them anew, which costs a matrix product and no
disk. The last pass keeps the scores that reach the k-th best one and breaks ties by id.

A task hands on only the upper end of its histograms, up to its own k-th best score. As no global k-th
best score is below a task's own, the bins that decide are complete, and a task hands on at most k
bins of a query, however many candidates it has. The same holds for the ties of the last pass.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ridemetrics.llm.common import set_up, shared_folder, store

K = 5
# Queries and vector components of a block, which is broadcast; an only query may be larger.
BLOCK_QUERIES = 2048
BLOCK_VALUES = 1 << 21
# A round splits the range of a k-th best score into so many bins.
BIN_BITS = 10
# Scores that a task holds at a time.
CELLS = 1 << 20
# Doubles add whole numbers up to this one without rounding.
_EXACT = 1 << 53


def integer_vectors(table: DataFrame, factor: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Stored rows ``row, id, v``: a number for each row, its id, and floor(factor x component) as longs.

    Vectors that are null or hold a null, an infinite or no number take no part. A product beyond a
    long is an error. Other columns are not read.
    """
    set_up(table.sparkSession)
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    scaled = F.transform("v", lambda x: F.floor(F.lit(float(factor)) * x))
    within = F.forall("v", lambda x: F.abs(F.lit(float(factor)) * x) < 2.0**62)
    vectors = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    vectors = vectors.filter(F.col("v").isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"),
        "id",
        F.when(within, scaled).otherwise(F.raise_error(F.lit("component beyond 64 bits")).cast("array<long>")).alias("v"),
    )
    return store(vectors, "vectors")


class _Block:
    """Queries of one block by the length of their vectors; sent to all tasks."""

    def __init__(self, table: pa.Table, limit: int):
        table = table.sort_by("row")
        self.rows = table.column("row").to_numpy()
        self.ids = table.column("id").to_pylist()
        self.limit = limit  # no product is larger
        self.cells = CELLS
        kind = np.float64 if limit < _EXACT else np.int64
        vectors = [np.asarray(v, kind) for v in table.column("v").to_pylist()]
        lengths = np.array([len(v) for v in vectors])
        self.matrices = {}
        for n in np.unique(lengths).tolist():
            of = np.flatnonzero(lengths == n)
            self.matrices[n] = of, np.stack([vectors[i] for i in of]).T.reshape(n, len(of))
        self.kind = kind

    def scores(self, batches):
        """``(scores, queries, ids, has_id)`` for pieces of the candidates: a row each, a column per query.

        Vectors of another length than a query's have no product with it. A query's own row scores less than
        all others can.
        """
        for batch in batches:
            lists = batch.column("v")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            lengths = np.diff(offsets)
            ids = batch.column("id").fill_null(0).to_numpy()
            has_id = batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            rows = batch.column("row").to_numpy()
            for n, (of, matrix) in self.matrices.items():
                same = np.flatnonzero(lengths == n)
                step = max(1, self.cells // max(len(of), n))
                for start in range(0, len(same), step):
                    part = same[start : start + step]
                    vectors = flat[offsets[part][:, None] + np.arange(n)].astype(self.kind)
                    scores = vectors @ matrix
                    place = np.minimum(np.searchsorted(self.rows[of], rows[part]), len(of) - 1)
                    own = self.rows[of][place] == rows[part]
                    scores[np.flatnonzero(own), place[own]] = -self.limit - 1
                    yield scores, of, ids[part], has_id[part]


def _histograms(vectors: DataFrame, shared, low, need, is_open, bits: int, shift: int) -> DataFrame:
    """``query, need, bin, n``: the upper ends of the tasks' histograms of the 2^``bits`` scores from ``low`` on."""
    bins = 1 << BIN_BITS

    def count(batches):
        block = shared.value
        counts = np.zeros((len(low), bins), np.int64)
        for scores, of, *_ in block.scores(batches):
            place = scores - low[of].astype(block.kind)
            inside = (place >= 0) & (place < 1 << bits) & is_open[of]
            query = np.broadcast_to(of, scores.shape)[inside]
            place = place[inside]
            # A power of two divides without rounding.
            place = (place * 0.5**shift).astype(np.int64) if block.kind is np.float64 else place >> shift
            counts += np.bincount(query * bins + place, minlength=counts.size).reshape(counts.shape)
        above = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
        query, at = np.nonzero((counts > 0) & (above < need[:, None]))
        columns = [query, need[query], at, counts[query, at]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "need", "bin", "n"])

    counted = vectors.mapInArrow(count, "query long, need long, bin long, n long")
    return counted.groupBy("query", "need", "bin").agg(F.sum("n").alias("n"))


def _kth_best(vectors: DataFrame, shared, n_queries: int, limit: int, k: int) -> np.ndarray:
    """The k-th best score of each query of a block; where there are fewer scores, less than all of them."""
    low = np.full(n_queries, -limit, np.int64)
    need = np.full(n_queries, k, np.int64)
    is_open = np.ones(n_queries, bool)
    bits = (2 * limit + 1).bit_length()
    while bits:
        shift = max(0, bits - BIN_BITS)
        so_far = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        found = _histograms(vectors, shared, low, need, is_open, bits, shift).withColumn("sum", F.sum("n").over(so_far))
        found = found.filter("sum >= need AND sum - n < need").select("query", "bin", F.col("sum") - F.col("n"))
        found = [c.to_numpy() for c in found.toArrow().columns]  # a row per query of the block
        is_open[:] = False
        is_open[found[0]] = True
        low[found[0]] += found[1] << shift
        need[found[0]] -= found[2]
        bits = shift
    return low


_ANSWER = "query_row long, query_id long, vec_id long, score long"


def _reaching(vectors: DataFrame, shared, low: np.ndarray, k: int) -> DataFrame:
    """Candidates that reach the k-th best score; of each task the ``k`` first by score and id."""

    def keep(batches):
        block = shared.value
        held = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]
        for scores, of, ids, has_id in block.scores(batches):
            row, column = np.nonzero((scores >= low[of]) & (scores >= -block.limit))
            new = of[column], scores[row, column].astype(np.int64), ids[row], has_id[row]
            query, score, vec_id, known = (np.concatenate(x) for x in zip(held, new))
            order = np.lexsort((vec_id, ~known, -score, query))
            query = query[order]
            rank = np.arange(len(query)) - np.searchsorted(query, query)
            best = order[rank < k]
            held = [query[rank < k], score[best], vec_id[best], known[best]]
        query, score, vec_id, known = held
        names = [c.split()[0] for c in _ANSWER.split(", ")]
        ids = pa.array([block.ids[q] for q in query.tolist()], pa.int64())
        columns = [pa.array(block.rows[query]), ids, pa.array(vec_id, mask=~known), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names)

    return vectors.mapInArrow(keep, _ANSWER)


def _in_blocks(queries: DataFrame, path: str) -> int:
    """Writes the queries by block; returns how many blocks there are. No query is in two."""
    n = queries.count()
    blocks = max(1, -(-n // BLOCK_QUERIES))
    while True:
        block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        sizes = queries.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v")).alias("values"))
        crowded = (F.col("n") > 1) & ((F.col("n") > 2 * BLOCK_QUERIES) | (F.col("values") > BLOCK_VALUES))
        if sizes.filter(crowded).isEmpty():
            break
        blocks *= 2
    queries.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(path)
    return blocks if n else 0


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest inner products of each query, ranks from 1.

    ``vectors`` comes from ``integer_vectors``; the rows for which ``is_query`` holds are the queries, and
    all rows but the query's own are its candidates. Equal scores are ranked by id, a null id last; a
    query with fewer candidates gets all of them. Rows that repeat an id are queries and candidates of
    their own; vectors of different lengths have no product; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    largest, largest_query = vectors.agg(F.max(square), F.max(F.when(is_query, square))).first()
    # By Cauchy and Schwarz; the slack covers the rounding of the norms.
    limit = int(((largest or 0.0) * (largest_query or 0.0)) ** 0.5 * (1 + 1e-9)) + 1
    if limit >= 1 << 62:
        raise ValueError("inner products beyond 64 bits")
    by_block, answers = shared_folder(spark, "queries"), shared_folder(spark, "answers")
    blocks = _in_blocks(vectors.filter(is_query), by_block)
    spark.createDataFrame([], _ANSWER).write.parquet(answers)
    for number in range(blocks):
        table = spark.read.schema("row long, id long, v array<long>, block int").parquet(by_block).filter(F.col("block") == number)
        block = _Block(table.select("row", "id", "v").toArrow(), limit)
        if not len(block.rows):
            continue
        shared = spark.sparkContext.broadcast(block)
        low = _kth_best(vectors, shared, len(block.rows), limit, k)
        _reaching(vectors, shared, low, k).write.mode("append").parquet(answers)
        shared.destroy()
    ranked = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    found = spark.read.schema(_ANSWER).parquet(answers).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
