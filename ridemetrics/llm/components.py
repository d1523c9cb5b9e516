"""Connected components of a graph that is held as a table of edges."""

from pyspark.sql import DataFrame, functions as F

from ridemetrics.llm.common import store


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for all nodes of ``edges`` (``a``, ``b`` of one type); component is the least node.

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its
    smaller ones, on to the least node it knows. The edges of a hub are moved by a grouped minimum
    and a join, so no neighbourhood is gathered in one task. Each round is stored, and the number of
    rounds grows with the logarithm of the longest path. Loops and repeated edges do no harm.
    """
    now = store(_directed(edges.select("a", "b")), "edges")
    mark = None
    while (last := mark) != (mark := _fingerprint(now)):
        now = store(_small_star(store(_large_star(now), "edges")), "edges")
    members = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    alone = edges.filter(F.col("a") == F.col("b")).select(F.col("a").alias("node"), F.col("a").alias("component"))
    every = members.unionByName(roots).unionByName(alone)
    return every.groupBy("node").agg(F.min("component").alias("component"))


def _directed(edges):
    """Distinct edges from the larger to the smaller end."""
    ends = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    return ends.distinct()


def _fingerprint(edges):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges):
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    larger = edges.select(F.col("b").alias("a"), F.col("a").alias("v"))  # each end sees its larger neighbours
    # The least neighbours are stored so that both sides of the join come from a plain shuffle, which
    # adaptive execution can split at a hub.
    return larger.join(store(least, "least"), "a").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    # A node's smaller neighbours are few after the step before, so this key is not hot.
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return _directed(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        joined.select("a", F.col("m").alias("b"))
    ))
