"""Forward fill that does not gather the table in one task."""

from pyspark.sql import DataFrame, Window, functions as F

from ridemetrics.operators.scan import totals_ahead

# Rows that are filled together.
BLOCK_ROWS = 1 << 18


def last_before(column: str, block: list[str]):
    """Last non-null ``column`` of the blocks before; over a table of one row per block."""
    return F.last(column, ignorenulls=True).over(Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1))


def last_value(column: str, order: str):
    """Aggregate: non-null ``column`` of the row with the largest ``order``."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order)))


def spread(df: DataFrame, seeds: DataFrame, columns: list[str], gather: list[str], order: str) -> DataFrame:
    """Fills nulls in ``columns`` by the last value before them, starting anew at each seed.

    A seed has the columns ``gather``, ``order`` and ``columns`` and takes effect ahead of the row
    with the same ``order``; a null in it clears the value. Seeds travel as rows, so there is one
    shuffle and no join. ``gather`` groups must be of bounded size.
    """
    rows = df.withColumn("_seed", F.lit(False))
    rows = rows.unionByName(seeds.withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    so_far = Window.partitionBy(*gather).orderBy(order, F.desc("_seed")).rowsBetween(Window.unboundedPreceding, 0)

    def latest(name):
        known = F.when(F.col("_seed") | F.col(name).isNotNull(), F.struct(name))
        return F.last(known, ignorenulls=True).over(so_far)[name]

    return rows.withColumns({name: latest(name) for name in columns}).filter(~F.col("_seed")).select(*df.columns)


def forward_fill(df: DataFrame, column: str, block: list[str], order: str) -> DataFrame:
    """Replaces nulls in ``column`` by the last value before them; leading nulls stay.

    ``order`` is unique within a block. ``block`` columns ascend with it and cut the rows into pieces
    of bounded size; for ranges of a key it must be unique and dense, otherwise see ``fill_ordered``.
    Each block is filled on its own, from a seed that holds
    what the blocks before it left; only the table of blocks, one row per block, is ordered as a
    whole. ``df`` is read twice. Fixed-width values are cheapest: strings sort where they could hash.
    """
    blocks = df.groupBy(*block).agg(last_value(column, order).alias("_tail"), F.min(order).alias(order))
    seeds = blocks.select(*block, order, last_before("_tail", block).alias(column))
    return spread(df, seeds, [column], block, order)


def fill_ordered(ordered: DataFrame, column: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``forward_fill`` of a table from ``order_rows``, whatever the values of its order.

    Blocks are cut by position, so none holds more than ``block_rows`` rows and there are no more
    blocks than that calls for, however the keys are spread. The table of blocks is scanned in levels, so
    it may be as long as it likes.
    """
    rows = ordered.withColumn("_block", F.expr(f"_pos div {block_rows}L"))
    block = ["_part", "_block"]
    blocks = rows.groupBy(*block).agg(last_value(column, "_pos").alias("_tail"), F.min("_pos").alias("_pos"))
    seeds = totals_ahead(blocks, lasts=["_tail"]).select(*block, "_pos", F.col("_tail_ahead").alias(column))
    return spread(rows, seeds, [column], block, "_pos").drop("_block")
