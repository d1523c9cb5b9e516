"""What lies ahead of each block of a stored order, without one task that sees all blocks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def totals_ahead(
    blocks: DataFrame, sums: Sequence[str] = (), lasts: Sequence[str] = (), part: Sequence[str] = ("_part",), block: str = "_block"
) -> DataFrame:
    """``blocks`` with ``<name>_ahead`` over all blocks before: the sum of each of ``sums``, 0 for none, and the last
    non-null value of each of ``lasts``.

    One row per ``part`` and ``block``, which together give the order. Blocks are scanned within their part, and
    only the parts, a row per task that wrote or read the order, as a whole.
    """
    level = blocks.groupBy(*part).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(block))).alias(c) for c in lasts],
    )
    columns = [*[(c, F.sum(c)) for c in sums], *[(c, F.last(c, ignorenulls=True)) for c in lasts]]
    within = Window.partitionBy(*part).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    inside = blocks.withColumns({f"_{c}_inside": x.over(within) for c, x in columns})
    parts = level.select(*part, *[x.over(whole).alias(f"_{c}_parts") for c, x in columns])
    none = F.lit(0)
    ahead = {f"{c}_ahead": F.coalesce(f"_{c}_inside", none) + F.coalesce(f"_{c}_parts", none) for c in sums}
    ahead |= {f"{c}_ahead": F.coalesce(f"_{c}_inside", f"_{c}_parts") for c in lasts}
    return inside.join(parts, [*part]).select(*[inside[c] for c in blocks.columns], *[x.alias(n) for n, x in ahead.items()])
