"""Row frames over one global order, and offset day windows, without a single-task window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ridemetrics.functions.clock import hours, midnight
from ridemetrics.functions.exact import is_exact, joined, largest, limbs
from ridemetrics.operators.storage import store

PLACE = ["_part", "_pos"]
BUCKET_ROWS = 65536


def order_rows(
    df: DataFrame, order_by: list[str], folder: str, drop: list[str] = (), parts: int | None = None
) -> DataFrame:
    """``df`` stored in global order below ``folder``; ``_part`` and ``_pos`` give each row's place.

    Runs now: the sort picks its cuts from a sample and they may differ from run to run, which is why
    the order is stored before it is counted. ``order_by`` must be unique, or ties fall either way;
    with a unique one the parts hold about equal numbers of rows whatever the data, as even a value
    shared by most rows is cut. ``drop`` names columns that only serve the order, ``parts`` is the
    number of parts where Spark's setting does not suit.
    """
    if parts:
        ordered = df.repartitionByRange(parts, *order_by).sortWithinPartitions(*order_by)
    else:
        ordered = df.orderBy(*order_by)
    ordered = ordered.withColumn("_part", F.spark_partition_id()).drop(*drop)
    return store(ordered, folder, "ordered").withColumn("_pos", F.col("_metadata.row_index"))


def dense_index(ordered: DataFrame) -> DataFrame:
    """Replaces the place of a table from ``order_rows`` by ``rn``, the number of rows before.

    Filter rows only afterwards: the places count all of them.
    """
    kept = [c for c in ordered.columns if c not in PLACE]
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    # One small row per sort partition: as many as the parts asked for, or spark.sql.shuffle.partitions.
    numbered = ordered.join(F.broadcast(starts), "_part")
    return numbered.select(*kept, (F.col("_start") + F.col("_pos")).alias("rn"))


def rolling_sum(
    indexed: DataFrame,
    value: str | Column,
    first: int,
    last: int,
    name: str,
    bucket_rows: int | None = None,
    series: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Sum of ``value`` over the rows ``first``..``last`` around each row, cut short at both ends.

    ``indexed`` has consecutive ``rn``. Rows are dealt by it into buckets of consecutive rows, each
    of which also gets copies of the few neighbours its frames reach. Every bucket is a bounded
    sort, whatever the values; it holds at least four times the reach, so the copies add a quarter
    of the rows at most. Frames stop at the ends of a series where ``series`` names the columns that the order
    of ``indexed`` begins with: a bucket is then cut at these ends, and one long series in buckets like any other.

    Whole numbers are summed as the difference of two running sums, in time that does not depend on
    the width; only a frame whose own sum is beyond a long is an error. Doubles are summed by a sliding
    frame, which adds them in row order; with ``exact`` as a difference of sums that lose nothing, so
    that the order does not matter and neither does the width (a job finds the largest magnitude first).
    """
    value = F.col(value) if isinstance(value, str) else value
    reach = max(last, 0) - min(first, 0)
    size = bucket_rows or max(BUCKET_ROWS, 4 * reach)

    def bucket(shift):
        return F.expr(f"(rn + {shift}L) div {size}L")

    # Buckets whose rows reach this one, its own among them also when the frame leaves the row out.
    reached = F.sequence(bucket(-max(last, 0)), bucket(-min(first, 0)))
    rows = indexed.withColumn("_value", value)
    dealt = rows.withColumn("_bucket", F.explode(reached))
    stretch = Window.partitionBy("_bucket", *series).orderBy("rn")
    kind = rows.schema["_value"].dataType
    if isinstance(kind, T.IntegralType) or exact:
        scale = None if is_exact(kind) else largest(rows, F.col("_value"))
        summed = _difference(dealt, kind, scale, stretch, first, last, name)
    else:
        summed = dealt.withColumn(name, F.sum("_value").over(stretch.rowsBetween(first, last)))
    return summed.filter(bucket(0) == F.col("_bucket")).drop("_value", "_bucket", "rn")


def _difference(dealt, kind, scale, stretch, first, last, name):
    """Frame sums from running sums; a frame without a value gives null, as a sum does."""
    so_far = stretch.rowsBetween(Window.unboundedPreceding, 0)
    # Sums of the limbs and count of the values up to each row.
    parts = {f"s{i}": limb for i, limb in enumerate(limbs(F.col("_value"), kind, scale))}
    dealt = dealt.withColumns({f"_{k}": limb for k, limb in parts.items()})
    running = [F.sum(f"_{k}").over(so_far).alias(k) for k in parts]
    running = dealt.withColumn("_run", F.struct(*running, F.count("_value").over(so_far).alias("n")))
    whole = stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def up_to(offset):
        if offset >= 0:
            return F.coalesce(F.lead("_run", offset).over(stretch), F.last("_run").over(whole))
        return F.lag("_run", -offset).over(stretch)

    running = running.withColumns({"_to": up_to(last), "_before": up_to(first - 1)})
    count = F.col("_to.n") - F.coalesce("_before.n", F.lit(0))
    sums = [F.col(f"_to.{k}") - F.coalesce(F.col(f"_before.{k}"), F.lit(0)) for k in parts]
    total = F.when(count > 0, joined(sums, kind, scale))
    return running.withColumn(name, total).drop("_run", "_to", "_before", *[f"_{k}" for k in parts])


def tumbling_day(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds ``window_start``: 24-hour windows that begin at the hour of the earliest ``ts``.

    Rows without ``ts`` are dropped. The earliest value is a scalar subquery, so ``df`` is read
    twice: pass a stored table where it is costly to compute.
    """
    rows = df.filter(F.col(ts).isNotNull())
    offset = hours(F.hour(rows.agg(F.min(ts)).scalar()))
    return rows.withColumn("window_start", midnight(F.col(ts) - offset) + offset)
