"""Range frames: sums over the rows whose key lies within a distance, in one global order."""

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ridemetrics.functions.exact import is_exact, joined, largest, limbs
from ridemetrics.operators.frames import order_rows
from ridemetrics.operators.scan import totals_ahead
from ridemetrics.operators.storage import store

# Rows of the order that one running sum spans.
BLOCK_ROWS = 65536
# A key is frequent if it has at least one row in so many, so there are no more frequent keys than that.
FREQUENT = 1000
_EPOCH = {"timestamp": "TIMESTAMP_LTZ'1970-01-01 00:00:00Z'", "timestamp_ntz": "TIMESTAMP_NTZ'1970-01-01 00:00:00'"}


def _place(df: DataFrame, key: str) -> Column:
    """The key on a line of whole numbers: itself, days of a date, microseconds of a timestamp."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(key).cast("long")
    if isinstance(kind, T.DateType):
        return F.datediff(key, F.lit("1970-01-01").cast("date")).cast("long")
    if kind.simpleString() in _EPOCH:
        return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH[kind.simpleString()]), F.col(key))
    raise TypeError(f"range frames need a whole number, a date or a timestamp, not {kind.simpleString()}")


def _distance(df: DataFrame, key: str, reach: int | timedelta) -> int:
    if not isinstance(reach, timedelta):
        return reach
    return reach.days if isinstance(df.schema[key].dataType, T.DateType) else reach // timedelta(microseconds=1)


def range_sum(
    df: DataFrame,
    value: str | Column,
    key: str,
    first: int | timedelta,
    last: int | timedelta,
    name: str,
    folder: str,
    series: Sequence[str] = (),
    parts: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows whose ``key`` lies from ``first`` to ``last`` off the row's own.

    As a window's ``RANGE BETWEEN``, within each series where ``series`` names columns: rows of one key have one
    frame, and rows without a key are a frame of their own. ``first`` and ``last`` are whole numbers, or
    durations for dates and timestamps. A frame without a value gives null. Doubles are summed exactly and
    rounded once, so the order of the rows does not matter. ``df`` is read twice or, for doubles, three times; tables are stored below ``folder``.

    Rows collapse to distinct keys, in the map task already, so one key with most of the rows is one row. Each
    distinct key asks what lies up to either end of its frame. Questions and keys are sorted together and the running
    sums are taken over blocks by position: no task holds more than a block, however wide the frame
    and however dense the keys. The answers meet by key, two rows each.
    """
    value = F.col(value) if isinstance(value, str) else value
    first, last = _distance(df, key, first), _distance(df, key, last)
    keys = [f"_k{i}" for i in range(len(series))]
    named = df.withColumns({"_v": value, "_at": _place(df, key), **{k: F.col(c) for k, c in zip(keys, series)}}).drop(name)
    kind = named.schema["_v"].dataType
    scale = None if is_exact(kind) else largest(named, F.col("_v"))
    split = limbs(F.col("_v"), kind, scale, wide=True)
    sums = [f"_s{i}" for i in range(len(split))]
    distinct = named.groupBy(*keys, "_at").agg(
        *[F.sum(limb).alias(s) for s, limb in zip(sums, split)],
        F.count("_v").alias("_n"),
        F.count(F.lit(1)).cast("long").alias("_rows"),
    )
    distinct = store(distinct, folder, "keys")

    found = _up_to_both_ends(distinct.filter(F.col("_at").isNotNull()), keys, sums, first, last, folder, parts, block_rows)
    alone = distinct.filter(F.col("_at").isNull()).select(*keys, "_at", *sums, "_n")
    answers = found.unionByName(alone).select(
        *[F.col(k).alias(f"{k}_of") for k in keys],
        F.col("_at").alias("_at_of"),
        F.when(F.col("_n") > 0, joined([F.col(s) for s in sums], kind, scale)).alias(name),
    )
    # Each frame is computed once for all rows of its key and read by two joins.
    answers = store(answers, folder, "frames")
    whole = [c for c in df.columns if c != name]
    return _joined_by_key(named, answers, distinct, keys).select(*[F.col(f"`{c}`") for c in whole], name)


def _up_to_both_ends(distinct, keys, sums, first, last, folder, parts, block_rows):
    """Per distinct key the sums over its frame: what lies up to its end, less what lies ahead of it."""
    nothing = {s: F.lit(0).cast(distinct.schema[s].dataType) for s in [*sums, "_n"]}

    def entry(side, place, rank, counted):
        return F.struct(F.lit(side).alias("_side"), place.alias("_place"), rank.alias("_rank"), *[c.alias(s) for s, c in counted.items()])

    def end(side, by, rank):
        moved = F.try_add("_at", F.lit(by).cast("long"))
        # Off the line of whole numbers: past all keys, or ahead of them.
        beyond, past_all = (2**63 - 1, 3) if by > 0 else (-(2**63), -1)
        return entry(side, F.coalesce(moved, F.lit(beyond)), F.when(moved.isNull(), past_all).otherwise(rank), nothing)

    # At equal places the front end comes ahead of the key and the back end behind it.
    own = entry("key", F.col("_at"), F.lit(1), {s: F.col(s) for s in nothing})
    ends = [own, end("front", first, 0), end("back", last, 2)]
    line = distinct.select(*keys, "_at", F.explode(F.array(*ends)).alias("_e")).select(*keys, "_at", "_e.*")
    line = order_rows(line, [*keys, "_place", "_rank", "_at"], folder, drop=["_place", "_rank"], parts=parts)
    line = line.withColumn("_block", F.expr(f"_pos div {block_rows}L"))
    counted = [*sums, "_n"]
    blocks = line.groupBy("_part", "_block").agg(*[F.sum(c).alias(c) for c in counted])
    ahead = totals_ahead(blocks, counted).select("_part", "_block", *[f"{c}_ahead" for c in counted])
    so_far = Window.partitionBy("_part", "_block").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumns({c: F.sum(c).over(so_far) for c in counted}).filter("_side != 'key'").join(ahead, ["_part", "_block"])
    total = {c: F.col(c) + F.col(f"{c}_ahead") for c in counted}
    is_back = F.col("_side") == "back"
    return line.groupBy(*keys, "_at").agg(
        *[(F.sum(F.when(is_back, x)) - F.sum(F.when(~is_back, x))).cast(distinct.schema[c].dataType).alias(c) for c, x in total.items()]
    )


def _joined_by_key(rows, answers, distinct, keys):
    """Rows with the answer of their key. Frequent keys, at most FREQUENT, are broadcast; no other key is hot."""
    of = [*keys, "_at"]
    total = distinct.agg(F.sum("_rows")).scalar()
    frequent = distinct.filter(F.col("_rows") * FREQUENT >= total).select(*[F.col(c).alias(f"{c}_hot") for c in of])
    hot = answers.join(F.broadcast(frequent), _same(of, "_of", "_hot"), "left_semi")

    def answered(rows, answers):
        return rows.join(answers, _same(of, "", "_of"))

    many = answered(rows, F.broadcast(hot))
    few = answered(rows.join(F.broadcast(frequent), _same(of, "", "_hot"), "left_anti"), answers)
    return many.unionByName(few)


def _same(names, left, right):
    condition = F.lit(True)
    for c in names:
        condition &= F.col(f"{c}{left}").eqNullSafe(F.col(f"{c}{right}"))
    return condition
