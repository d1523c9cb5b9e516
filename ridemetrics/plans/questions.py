"""The ten questions over the hourly table.

Each ``qN`` returns its answer as a DataFrame; the table the answer is picked from has a function
of its own. Building an answer starts no Spark job; questions 6 and 8 need a table from ``prepare``,
which stores it in order and does.

Questions that only group the table say by which key, which sums they need of each group and what they make of
these. ``answers`` computes the groups of questions with one key in one pass over the table.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ridemetrics.functions.clock import hours, is_weekend
from ridemetrics.functions.measures import correlation, unmet_demand, zero_ratio
from ridemetrics.operators.frames import PLACE, dense_index, order_rows, rolling_sum, tumbling_day
from ridemetrics.operators.storage import store
from ridemetrics.operators.topk import bottom_rows, top_rows
from ridemetrics.schema import HOURLY, ROW_NO

# The correlation that counts as following, and the widths of the frames in rows.
_SUPPLY_FOLLOWS_DEMAND = 0.3
_REQUEST_ROWS = 8
_RATIO_ROWS = 72


@dataclass(frozen=True)
class Grouped:
    """A question over groups of the table: its key, what it needs of a group by name, and its last step."""

    key: tuple[str, ...]
    needs: Callable[[], dict[str, Column]]
    answer: Callable[[DataFrame], DataFrame]

    def groups(self, h: DataFrame) -> DataFrame:
        return _groups(h, self.key, self.needs())

    def __call__(self, h: DataFrame) -> DataFrame:
        return self.answer(self.groups(h))


def _groups(h, key, needs):
    return h.groupBy(*key).agg(*[column.alias(name) for name, column in needs.items()])


# Date with the most completed trips.
q1 = Grouped(
    ("date",),
    lambda: {"total_completed_trips": F.sum("completed_trips")},
    lambda groups: top_rows(groups.select("date", "total_completed_trips"), "total_completed_trips", ["date"]),
)


def trips_by_date(h: DataFrame) -> DataFrame:
    return q1.groups(h)


def trips_by_24h(h: DataFrame) -> DataFrame:
    return (
        tumbling_day(h.select("ts", "completed_trips"))
        .groupBy("window_start")
        .agg(F.sum("completed_trips").alias("completed_trips_per_24_hour"))
        .select("window_start", (F.col("window_start") + hours(24)).alias("window_end"), "completed_trips_per_24_hour")
    )


def q2(h: DataFrame) -> DataFrame:
    """Busiest 24-hour period, counted from the hour of the earliest row."""
    return top_rows(trips_by_24h(h), "completed_trips_per_24_hour", ["window_start"])


# Hour of day with the most requests.
q3 = Grouped(
    ("hour",),
    lambda: {"requests_per_hour": F.sum("requests")},
    lambda groups: top_rows(groups.select("hour", "requests_per_hour"), "requests_per_hour", ["hour"]),
)


def requests_by_hour(h: DataFrame) -> DataFrame:
    return q3.groups(h)


def _weekend_share(groups: DataFrame) -> DataFrame:
    share = F.try_divide(100.0 * F.col("weekend_zeroes"), F.col("total_zeroes").cast("double"))
    return groups.select("weekend_zeroes", "total_zeroes", share.alias("percentage"))


# Share of all zeroes that fall on the weekend, in percent; both sums in one pass.
q4 = Grouped(
    (),
    lambda: {"weekend_zeroes": F.sum(F.when(is_weekend("ts"), F.col("zeroes"))), "total_zeroes": F.sum("zeroes")},
    _weekend_share,
)


def _trips_per_driver(groups: DataFrame) -> DataFrame:
    trips, drivers = F.col("completed_trips_per_hour"), F.col("drivers_per_hour")
    known = groups.filter(F.col("hour").isNotNull()).select("hour", trips, drivers)
    return known.withColumn("weight", F.try_divide(trips.cast("double"), drivers.cast("double")))


def _weighted_average(groups: DataFrame) -> DataFrame:
    trips = F.col("completed_trips_per_hour").cast("double")
    return _trips_per_driver(groups).agg(
        F.try_divide(F.sum(trips * F.col("weight")), F.sum(trips)).alias("weighted_average")
    )


# Trips per driver, weighted by the trips of the hour of day. An hour of day without drivers adds nothing
# above the line and its trips below it.
q5 = Grouped(
    ("hour",),
    lambda: {"completed_trips_per_hour": F.sum("completed_trips"), "drivers_per_hour": F.sum("drivers")},
    _weighted_average,
)


def trips_per_driver_by_hour(h: DataFrame) -> DataFrame:
    return _trips_per_driver(q5.groups(h))


def _in_time_order(h: DataFrame, *columns: str) -> DataFrame:
    """The named columns of the rows that have a ``ts``, numbered in time order.

    Rows without ``ts`` come first in the order, so leaving them out keeps the numbers consecutive.
    """
    if not set(PLACE) <= set(h.columns):
        raise ValueError("this question needs a table in time order: pass it through prepare first")
    return dense_index(h.select("ts", *columns, *PLACE)).filter(F.col("ts").isNotNull())


def requests_in_8h(h: DataFrame) -> DataFrame:
    """Requests of each row and the seven after it."""
    return rolling_sum(_in_time_order(h, "requests"), "requests", 0, _REQUEST_ROWS - 1, "requests_in_8h").select("ts", "requests_in_8h")


def q6(h: DataFrame) -> DataFrame:
    """Busiest 8 consecutive hours in terms of requests."""
    return top_rows(requests_in_8h(h), "requests_in_8h", ["ts"]).select(
        F.col("ts").alias("start_time"), (F.col("ts") + hours(_REQUEST_ROWS)).alias("end_time"), "requests_in_8h"
    )


def _follows(groups: DataFrame) -> DataFrame:
    answer = F.coalesce(F.col("correlation") > _SUPPLY_FOLLOWS_DEMAND, F.lit(False))
    return groups.select("correlation", answer.alias("answer"))


def follows_demand(nulls: str = "zero") -> Grouped:
    """Whether driver supply rises with demand; ``nulls`` as in ``correlation``."""
    return Grouped((), lambda: {"correlation": correlation("requests", "drivers", nulls)}, _follows)


q7 = follows_demand()


def ratio_72h(h: DataFrame) -> DataFrame:
    """Hourly zeroes per eyeball, summed over each row and the 71 before it."""
    rows = _in_time_order(h, "zeroes", "eyeballs")
    return rolling_sum(rows, zero_ratio(), 1 - _RATIO_ROWS, 0, "ratio_72h").select("ts", "ratio_72h")


def q8(h: DataFrame) -> DataFrame:
    """72-hour period with the highest zeroes per eyeball."""
    return top_rows(ratio_72h(h), "ratio_72h", ["ts"]).select(
        (F.col("ts") - hours(_RATIO_ROWS)).alias("start_time"), F.col("ts").alias("end_time"), "ratio_72h"
    )


# Hour of day that most needs more drivers.
q9 = Grouped(
    ("hour",),
    lambda: {"unmet_demand_per_hour": F.sum(unmet_demand())},
    lambda groups: top_rows(groups.select("hour", "unmet_demand_per_hour"), "unmet_demand_per_hour", ["hour"]),
)


def unmet_demand_by_hour(h: DataFrame) -> DataFrame:
    return q9.groups(h)


_AVERAGES = ["avg_eyeballs", "avg_drivers", "avg_requests"]


def _activity(groups: DataFrame) -> DataFrame:
    score = F.col("avg_eyeballs") + F.col("avg_drivers") + F.col("avg_requests")
    return groups.select("hour", *_AVERAGES, score.alias("activity_score"))


# Hour of day with the least activity: the natural end of a day.
q10 = Grouped(
    ("hour",),
    lambda: {name: F.avg(name.removeprefix("avg_")) for name in _AVERAGES},
    lambda groups: bottom_rows(_activity(groups), "activity_score", ["hour"]),
)


def activity_by_hour(h: DataFrame) -> DataFrame:
    return _activity(q10.groups(h))


QUESTIONS = {1: q1, 2: q2, 3: q3, 4: q4, 5: q5, 6: q6, 7: q7, 8: q8, 9: q9, 10: q10}
# What each question reads.
COLUMNS = {
    1: ["date", "completed_trips"],
    2: ["ts", "completed_trips"],
    3: ["hour", "requests"],
    4: ["ts", "zeroes"],
    5: ["hour", "completed_trips", "drivers"],
    6: ["ts", "requests"],
    7: ["requests", "drivers"],
    8: ["ts", "zeroes", "eyeballs"],
    9: ["hour", "requests", "drivers"],
    10: ["hour", "eyeballs", "drivers", "requests"],
}
_READS_TWICE = {2}
_NEEDS_ORDER = {6, 8}


def prepare(h: DataFrame, ids: list[int], folder: str, ties: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """``h`` in the form that serves ``ids`` with one computation of it, and the columns they read.

    Stored below ``folder`` in time order if a rolling question is asked, so that all of them share
    one sort; stored as it is for several questions or one that reads it twice; otherwise left lazy.
    ``ties`` are columns that decide between equal times; by default the number of the row in its
    source, and where there is none all other columns, so that only equal rows are interchangeable.
    ``parts`` is passed on to ``order_rows``.
    """
    columns = [c for c in HOURLY if any(c in COLUMNS[i] for i in ids)]
    if _NEEDS_ORDER & set(ids):
        if ties is None:
            ties = [ROW_NO] if ROW_NO in h.columns else [c for c in HOURLY if c != "ts"]
        extra = [c for c in ties if c not in columns]
        return order_rows(h.select(*columns, *extra), ["ts", *ties], folder, drop=extra, parts=parts)
    if len(ids) > 1 or _READS_TWICE & set(ids):
        return store(h.select(*columns), folder, "hourly")
    return h


def answers(h: DataFrame, ids: list[int], folder: str) -> dict[int, DataFrame]:
    """The answers of ``ids`` from a table of ``prepare``, in their order.

    Questions with one key are answered from one table of groups, stored below ``folder``: the table is read once
    per key, however many questions there are. The others stay as lazy as they are by themselves.
    """
    by_key: dict[tuple[str, ...], list[int]] = {}
    for i in ids:
        if isinstance(QUESTIONS[i], Grouped):
            by_key.setdefault(QUESTIONS[i].key, []).append(i)
    found = {}
    for key, same in by_key.items():
        if len(same) > 1:
            needs = {name: column for i in same for name, column in QUESTIONS[i].needs().items()}
            groups = store(_groups(h, key, needs), folder, "groups")
            found |= {i: QUESTIONS[i].answer(groups) for i in same}
    return {i: found[i] if i in found else QUESTIONS[i](h) for i in ids}
