"""Hourly table from raw event rows."""

from pyspark.sql import DataFrame, functions as F

from ridemetrics.functions.clock import hour_timestamp
from ridemetrics.schema import HOURLY

# Which event type feeds which counter; drivers are counted once per hour.
EVENT_KINDS = {
    "eyeballs": "view",
    "zeroes": "error",
    "completed_trips": "purchase",
    "requests": "click",
    "drivers": "signup",
}


def hourly_facts(events: DataFrame, ts="ts", kind="event_type", user="user_id", kinds=EVENT_KINDS) -> DataFrame:
    """One row per hour that has events; events without a time form a row of their own.

    Grouped by date and hour of day, two cheap keys, and the timestamp is put together afterwards.
    The distinct users are written as ``count_distinct`` over one nullable column and not as a
    filtered aggregate, so Spark plans it without Expand: rows collapse on (hour, user) before
    the first shuffle, and neither a hot hour nor a hot user lands in one task.
    """
    is_kind = {name: F.col(kind) == value for name, value in kinds.items()}
    counts = [F.count_if(is_kind[name]).alias(name) for name in kinds if name != "drivers"]
    drivers = F.count_distinct(F.when(is_kind["drivers"], F.col(user))).alias("drivers")
    return (
        events.groupBy(F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))
        .agg(*counts, drivers)
        .withColumn("ts", hour_timestamp("date", "hour"))
        .select(*HOURLY)
    )
