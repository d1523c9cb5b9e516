from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plain, plan
from ridemetrics.schema import HOURLY
from ridemetrics.sources.events import hourly_facts

SCHEMA = "ts timestamp_ntz, user_id long, event_type string"


def test_counts_of_an_hour(spark):
    at = datetime(2024, 1, 1, 5, 59, 59)
    rows = [(at, 1, "view"), (at, 1, "view"), (at, 1, "signup"), (at, 1, "signup"), (at, 2, "signup")]
    rows += [(at, None, "signup"), (at, 3, "click"), (at, 3, None), (datetime(2024, 1, 1, 6), 4, "other")]
    facts = hourly_facts(spark.createDataFrame(rows, SCHEMA))
    assert facts.columns == HOURLY
    assert plain(facts) == [
        (datetime(2024, 1, 1, 5), at.date(), 5, 2, 0, 0, 1, 2),
        (datetime(2024, 1, 1, 6), at.date(), 6, 0, 0, 0, 0, 0),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hours_are_those_of_the_wall_clock(spark, zone):
    """02:30 does not exist on that day in New York."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(datetime(2024, 3, 10, 2, 30, 15, 5), 1, "view"), (None, 1, "view")]
        facts = hourly_facts(spark.createDataFrame(rows, SCHEMA))
        assert {(r.ts, r.hour, r.eyeballs) for r in facts.collect()} == {
            (datetime(2024, 3, 10, 2), 2, 1),
            (None, None, 1),
        }
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_hot_hour_and_user(spark):
    """A third of the rows in one hour and of one user."""
    hot = F.col("id") % 3 == 0
    events = spark.range(30000).select(
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.when(hot, 0).otherwise(F.col("id") % 24))).alias("ts"),
        F.when(hot, 0).otherwise(F.col("id")).alias("user_id"),
        F.lit("signup").alias("event_type"),
    )
    got = {r.ts: r.drivers for r in hourly_facts(events).collect()}
    expected = {r.ts: r.n for r in events.groupBy("ts").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got == expected


def test_plan_has_no_expand_and_prunes(spark):
    events = spark.createDataFrame([], SCHEMA)
    assert "Expand" not in plan(hourly_facts(events))
    # A question that ignores drivers does not pay for the distinct count.
    assert "distinct" not in plan(hourly_facts(events).groupBy("hour").agg(F.sum("requests")))
