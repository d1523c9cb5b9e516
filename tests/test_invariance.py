"""Same answers whatever the session settings, the order of the input and the way it is prepared."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import SF, SF_SMALL
from helpers import shuffled
from ridemetrics.plans.questions import QUESTIONS, prepare, requests_in_8h
from ridemetrics.sources.events import hourly_facts

# Answers of all questions over all rows, floats to six places.
GOLDEN = {
    SF_SMALL: {
        1: (date(2024, 1, 7), 15),
        3: (18, 18),
        4: (40, 201, 19.900498),
        5: (1.277895,),
        6: (datetime(2024, 1, 5, 21), datetime(2024, 1, 6, 5), 8),
        7: (-0.183591, False),
        8: (datetime(2024, 1, 6, 20), datetime(2024, 1, 9, 20), 15.5),
        9: (18, 14),
        10: (12, 0.227273, 0.318182, 0.272727, 0.818182),
    },
    SF: {
        1: (date(2024, 1, 23), 82),
        3: (13, 106),
        4: (414, 2014, 20.556107),
        5: (1.005127,),
        6: (datetime(2024, 1, 20, 11), datetime(2024, 1, 20, 19), 39),
        7: (0.006262, False),
        8: (datetime(2024, 1, 16, 3), datetime(2024, 1, 19, 3), 111.675),
        9: (13, 44),
        10: (21, 2.1, 2.266667, 2.633333, 7.0),
    },
}
FROM_FIVE = {
    SF_SMALL: (datetime(2024, 1, 17, 5), datetime(2024, 1, 18, 5), 13),
    SF: (datetime(2024, 1, 23, 5), datetime(2024, 1, 24, 5), 84),
}


def facts(spark, sf_dir):
    return hourly_facts(spark.read.parquet(f"{sf_dir}/events.parquet"))


def rounded(row):
    return tuple(round(v, 6) if isinstance(v, float) else v for v in row)


def answers(h):
    return {i: rounded(QUESTIONS[i](h).first()) for i in GOLDEN[SF]}


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF])
def test_golden_answers(spark, folder, sf_dir):
    table = prepare(facts(spark, sf_dir), list(QUESTIONS), folder)
    assert answers(table) == GOLDEN[sf_dir]
    late = facts(spark, sf_dir).filter(F.col("ts") >= F.lit(datetime(2024, 1, 1, 5)).cast("timestamp_ntz"))
    assert rounded(QUESTIONS[2](late).first()) == FROM_FIVE[sf_dir]


@pytest.mark.parametrize(
    "name, value",
    [
        ("spark.sql.ansi.enabled", "false"),
        ("spark.sql.session.timeZone", "Asia/Kolkata"),
        ("spark.sql.session.timeZone", "America/New_York"),
        ("spark.sql.shuffle.partitions", "1"),
        ("spark.sql.shuffle.partitions", "31"),
        ("spark.sql.adaptive.enabled", "false"),
    ],
)
def test_session_settings(spark, folder, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        assert answers(prepare(facts(spark, SF_SMALL), list(QUESTIONS), folder)) == GOLDEN[SF_SMALL]
    finally:
        spark.conf.set(name, before)


def test_order_of_the_input(spark, folder):
    assert answers(prepare(shuffled(facts(spark, SF_SMALL)), list(QUESTIONS), folder)) == GOLDEN[SF_SMALL]


def test_prepare_stores_only_what_is_read(spark, folder):
    h = facts(spark, SF_SMALL)
    assert prepare(h, [3], folder) is h
    assert prepare(h, [2], folder).columns == ["ts", "completed_trips"]
    assert prepare(h, [1, 3], folder).columns == ["date", "hour", "completed_trips", "requests"]
    assert prepare(h, [6], folder).columns == ["ts", "requests", "_part", "_pos"]
    assert prepare(h, [8, 2], folder).columns == ["ts", "eyeballs", "zeroes", "completed_trips", "_part", "_pos"]


def test_equal_times_are_ordered_by_the_other_columns(spark, folder):
    """Without a row number only equal rows are interchangeable."""
    h = facts(spark, SF_SMALL).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    one = [sorted(map(tuple, requests_in_8h(prepare(shuffled(x), [6], folder)).collect())) for x in (h, h.repartition(7))]
    assert one[0] == one[1]


@pytest.mark.parametrize("i", QUESTIONS)
def test_building_an_answer_starts_no_job(spark, folder, i):
    table = prepare(facts(spark, SF_SMALL), [i], folder)
    spark.sparkContext.setJobGroup(f"build-{i}", "")
    try:
        QUESTIONS[i](table)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{i}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("i", [6, 8])
def test_rolling_questions_refuse_an_unprepared_table(spark, i):
    with pytest.raises(ValueError, match="prepare"):
        QUESTIONS[i](facts(spark, SF_SMALL))
