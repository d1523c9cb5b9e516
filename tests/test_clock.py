from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ridemetrics.functions.clock import hour_timestamp, is_weekend, label_date

DAY = date(2012, 9, 10)


@pytest.mark.parametrize(
    "day, hour, expected",
    [
        (DAY, 0, datetime(2012, 9, 10, 0)),
        (DAY, 23, datetime(2012, 9, 10, 23)),
        (DAY, 24, None),
        (DAY, -1, None),
        (DAY, None, None),
        (None, 7, None),
    ],
)
def test_hour_timestamp(spark, day, hour, expected):
    df = spark.createDataFrame([(day, hour)], "date date, hour int").select(hour_timestamp("date", "hour").alias("ts"))
    assert df.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert df.first().ts == expected


@pytest.mark.parametrize(
    "label, expected", [("10-Sep-12", DAY), ("9-Sep-12", None), ("2012-09-10", None), ("x", None), (None, None)]
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_label_date(spark, label, expected, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(label,)], "label string")
        assert df.select(label_date("label", "dd-MMM-yy")).first()[0] == expected
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize(
    "ts, expected",
    [
        ("2024-01-05 16:59:59", False),
        ("2024-01-05 17:00:00", True),
        ("2024-01-06 00:00:00", True),
        ("2024-01-06 23:00:00", True),
        ("2024-01-07 03:59:59", True),
        ("2024-01-07 04:00:00", False),
        ("2024-01-08 12:00:00", False),
    ],
)
def test_weekend(spark, ts, expected):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ '{ts}' AS ts")
    assert df.select(is_weekend(F.col("ts"))).first()[0] is expected
