import re
from datetime import datetime
from fractions import Fraction

import pytest
from pyspark.sql import Window, functions as F

from conftest import SF, SF_SMALL
from helpers import hourly, plain, plan, shuffled
from ridemetrics.operators.frames import dense_index, order_rows, rolling_sum, tumbling_day
from ridemetrics.plans.questions import requests_in_8h
from ridemetrics.sources.events import hourly_facts

FRAMES = [(0, 7), (-71, 0), (-3, 3), (2, 5), (-9, -4)]


def naive(df, order_by, first, last):
    frame = Window.orderBy(*order_by).rowsBetween(first, last)
    return df.withColumn("rolled", F.sum("v").over(frame))


@pytest.fixture(scope="module")
def gappy(spark):
    facts = hourly_facts(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    return shuffled(facts.select("ts", F.col("requests").alias("v"))).cache()


@pytest.mark.parametrize("first, last", FRAMES)
@pytest.mark.parametrize("bucket_rows", [1, 7, 72, 1000])
def test_equals_the_plain_window(spark, gappy, folder, first, last, bucket_rows):
    rolled = rolling_sum(dense_index(order_rows(gappy, ["ts"], folder)), "v", first, last, "rolled", bucket_rows)
    assert rolled.columns == ["ts", "v", "rolled"]
    assert plain(rolled) == plain(naive(gappy, ["ts"], first, last))


def test_dense_index_over_parts(spark, many_parts, folder):
    ids = shuffled(spark.range(5000).repartition(5))
    ordered = order_rows(ids, ["id"], folder)
    assert ordered.select("_part").distinct().count() > 1
    assert dense_index(ordered).filter("rn != id").count() == 0
    assert dense_index(ordered).count() == 5000


def test_a_value_that_most_rows_share_is_cut(spark, many_parts, folder):
    """Half of the rows have one timestamp; the unique second key lets the sort split them."""
    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 100)
    df = spark.range(20000).select("id", hot.alias("ts"), (F.col("id") % 11).alias("v"))
    ordered = order_rows(df, ["ts", "id"], folder)
    sizes = [r["count"] for r in ordered.groupBy("_part").count().collect()]
    assert max(sizes) < 2 * 20000 / len(sizes)
    rolled = rolling_sum(dense_index(ordered), "v", -71, 0, "rolled", 300)
    assert plain(rolled.select("id", "rolled")) == plain(naive(df, ["ts", "id"], -71, 0).select("id", "rolled"))


def test_questions_leave_out_rows_without_time(spark, many_parts, gappy, folder):
    """They fill several parts ahead of the others and must not shift the numbers."""
    h = gappy.withColumnRenamed("v", "requests")
    untimed = spark.range(700).select(F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(9).cast("long").alias("requests"))
    both = h.union(untimed)
    expected = plain(naive(gappy, ["ts"], 0, 7).select("ts", "rolled"))
    ordered = order_rows(both.withColumn("id", F.monotonically_increasing_id()), ["ts", "id"], folder, drop=["id"])
    assert ordered.filter("ts IS NULL").select("_part").distinct().count() > 1
    assert plain(requests_in_8h(ordered)) == expected


def test_ratio_over_doubles(spark, folder):
    facts = hourly_facts(spark.read.parquet(f"{SF}/events.parquet"))
    df = facts.select("ts", F.try_divide("zeroes", "eyeballs").alias("v"))
    rolled = rolling_sum(dense_index(order_rows(df, ["ts"], folder)), "v", -71, 0, "rolled", 200)
    assert plain(rolled) == plain(naive(df, ["ts"], -71, 0))


@pytest.mark.parametrize("first, last", FRAMES)
def test_running_sums_keep_nulls(spark, folder, first, last):
    """A frame without a value is null, as with a plain sum."""
    rows = [(i, None if i % 7 < 5 else i - 50) for i in range(100)] + [(100 + i, None) for i in range(90)]
    df = spark.createDataFrame(rows, "ts int, v long")
    rolled = rolling_sum(dense_index(order_rows(df, ["ts"], folder, parts=3)), "v", first, last, "rolled", 8)
    assert plain(rolled) == plain(naive(df, ["ts"], first, last))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_on_the_way_may_be_beyond_a_long(spark, folder, ansi):
    """Only a frame whose own sum is beyond a long is an error, in either mode."""
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for value in (10**18, -(10**18)):
            df = spark.range(40).select("id", F.lit(value).alias("v"))
            indexed = dense_index(order_rows(df, ["id"], folder, parts=2))
            rolled = rolling_sum(indexed, "v", -2, 0, "rolled")
            assert sorted({r.rolled for r in rolled.collect()}) == sorted({value, 2 * value, 3 * value})
            with pytest.raises(Exception, match="beyond 64 bits"):
                rolling_sum(indexed, "v", -10, 0, "rolled").collect()
        ends = spark.createDataFrame([(0, 2**63 - 1), (1, -(2**63)), (2, 2**63 - 1), (3, -1)], "id long, v long")
        rolled = rolling_sum(dense_index(order_rows(ends, ["id"], folder)), "v", -1, 0, "rolled")
        assert [r.rolled for r in rolled.orderBy("id").collect()] == [2**63 - 1, -1, -1, 2**63 - 2]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("first, last", FRAMES)
@pytest.mark.parametrize("kind", ["long", "double"])
def test_frames_stop_at_the_ends_of_a_series(spark, folder, first, last, kind):
    """One series as long as all others together, in buckets like any other; a null is a series as well."""
    series = F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 31 > 0, F.col("id") % 5)
    df = shuffled(spark.range(900).select("id", series.alias("s"), (F.col("id") % 11).cast(kind).alias("v")))
    indexed = dense_index(order_rows(df, ["s", "id"], folder, parts=4))
    rolled = rolling_sum(indexed, "v", first, last, "rolled", 50, series=["s"])
    frame = Window.partitionBy("s").orderBy("id").rowsBetween(first, last)
    assert plain(rolled) == plain(df.withColumn("rolled", F.sum("v").over(frame)))


@pytest.mark.parametrize("first, last", FRAMES)
def test_exact_sums_of_doubles(spark, folder, first, last):
    values = [(i, [1e16, 0.1, -1e16, 1e-9, None][i % 5]) for i in range(200)]
    df = shuffled(spark.createDataFrame(values, "id long, v double"))
    indexed = dense_index(order_rows(df, ["id"], folder, parts=3))
    found = {r.id: r.rolled for r in rolling_sum(indexed, "v", first, last, "rolled", 40, exact=True).collect()}
    for i, _ in values:
        inside = [Fraction(v) for k, v in values if first <= k - i <= last and v is not None]
        assert found[i] == (pytest.approx(float(sum(inside)), rel=1e-15, abs=1e-15) if inside else None)


def test_wide_frames_get_wide_buckets(spark, folder):
    indexed = dense_index(order_rows(spark.range(10).withColumnRenamed("id", "v"), ["v"], folder))
    assert "div 65536" in plan(rolling_sum(indexed, "v", -71, 0, "rolled"))
    assert "div 4000000" in plan(rolling_sum(indexed, "v", -999999, 1, "rolled"))


def test_one_plan_whatever_the_number_of_files(spark, folder):
    def shape(parts):
        text = plan(dense_index(order_rows(spark.range(3000), ["id"], folder, parts=parts)))
        return re.sub(r"#\d+L?|plan_id=\d+|\[file:[^\]]*\]|Location: [^\n]*?PartitionFilters", "", text)

    assert shape(1) == shape(9)


def test_dropped_order_column(spark, folder):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    ordered = order_rows(df, ["k"], folder, drop=["k"])
    assert ordered.columns == ["v", "_part", "_pos"]
    assert [r.v for r in dense_index(ordered).orderBy("rn").collect()] == ["a", "b"]


def test_no_rows(spark, gappy, folder):
    rolled = rolling_sum(dense_index(order_rows(gappy.limit(0), ["ts"], folder)), "v", 0, 7, "rolled")
    assert rolled.collect() == []
    assert tumbling_day(gappy.limit(0)).collect() == []


@pytest.mark.parametrize("start", [0, 5, 23])
def test_day_windows_equal_the_built_in(spark, gappy, start):
    late = gappy.filter(F.col("ts") >= F.lit(datetime(2024, 1, 2, start)).cast("timestamp_ntz"))
    begin = late.agg(F.min("ts")).first()[0].hour
    built_in = late.withColumn("window_start", F.window("ts", "24 hours", startTime=f"{begin} hours").start)
    assert plain(tumbling_day(late)) == plain(built_in)


def test_day_window_borders(spark):
    h = hourly(spark, [("2012-09-10 07:00", {}), ("2012-09-11 06:00", {}), ("2012-09-11 07:00", {}), (None, {})])
    starts = {r.ts: r.window_start for r in tumbling_day(h).collect()}
    assert starts == {
        datetime(2012, 9, 10, 7): datetime(2012, 9, 10, 7),
        datetime(2012, 9, 11, 6): datetime(2012, 9, 10, 7),
        datetime(2012, 9, 11, 7): datetime(2012, 9, 11, 7),
    }
