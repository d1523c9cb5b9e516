"""Queries of the library over the driver's tables, each with its SQL for DuckDB."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import timedelta
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))  # also when loaded from another folder

from ridemetrics import job
from ridemetrics.functions.clock import hour_timestamp, hours, label_date
from ridemetrics.operators.fill import fill_ordered, forward_fill
from ridemetrics.operators.frames import dense_index, order_rows, rolling_sum
from ridemetrics.operators.ranges import range_sum
from ridemetrics.operators.storage import delete_folder, store, write_result
from ridemetrics.plans import questions as q
from ridemetrics.schema import HOURLY, LABEL_FORMAT, RENAMES
from ridemetrics.sources.events import hourly_facts
from ridemetrics.sources.hourly_csv import misshapen_rows, read_hourly_csv, standardize

try:
    from ridemetrics.llm.queries import ORACLE_SQL as _LLM_SQL, QUERIES as _LLM_QUERIES
except ModuleNotFoundError as missing:
    if (missing.name or "") not in ("ridemetrics.llm", "ridemetrics.llm.queries", "corpus_pipeline"):
        raise
    _LLM_SQL, _LLM_QUERIES = {}, {}

# The data begins at midnight; moved by these hours, the windows begin at another hour.
_MOVED = 5

# Small enough that the distributed branches do their work at the driver's scale factors.
_PARTS = 8
_BUCKET_ROWS = 1000
_BLOCK_ROWS = 1 << 10
_FILES = 4

# Spreads ids over 61 bits, one to one, as the modulus is a prime.
_SPREAD = 1_152_921_504_606_846_883
_MODULUS = 2**61 - 1


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _folder(spark, key):
    """Folder of the tables that query ``key`` stores. Its next call deletes them first, so read an
    answer before asking again."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/ridemetrics/{spark.sparkContext.applicationId}/{key}"
    delete_folder(spark, folder)
    return folder


def _rounded(df, *names):
    return df.withColumns({name: F.round(name, 6) for name in names})


def _on_hours(answer, *doubles):
    """Query that answers from the hourly facts; ``doubles`` are compared to six places."""
    return lambda spark, sf_dir: _rounded(answer(hourly_facts(_events(spark, sf_dir))), *doubles)


def _on_hours_with_nulls(answer, *doubles):
    """As above, from facts in which a counter of none is unknown."""

    def query(spark, sf_dir):
        facts = hourly_facts(_events(spark, sf_dir))
        unknown = {name: F.nullif(F.col(name) - F.col(name) % 3, F.lit(0)) for name in ("requests", "drivers")}
        return _rounded(answer(facts.withColumns(unknown)), *doubles)

    return query


def _on_prepared_hours(question_id, answer, key, *doubles, parts=None):
    """As above, from the facts in time order."""

    def query(spark, sf_dir):
        table = q.prepare(hourly_facts(_events(spark, sf_dir)), [question_id], _folder(spark, key), parts=parts)
        return _rounded(answer(table), *doubles)

    return query


def _on_stored_hours(answer, key, moved=0):
    """As above, stored, because the windows read their input twice; ``moved`` shifts all events in time."""

    def query(spark, sf_dir):
        events = _events(spark, sf_dir).withColumn("ts", F.col("ts") + hours(moved))
        return answer(store(hourly_facts(events).select("ts", "completed_trips"), _folder(spark, key), "hourly"))

    return query


_ACTIVITY = ["avg_eyeballs", "avg_drivers", "avg_requests", "activity_score"]


def _labels(events):
    return events.select("event_id", F.when(F.col("event_id") % 24 == 0, F.to_date("ts")).alias("label"))


def _with_text_labels(filled):
    return filled.select("event_id", F.date_format("label", LABEL_FORMAT).alias("label"))


def _forward_fill(bits):
    def query(spark, sf_dir):
        # event_id is unique and dense, so a block holds at most 2^bits rows.
        rows = _labels(_events(spark, sf_dir)).withColumn("block", F.shiftright("event_id", bits))
        return _with_text_labels(forward_fill(rows, "label", block=["block"], order="event_id"))

    return query


def _forward_fill_sparse_ids(spark, sf_dir):
    """Filled in the order of a key that is spread over 61 bits, in blocks by position."""
    spread = F.expr(f"CAST(CAST(event_id AS DECIMAL(38,0)) * {_SPREAD} % {_MODULUS} AS BIGINT)")
    rows = _labels(_events(spark, sf_dir)).withColumn("place", spread)
    ordered = order_rows(rows, ["place"], _folder(spark, "forward_fill_sparse_ids"), parts=_PARTS)
    return _with_text_labels(fill_ordered(ordered, "label", _BLOCK_ROWS))


def _hour_timestamp(spark, sf_dir):
    facts = hourly_facts(_events(spark, sf_dir))
    label = F.date_format("date", LABEL_FORMAT)
    return facts.select("date", "hour", hour_timestamp(label_date(label, LABEL_FORMAT), "hour").alias("ts"))


def _raw_csv(spark, sf_dir, folder, forms=False):
    """Facts written in the raw form in several files, with a label on the first row of a date only.

    With ``forms`` the counters are large and numbers are spelled in ways that still mean a whole number.
    """
    first = F.row_number().over(Window.partitionBy("date").orderBy("ts")) == 1
    label = F.when(first, F.date_format("date", LABEL_FORMAT))
    facts = hourly_facts(_events(spark, sf_dir)).withColumn("label", label)
    facts = facts.repartitionByRange(_FILES, "ts").sortWithinPartitions("ts")
    if forms:
        facts = facts.withColumns(
            {
                "eyeballs": F.col("eyeballs") + F.lit(_LARGE),
                "zeroes": F.format_string("%d.0", "zeroes"),
                "requests": F.format_string("  %d ", "requests"),
                "hour": F.when(F.col("hour") % 2 == 0, F.format_string("%02d", "hour")).otherwise(F.format_string("%d.0", "hour")),
            }
        )
    raw = facts.select(*[F.col("label" if name == "Date" else column).alias(name) for name, column in RENAMES.items()])
    path = f"{folder}/raw-csv"
    raw.write.options(header=True, ignoreTrailingWhiteSpace=False, ignoreLeadingWhiteSpace=False).csv(path)
    return path


# Above the range of 32-bit numbers.
_LARGE = 3_000_000_000


def _misshapen_rows(spark, sf_dir):
    """Events as CSV rows, of which some have a field too many or a few too few; how many there are of each."""
    folder = _folder(spark, "misshapen_rows")
    fields = [F.lit(""), F.hour("ts"), *[F.col("event_id") % k for k in range(2, 7)]]
    row = F.concat_ws(",", *fields)
    line = F.when(F.col("event_id") % 10 == 3, F.concat(row, F.lit(",9"))).when(
        F.col("event_id") % 100 == 7, F.concat_ws(",", *fields[:4])
    )
    path = f"{folder}/raw-csv"
    _events(spark, sf_dir).select(F.coalesce(line, row)).write.text(path)
    raw = read_hourly_csv(spark, path, header=list(RENAMES))
    return misshapen_rows(raw).groupBy(F.col("n_fields").cast("long").alias("n_fields")).agg(F.count(F.lit(1)).alias("n_rows"))


def _csv_ingest(key, forms=False, **options):
    def query(spark, sf_dir):
        folder = _folder(spark, key)
        raw = read_hourly_csv(spark, _raw_csv(spark, sf_dir, folder, forms))
        return standardize(raw, folder, **options).select(*HOURLY)

    return query


def _job_answer(question_id):
    """The whole batch job for one question, from the raw CSV to the answer read back."""
    doubles = {4: ["percentage"], 5: ["weighted_average"], 7: ["correlation"], 8: ["ratio_72h"], 10: _ACTIVITY}

    def query(spark, sf_dir):
        folder = _folder(spark, f"job_q{question_id}")
        raw = _raw_csv(spark, sf_dir, folder)
        (path,) = job.run(spark, raw, f"{folder}/answers", str(question_id), scratch_root=folder)
        return _rounded(spark.read.parquet(path), *doubles.get(question_id, []))

    return query


def _sink_round_trip(spark, sf_dir):
    """Partitioned by a few dates a file each; a date is a few rows of facts."""
    facts = hourly_facts(_events(spark, sf_dir))
    path = write_result(facts.repartition("date"), _folder(spark, "sink_round_trip"), "facts", ["date"])
    return spark.read.schema(facts.schema).parquet(path).select(*HOURLY)


def _cents():
    return F.round(F.col("value") * 100).cast("long").alias("cents")


def _events_rolling(first, last, name, key, parts=None, bucket_rows=None):
    """Row-level frames over all events, in cents so that sums are exact."""

    def query(spark, sf_dir):
        rows = _events(spark, sf_dir).select("ts", "event_id", _cents())
        ordered = order_rows(rows, ["ts", "event_id"], _folder(spark, key), drop=["ts"], parts=parts)
        return rolling_sum(dense_index(ordered), "cents", first, last, name, bucket_rows).select("event_id", name)

    return query


def _events_user_rolling_8(spark, sf_dir):
    """Frames that stop at the ends of a user's events."""
    rows = _events(spark, sf_dir).select("user_id", "ts", "event_id", _cents())
    ordered = order_rows(rows, ["user_id", "ts", "event_id"], _folder(spark, "events_user_rolling_8"), drop=["ts"], parts=_PARTS)
    rolled = rolling_sum(dense_index(ordered), "cents", 0, 7, "cents_in_8_rows", _BUCKET_ROWS, series=["user_id"])
    return rolled.select("event_id", "cents_in_8_rows")


def _events_exact_rolling(key, width):
    """Doubles, by sums that do not depend on the order; a frame as wide as ``width`` costs no more than a narrow one."""

    def query(spark, sf_dir):
        rows = _events(spark, sf_dir).select("ts", "event_id", "value")
        ordered = order_rows(rows, ["ts", "event_id"], _folder(spark, key), drop=["ts"], parts=_PARTS)
        return _rounded(rolling_sum(dense_index(ordered), "value", 1 - width, 0, "rolled", exact=True).select("event_id", "rolled"), "rolled")

    return query


def _events_range(key, value, name, first, last, series=()):
    """Frames by time over all events; ``first`` and ``last`` in hours."""

    def query(spark, sf_dir):
        rows = _events(spark, sf_dir).select("event_id", "ts", *series, value().alias("amount"))
        frame = timedelta(hours=first), timedelta(hours=last)
        found = range_sum(rows, "amount", "ts", *frame, name, _folder(spark, key), series, parts=_PARTS, block_rows=_BUCKET_ROWS)
        found = found.select("event_id", name)
        return found if name.startswith("cents") else _rounded(found, name)

    return query


def entry(spark: SparkSession) -> DataFrame:
    """Busiest 8 consecutive hours of the smallest scale."""
    return queries()["q6_busiest_8h"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "hourly_facts": _on_hours(lambda h: h),
        "q1_totals": _on_hours(q.trips_by_date),
        "q1_peak_date": _on_hours(q.q1),
        "q2_totals_24h": _on_stored_hours(q.trips_by_24h, "q2_totals_24h"),
        "q2_peak_24h": _on_stored_hours(q.q2, "q2_peak_24h"),
        "q2_totals_24h_moved": _on_stored_hours(q.trips_by_24h, "q2_totals_24h_moved", _MOVED),
        "q3_totals": _on_hours(q.requests_by_hour),
        "q3_peak_hour": _on_hours(q.q3),
        "q4_weekend_share": _on_hours(q.q4, "percentage"),
        "q5_hourly": _on_hours(q.trips_per_driver_by_hour, "weight"),
        "q5_weighted_ratio": _on_hours(q.q5, "weighted_average"),
        "q6_rolling_8": _on_prepared_hours(6, q.requests_in_8h, "q6_rolling_8"),
        "q6_busiest_8h": _on_prepared_hours(6, q.q6, "q6_busiest_8h"),
        "q7_supply_follows_demand": _on_hours(q.q7, "correlation"),
        "q7_complete_pairs": _on_hours_with_nulls(q.follows_demand("drop"), "correlation"),
        "q8_rolling_72": _on_prepared_hours(8, q.ratio_72h, "q8_rolling_72", "ratio_72h"),
        "q8_peak_72h": _on_prepared_hours(8, q.q8, "q8_peak_72h", "ratio_72h", parts=_PARTS),
        "q9_totals": _on_hours(q.unmet_demand_by_hour),
        "q9_add_drivers_hour": _on_hours(q.q9),
        "q10_hourly": _on_hours(q.activity_by_hour, *_ACTIVITY),
        "q10_end_of_day": _on_hours(q.q10, *_ACTIVITY),
        "forward_fill": _forward_fill(18),
        "forward_fill_blocks": _forward_fill(10),
        "forward_fill_sparse_ids": _forward_fill_sparse_ids,
        "hour_timestamp": _hour_timestamp,
        "csv_ingest": _csv_ingest("csv_ingest"),
        "csv_ingest_files": _csv_ingest("csv_ingest_files", block_rows=64),
        "csv_ingest_forms": _csv_ingest("csv_ingest_forms", forms=True),
        "misshapen_rows": _misshapen_rows,
        "sink_round_trip": _sink_round_trip,
        **{f"job_q{i}": _job_answer(i) for i in q.QUESTIONS},
        "events_rolling_8": _events_rolling(0, 7, "cents_in_8_rows", "events_rolling_8"),
        "events_rolling_72": _events_rolling(-71, 0, "cents_in_72_rows", "events_rolling_72"),
        "events_rolling_8_parts": _events_rolling(0, 7, "cents_in_8_rows", "events_rolling_8_parts", _PARTS, _BUCKET_ROWS),
        "events_rolling_72_parts": _events_rolling(
            -71, 0, "cents_in_72_rows", "events_rolling_72_parts", _PARTS, _BUCKET_ROWS
        ),
        "events_user_rolling_8": _events_user_rolling_8,
        "events_exact_rolling_72": _events_exact_rolling("events_exact_rolling_72", 72),
        "events_exact_rolling_7200": _events_exact_rolling("events_exact_rolling_7200", 7200),
        "events_range_8h": _events_range("events_range_8h", _cents, "cents_in_8_hours", -8, 0),
        "events_user_range_24h": _events_range("events_user_range_24h", lambda: F.col("value"), "value_in_24_hours", -12, 12, ["user_id"]),
        **_LLM_QUERIES,
    }


_FACTS = """
WITH h AS (
  SELECT date_trunc('hour', ts) AS ts, CAST(date_trunc('day', ts) AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
         COUNT(*) FILTER (WHERE event_type = 'view') AS eyeballs,
         COUNT(*) FILTER (WHERE event_type = 'error') AS zeroes,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS completed_trips,
         COUNT(*) FILTER (WHERE event_type = 'click') AS requests,
         COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'signup') AS drivers
  FROM events GROUP BY 1, 2, 3),
hw AS (
  SELECT h.*, (dayofweek(ts) = 5 AND hour(ts) >= 17) OR dayofweek(ts) = 6 OR (dayofweek(ts) = 0 AND hour(ts) <= 3) AS wk
  FROM h),
t24 AS (
  SELECT window_start, window_start + INTERVAL '24' HOUR AS window_end,
         CAST(SUM(completed_trips) AS BIGINT) AS completed_trips_per_24_hour
  FROM (SELECT time_bucket(INTERVAL '24' HOUR, ts, (SELECT MIN(ts) FROM h)) AS window_start, completed_trips FROM h) a
  GROUP BY 1, 2),
r8 AS (
  SELECT ts, CAST(SUM(requests) OVER (ORDER BY ts ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS BIGINT) AS requests_in_8h
  FROM h),
r72 AS (
  SELECT ts, SUM(CAST(zeroes AS DOUBLE) / NULLIF(CAST(eyeballs AS DOUBLE), 0))
             OVER (ORDER BY ts ROWS BETWEEN 71 PRECEDING AND CURRENT ROW) AS exact
  FROM h),
hr AS (
  SELECT hour, CAST(SUM(completed_trips) AS BIGINT) AS completed_trips_per_hour,
         CAST(SUM(drivers) AS BIGINT) AS drivers_per_hour
  FROM h WHERE hour IS NOT NULL GROUP BY hour),
ac AS (SELECT hour, AVG(eyeballs) AS ae, AVG(drivers) AS ad, AVG(requests) AS ar FROM h GROUP BY hour)
"""

_Q1 = "SELECT date, CAST(SUM(completed_trips) AS BIGINT) AS total_completed_trips FROM h GROUP BY date"
_Q3 = "SELECT hour, CAST(SUM(requests) AS BIGINT) AS requests_per_hour FROM h GROUP BY hour"
_Q9 = (
    "SELECT hour, CAST(SUM(GREATEST(requests - drivers, 0)) AS BIGINT) AS unmet_demand_per_hour FROM h GROUP BY hour"
)
_Q10 = (
    "SELECT hour, ROUND(ae, 6) AS avg_eyeballs, ROUND(ad, 6) AS avg_drivers, ROUND(ar, 6) AS avg_requests, "
    "ROUND(ae + ad + ar, 6) AS activity_score FROM ac"
)
_TOP = " ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT 1"

_FACT_SQL = {
    "hourly_facts": "SELECT * FROM h",
    "q1_totals": _Q1,
    "q1_peak_date": _Q1 + _TOP,
    "q2_totals_24h": "SELECT * FROM t24",
    "q2_peak_24h": "SELECT * FROM t24 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 1",
    "q2_totals_24h_moved": f"""
        SELECT window_start, window_start + INTERVAL '24' HOUR AS window_end,
               CAST(SUM(completed_trips) AS BIGINT) AS completed_trips_per_24_hour
        FROM (SELECT time_bucket(INTERVAL '24' HOUR, ts, (SELECT MIN(ts) + INTERVAL '{_MOVED}' HOUR FROM h)) AS window_start, completed_trips
              FROM (SELECT ts + INTERVAL '{_MOVED}' HOUR AS ts, completed_trips FROM h) m) a
        GROUP BY 1, 2""",
    "q3_totals": _Q3,
    "q3_peak_hour": _Q3 + _TOP,
    "q4_weekend_share": """
        SELECT CAST(SUM(zeroes) FILTER (WHERE wk) AS BIGINT) AS weekend_zeroes,
               CAST(SUM(zeroes) AS BIGINT) AS total_zeroes,
               ROUND(100.0 * CAST(SUM(zeroes) FILTER (WHERE wk) AS DOUBLE)
                     / NULLIF(CAST(SUM(zeroes) AS DOUBLE), 0), 6) AS percentage
        FROM hw""",
    "q5_hourly": """
        SELECT hour, completed_trips_per_hour, drivers_per_hour,
               ROUND(CAST(completed_trips_per_hour AS DOUBLE) / NULLIF(CAST(drivers_per_hour AS DOUBLE), 0), 6) AS weight
        FROM hr""",
    "q5_weighted_ratio": """
        SELECT ROUND(SUM(CAST(completed_trips_per_hour AS DOUBLE)
                         * (CAST(completed_trips_per_hour AS DOUBLE) / NULLIF(CAST(drivers_per_hour AS DOUBLE), 0)))
                     / NULLIF(CAST(SUM(completed_trips_per_hour) AS DOUBLE), 0), 6) AS weighted_average
        FROM hr""",
    "q6_rolling_8": "SELECT * FROM r8",
    "q6_busiest_8h": """
        SELECT ts AS start_time, ts + INTERVAL '8' HOUR AS end_time, requests_in_8h
        FROM r8 ORDER BY 3 DESC NULLS LAST, 1 LIMIT 1""",
    "q7_supply_follows_demand": """
        SELECT ROUND(CORR(CAST(requests AS DOUBLE), CAST(drivers AS DOUBLE)), 6) AS correlation,
               CORR(CAST(requests AS DOUBLE), CAST(drivers AS DOUBLE)) > 0.3 AS answer
        FROM h""",
    "q7_complete_pairs": """
        SELECT ROUND(CORR(CAST(r AS DOUBLE), CAST(d AS DOUBLE)), 6) AS correlation, COALESCE(CORR(CAST(r AS DOUBLE), CAST(d AS DOUBLE)) > 0.3, false) AS answer
        FROM (SELECT NULLIF(requests - requests % 3, 0) AS r, NULLIF(drivers - drivers % 3, 0) AS d FROM h) a""",
    "q8_rolling_72": "SELECT ts, ROUND(exact, 6) AS ratio_72h FROM r72",
    "q8_peak_72h": """
        SELECT ts - INTERVAL '72' HOUR AS start_time, ts AS end_time, ROUND(exact, 6) AS ratio_72h
        FROM r72 ORDER BY exact DESC NULLS LAST, 2 LIMIT 1""",
    "q9_totals": _Q9,
    "q9_add_drivers_hour": _Q9 + _TOP,
    "q10_hourly": _Q10,
    "q10_end_of_day": _Q10 + " ORDER BY ae + ad + ar NULLS LAST, 1 NULLS LAST LIMIT 1",
    "hour_timestamp": "SELECT date, hour, ts FROM h",
    "csv_ingest": "SELECT * FROM h",
    "sink_round_trip": "SELECT * FROM h",
}
_FACT_SQL["csv_ingest_files"] = _FACT_SQL["csv_ingest"]
_FACT_SQL["csv_ingest_forms"] = f"SELECT * REPLACE (eyeballs + {_LARGE} AS eyeballs) FROM h"
_ANSWERS = [
    "q1_peak_date", "q2_peak_24h", "q3_peak_hour", "q4_weekend_share", "q5_weighted_ratio", "q6_busiest_8h",
    "q7_supply_follows_demand", "q8_peak_72h", "q9_add_drivers_hour", "q10_end_of_day",
]
_FACT_SQL |= {f"job_q{i}": _FACT_SQL[key] for i, key in enumerate(_ANSWERS, 1)}


def oracle_sql() -> dict[str, str]:
    cents = "CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER (ORDER BY ts, event_id ROWS BETWEEN {}) AS BIGINT)"
    rolling_8 = f"SELECT event_id, {cents.format('CURRENT ROW AND 7 FOLLOWING')} AS cents_in_8_rows FROM events"
    rolling_72 = f"SELECT event_id, {cents.format('71 PRECEDING AND CURRENT ROW')} AS cents_in_72_rows FROM events"
    by_user = "SELECT event_id, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS BIGINT) AS cents_in_8_rows FROM events"
    exact = "SELECT event_id, ROUND(SUM(value) OVER (ORDER BY ts, event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW), 6) AS rolled FROM events"
    fill = """
        SELECT event_id, last_value(CASE WHEN event_id % 24 = 0 THEN strftime(ts, '%d-%b-%y') END IGNORE NULLS)
               OVER (ORDER BY {} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label
        FROM events"""
    return {
        **_LLM_SQL,
        **{key: _FACTS + sql for key, sql in _FACT_SQL.items()},
        "forward_fill": fill.format("event_id"),
        "forward_fill_blocks": fill.format("event_id"),
        "forward_fill_sparse_ids": fill.format(f"CAST(event_id AS HUGEINT) * {_SPREAD} % {_MODULUS}"),
        "events_rolling_8": rolling_8,
        "events_rolling_72": rolling_72,
        "events_rolling_8_parts": rolling_8,
        "events_rolling_72_parts": rolling_72,
        "misshapen_rows": """
            SELECT CAST(CASE WHEN event_id % 10 = 3 THEN 8 ELSE 4 END AS BIGINT) AS n_fields, COUNT(*) AS n_rows
            FROM events WHERE event_id % 10 = 3 OR event_id % 100 = 7 GROUP BY 1""",
        "events_user_rolling_8": by_user,
        "events_exact_rolling_72": exact.format(71),
        "events_exact_rolling_7200": exact.format(7199),
        "events_range_8h": """
            SELECT event_id, CAST(SUM(CAST(ROUND(value * 100) AS BIGINT)) OVER (
                       ORDER BY ts RANGE BETWEEN INTERVAL 8 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) AS cents_in_8_hours
            FROM events""",
        "events_user_range_24h": """
            SELECT event_id, ROUND(SUM(value) OVER (PARTITION BY user_id ORDER BY ts
                       RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND INTERVAL 12 HOURS FOLLOWING), 6) AS value_in_24_hours
            FROM events""",
    }
