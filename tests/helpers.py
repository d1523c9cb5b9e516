from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ridemetrics.schema import COUNTERS, HOURLY

TABLE = "ts timestamp_ntz, date date, hour int, " + ", ".join(f"{name} long" for name in COUNTERS)


def hourly(spark, rows):
    """Hourly table of (ts, counters); counters left out are 0."""
    full = []
    for ts, counters in rows:
        ts = datetime.fromisoformat(ts) if isinstance(ts, str) else ts
        day, hour = (ts.date(), ts.hour) if ts else (None, None)
        full.append((ts, day, hour, *[counters.get(name, 0) for name in COUNTERS]))
    return spark.createDataFrame(full, TABLE).select(*HOURLY)


def series(spark, start, values, name):
    """Consecutive hours with the given values of one counter."""
    first = datetime.fromisoformat(start)
    return hourly(spark, [(first + timedelta(hours=i), {name: v}) for i, v in enumerate(values)])


def plan(df):
    """Physical plan; after an action it is the one that ran."""
    return df._jdf.queryExecution().executedPlan().toString()


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def shuffled(df):
    return df.orderBy(F.xxhash64(*df.columns))
