"""Wall-clock time. All values are TIMESTAMP_NTZ, so no session time zone takes part."""

from datetime import timedelta

from pyspark.sql import Column, functions as F


def hours(count) -> Column:
    """Day-time interval of ``count`` hours (a number or a Column)."""
    return F.lit(timedelta(hours=1)) * count


def midnight(day) -> Column:
    return F.to_date(day).cast("timestamp_ntz")


def label_date(label, fmt: str) -> Column:
    """Date of a text label; null when it does not parse, in ANSI mode too."""
    return F.try_to_date(F.col(label) if isinstance(label, str) else label, fmt)


def hour_timestamp(day, hour) -> Column:
    """Date and hour of day as a timestamp; null outside 0..23."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.when(hour.between(0, 23), midnight(day) + hours(hour))


def is_weekend(ts) -> Column:
    """Friday from 17:00 to Sunday 03:59. In Spark Sunday is day 1 and Saturday day 7."""
    day, hour = F.dayofweek(ts), F.hour(ts)
    return ((day == 6) & (hour >= 17)) | (day == 7) | ((day == 1) & (hour <= 3))
