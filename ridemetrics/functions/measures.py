"""Measures over the hourly counters. Division by zero gives null, in ANSI mode too."""

from pyspark.sql import Column, functions as F


def zero_ratio() -> Column:
    return F.try_divide(F.col("zeroes").cast("double"), F.col("eyeballs").cast("double"))


def unmet_demand() -> Column:
    """Requests above the number of drivers, never negative; 0 when either is null."""
    return F.greatest(F.col("requests") - F.col("drivers"), F.lit(0))


def correlation(x: str, y: str, nulls: str = "zero") -> Column:
    """Pearson correlation; null when a column is constant.

    Nulls are read as 0, or with ``nulls="drop"`` rows with a null in either column take no part.
    """
    if nulls not in ("zero", "drop"):
        raise ValueError(f"nulls must be 'zero' or 'drop', not {nulls!r}")
    x, y = (F.col(name).cast("double") for name in (x, y))
    if nulls == "drop":
        x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    else:
        x, y = F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
