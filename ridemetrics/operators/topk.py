"""First rows by a measure, with defined ties."""

from pyspark.sql import Column, DataFrame, functions as F


def top_rows(df: DataFrame, by: str | Column, ties: list[str], n: int = 1) -> DataFrame:
    """``n`` rows with the largest ``by``; equal ones by the smallest ``ties``, nulls last."""
    return df.orderBy(F.desc_nulls_last(by), *map(F.asc_nulls_last, ties)).limit(n)


def bottom_rows(df: DataFrame, by: str | Column, ties: list[str], n: int = 1) -> DataFrame:
    """``n`` rows with the smallest ``by``; equal ones by the smallest ``ties``, nulls last."""
    return df.orderBy(F.asc_nulls_last(by), *map(F.asc_nulls_last, ties)).limit(n)
