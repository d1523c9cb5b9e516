from ridemetrics.sources.events import EVENT_KINDS, hourly_facts
from ridemetrics.sources.hourly_csv import misshapen_rows, read_hourly_csv, standardize

__all__ = ["EVENT_KINDS", "hourly_facts", "misshapen_rows", "read_hourly_csv", "standardize"]
