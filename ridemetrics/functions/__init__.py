from ridemetrics.functions.clock import hour_timestamp, is_weekend, label_date
from ridemetrics.functions.measures import correlation, unmet_demand, zero_ratio

__all__ = [
    "correlation",
    "hour_timestamp",
    "is_weekend",
    "label_date",
    "unmet_demand",
    "zero_ratio",
]
