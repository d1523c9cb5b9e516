"""Hourly supply-and-demand analytics of a ride marketplace, as Spark jobs."""
