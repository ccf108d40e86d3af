"""The causal window as a stream: each window's mean is emitted once, when its end has passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def causal_means_stream(events: DataFrame, keys: Sequence[str], at: str, value: str, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(keys, at, value, n) of a stream of readings: at is the window's end, and windows without readings
    give nothing. Readings later than `late` behind the newest are left out, so state stays bounded.
    Null and NaN values and null times are passed over. Works on a static table alike."""
    rows = events.filter(F.col(value).isNotNull() & ~F.isnan(value) & F.col(at).isNotNull()).withWatermark(at, late)
    out = rows.groupBy(*keys, F.window(at, width).alias("__w")).agg(F.avg(value).alias(value), F.count("*").alias("n"))
    return out.select(*keys, F.col("__w.end").alias(at), value, "n")


def deduplicated_stream(events: DataFrame, keys: Sequence[str], at: str, late: str = "1 day") -> DataFrame:
    """A stream without rows delivered twice within the time that late ones are waited for."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))
