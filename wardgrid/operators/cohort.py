"""Which stays have enough data, and what is known of each person."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def longest_gaps(events: DataFrame, key: str, hour: str) -> DataFrame:
    """(key, n_hours, max_gap): different hours with events and the longest step between two; 0 for one."""
    hours = events.select(key, hour).distinct()
    step = c(hour) - F.lag(hour).over(Window.partitionBy(key).orderBy(hour))
    return hours.withColumn("__d", step).groupBy(key).agg(F.count("*").alias("n_hours"), F.coalesce(F.max("__d"), F.lit(0)).cast("long").alias("max_gap"))


def covered_stays(stays: DataFrame, events: DataFrame, key: str, hour: str, least_hours: float, least_events: int, longest: int) -> DataFrame:
    """(key, los_hours, n_hours, max_gap) of stays that last least_hours and have events in least_events hours with no
    gap longer than `longest`."""
    return stays.filter(F.col("los_hours") >= least_hours).select(key, "los_hours").join(longest_gaps(events, key, hour), key).filter((F.col("n_hours") >= least_events) & (F.col("max_gap") <= longest))


def stay_metadata(stays: DataFrame, shards: DataFrame, person: str, stay: str) -> DataFrame:
    """(person, stay, split, shard, hours): where each stay was written. Stays without a shard go."""
    return stays.select(c(person), c(stay), c("los_hours").alias("hours")).join(shards.select(c(stay), "split", "shard"), stay)


def person_metadata(rows: DataFrame, person: str, stay: str) -> DataFrame:
    """(person, split, n_stays, stay_ids, shards, hours) of stay_metadata, ids and shards in order as texts.
    A person in several splits gives a row for each."""
    text = lambda name: F.array_join(F.transform(F.array_sort(F.collect_set(c(name))), lambda v: v.cast("string")), ";")
    return rows.groupBy(c(person), "split").agg(F.countDistinct(stay).alias("n_stays"), text(stay).alias("stay_ids"), text("shard").alias("shards"), F.sum("hours").alias("hours"))


def rollup(df: DataFrame, person: str, stay: str, start: str, stop: str) -> DataFrame:
    """Per person: number of stays, first start, last stop, and the stays' ids in order of start, as text."""
    ordered = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct(F.coalesce(c(start), F.lit(0)).alias("t"), c(stay).alias("id")))), lambda e: e["id"].cast("string")), ";")
    return df.groupBy(person).agg(F.countDistinct(stay).alias("n_stays"), F.min(start).alias("first_start"), F.max(stop).alias("last_stop"), ordered.alias("stay_ids"))
