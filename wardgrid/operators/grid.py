"""The dense grid of stays and hours: aggregation into hours, intervals to hours, assembly, filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import HOUR_MS, bucket, c


def hourly(events: DataFrame, keys: Sequence[str], ms: str, how: Mapping[str, Column], width: int = HOUR_MS) -> DataFrame:
    """Aggregates by (keys, hour) of events from the beginning of the stay on; `how` names the aggregates."""
    rows = events.filter(c(ms) >= 0).withColumn("hour", bucket(c(ms), width))
    return rows.groupBy(*keys, "hour").agg(*[agg.alias(name) for name, agg in how.items()])


def skeleton(stays: DataFrame, key: str, hours: str) -> DataFrame:
    """(key, hour) for every hour from 0 that begins before the stay's end; stays of no length have none."""
    n = F.ceil(c(hours)).cast("long")
    return stays.filter(c(hours) > 0).select(key, F.explode(F.sequence(F.lit(0).cast("long"), n - 1)).alias("hour"))


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with its columns in a fixed order; an order that names others, lacks some or names one twice is an
    error that says which."""
    lacking, extra = [x for x in df.columns if x not in order], [x for x in order if x not in df.columns]
    twice = sorted({x for x in order if list(order).count(x) > 1})
    if lacking or extra or twice:
        raise ValueError(f"the order lacks {lacking}, names unknown {extra} and {twice} twice")
    return df.select(*[c(x) for x in order])


def covered_hours(df: DataFrame, keys: Sequence[str], start: str, stop: str, width: int = HOUR_MS, clip: str | None = None, point: Column | None = None) -> DataFrame:
    """(keys, hour) of the hours that intervals touch: those that end before 0 touch none, a beginning
    before 0 counts as 0, an interval of no or negative length is one hour. `clip` is a column where the
    stay ends; rows for which `point` holds are only their first hour."""
    end = F.least(c(stop), c(clip)) if clip else c(stop)
    begin = F.greatest(c(start), F.lit(0))
    first, last = bucket(begin, width), F.ceil(end / F.lit(width)).cast("long") - 1
    last = F.when(end <= begin, first).otherwise(last)
    if point is not None:
        last = F.when(point, first).otherwise(last)
    rows = df.filter(c(start).isNotNull() & c(stop).isNotNull() & (c(stop) >= 0))
    return rows.select(*keys, F.explode(F.sequence(first, F.greatest(first, last))).alias("hour"))


def covered_hours_mean(df: DataFrame, keys: Sequence[str], start: str, stop: str, value: str, width: int = HOUR_MS) -> DataFrame:
    """(keys, hour, mean): the mean over the intervals that touch an hour of their values."""
    first = F.greatest(bucket(c(start), width), F.lit(0).cast("long"))
    last = F.greatest(first, F.ceil(c(stop) / F.lit(width)).cast("long") - 1)
    rows = df.filter(c(start).isNotNull() & c(stop).isNotNull() & (c(stop) >= 0))
    return rows.select(*keys, c(value).alias("__v"), F.explode(F.sequence(first, last)).alias("hour")).groupBy(*keys, "hour").agg(F.avg("__v").alias("mean"))


def wide(long: DataFrame, keys: Sequence[str], tag: str, value: str, tags: Sequence[str]) -> DataFrame:
    """One column a tag, from rows with at most one value a key and tag (of several the largest). The list
    of tags fixes the columns: a tag without rows still has one."""
    rows = long.filter(c(tag).isin(list(tags)))
    return rows.groupBy(*keys).agg(*[F.max(F.when(c(tag) == t, c(value))).alias(t) for t in tags])


def assembled(frame: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The skeleton with the parts' columns, each hour once."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts, frame)


def masked(df: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Adds tag__observed, 1 where there is a value."""
    return df.withColumns({f"{t}__observed": c(t).isNotNull().cast("int") for t in tags})


def forward_filled(df: DataFrame, key: str, order: str, columns: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """Missing values replaced by the last one before, in one window; what then is missing of `zero` is 0."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = {x: F.last(x, ignorenulls=True).over(w) for x in columns}
    return df.withColumns({x: F.coalesce(e, F.lit(0.0)) if x in zero else e for x, e in filled.items()})


def rolling(df: DataFrame, key: str, order: str, column: str, hours: int) -> DataFrame:
    """Adds mean, deviation, least, largest and count over the last `hours` rows of a dense grid."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(1 - hours, 0)
    made = {"mean": F.avg(column), "std": F.stddev_samp(column), "min": F.min(column), "max": F.max(column), "n": F.count(column)}
    return df.withColumns({f"{column}_{name}_{hours}h": agg.over(w) for name, agg in made.items()})


def structural_zeros(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Adds columns that no data can fill: 0 for indicator, 0.0 for rate, null for numeric and category."""
    by = {"indicator": F.lit(0), "rate": F.lit(0.0), "numeric": F.lit(None).cast("double"), "category": F.lit(None).cast("string")}
    return df.withColumns({name: by[kind] for name, kind in kinds.items() if name not in df.columns})


def causal_means(df: DataFrame, keys: Sequence[str], ms: str, value: str, first: Sequence[str] = (), width: int = HOUR_MS) -> DataFrame:
    """One row per (keys, window) with readings, stamped at the window's end: mean, rows in it, and of
    `first` the earliest non-null value (ties: the smallest)."""
    start = bucket(c(ms), width) * F.lit(width)
    rows = df.filter(c(ms).isNotNull()).withColumn("__w", start)
    kept = [F.min(F.when(c(x).isNotNull(), F.struct(c(ms).alias("t"), c(x).alias("v"))))["v"].alias(x) for x in first]
    out = rows.groupBy(*keys, "__w").agg(F.avg(value).alias(value), F.count("*").alias("raw_rows_in_bin"), *kept)
    return out.withColumn(ms, F.col("__w") + width).drop("__w").withColumn("binning_method", F.lit("causal_mean"))


def binned(df: DataFrame, dense: DataFrame, signal: str, keys: Sequence[str], ms: str, value: str, width: int = HOUR_MS) -> DataFrame:
    """Dense signals as causal means, the rest as it came, with the method in `binning_method`."""
    listed = dense.select(signal).distinct()
    means = causal_means(df.join(listed, signal, "left_semi"), keys, ms, value, width=width)
    rest = df.join(listed, signal, "left_anti").select(*keys, ms, value).withColumns({"raw_rows_in_bin": F.lit(1).cast("long"), "binning_method": F.lit("raw_passthrough")})
    return means.select(*keys, ms, value, "raw_rows_in_bin", "binning_method").unionByName(rest)


def state_changes(df: DataFrame, keys: Sequence[str], state: str, order: Sequence[str], targets: Sequence[int], target: str) -> DataFrame:
    """Rows that begin a state: of the target items those whose state differs from the one before, of
    others all."""
    w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(o) for o in order])
    before = F.lag(state).over(w)
    first = F.row_number().over(w) == 1
    marked = df.withColumn("__keep", ~c(target).isin(list(targets)) | first | ~before.eqNullSafe(c(state)))
    return marked.filter("__keep").drop("__keep")
