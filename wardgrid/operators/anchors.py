"""Events on the time scale of the stays they belong to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import HOUR_MS, UNKNOWN_TIME, add_ms, c, known_time, lookup
from wardgrid.operators.events import row_index


def stays(admissions: DataFrame, key: str = "admissionid") -> DataFrame:
    """One row per stay with admittedat, dischargedat and los_hours. Of rows with one key the largest
    times hold; null keys are passed over."""
    one = admissions.filter(c(key).isNotNull()).groupBy(key).agg(F.max("admittedat").alias("admittedat"), F.max("dischargedat").alias("dischargedat"))
    return one.withColumn("los_hours", (F.col("dischargedat") - F.col("admittedat")) / F.lit(float(HOUR_MS)))


def admission_table(raw: DataFrame, person: str, stay: str, group: str, epochs: Mapping[str, datetime], times: Mapping[str, str], dataset: str) -> DataFrame:
    """raw with subject_id, hadm_id and stay_id beside the native ids, the data set's name, a time of day for
    each of `times` (column of ms -> new column) counted from its group's epoch, and los_hours.

    A group that `epochs` doesn't know is an error, raised when the rows are made; a null group, and an
    unknown time, give null times.
    """
    known = lookup(c(group).cast("string"), {k: v.isoformat(sep=" ") for k, v in epochs.items()})
    wrong = F.when(c(group).isNotNull() & known.isNull(), F.raise_error(F.concat(F.lit(f"no epoch for {group} "), c(group).cast("string"))))
    base = F.coalesce(wrong.cast("string"), known).cast("timestamp_ntz")
    ids = {"subject_id": c(person), "hadm_id": c(stay), "stay_id": c(stay), "source_dataset": F.lit(dataset)}
    out = raw.withColumns(ids).withColumns({new: add_ms(base, known_time(c(ms))) for ms, new in times.items()})
    return out.withColumn("los_hours", (F.col("dischargedat") - F.col("admittedat")) / F.lit(float(HOUR_MS)))


def spread_sample(stays: DataFrame, key: str, length: str, many: int, parts: int = 64) -> DataFrame:
    """`many` stays spread over all lengths: of the stays in order of length (ties: key) those in the middle of
    `many` equal parts. Null lengths are passed over; fewer stays than that are all taken."""
    known = stays.filter(c(length).isNotNull())
    n = known.count()
    placed = row_index(known, [length, key], parts, "__row")
    nth = F.floor(F.col("__row") * F.lit(many) / F.lit(max(n, 1)))
    middle = F.floor((nth + F.lit(0.5)) * F.lit(n) / F.lit(many))
    return placed.filter((F.lit(n) <= F.lit(many)) | (F.col("__row") == middle)).drop("__row")


def valid_stays(anchors: DataFrame) -> DataFrame:
    """Stays that last more than 0 hours."""
    return anchors.filter("los_hours > 0")


def anchored(events: DataFrame, anchors: DataFrame, keys: Sequence[str], times: Mapping[str, str], anchor: str = "admittedat", unknown: int = UNKNOWN_TIME, how: str = "inner") -> DataFrame:
    """Events with `times` (column -> new column) counted from their stay's beginning.

    Unknown times become null; with how="inner" events without a stay go, with "left" they stay.
    The stays are joined by their keys; Spark broadcasts them if they are small enough, and shuffles otherwise.
    """
    extra = [x for x in anchors.columns if x not in keys and x in events.columns]
    joined = events.join(anchors.drop(*extra) if anchor not in extra else anchors.select(*keys, c(anchor)), list(keys), how)
    return joined.withColumns({new: known_time(c(old), unknown) - c(anchor) for old, new in times.items()})


def first_stay(admissions: DataFrame, person: str, order: Sequence[str]) -> DataFrame:
    """Each person's first row by order, nulls last; ties fall to the next column, so name a unique one last.
    The least row is found by an aggregation, so a person with many rows is combined on the map side."""
    key = [F.struct(c(o).isNull().alias("n"), c(o).alias("v")).alias(f"o{i}") for i, o in enumerate(order)]
    least = F.min(F.struct(*key, F.struct(*[c(x) for x in admissions.columns]).alias("row")))
    return admissions.groupBy(c(person).alias("__p")).agg(least.alias("x")).select("x.row.*")


def synthetic_time(df: DataFrame, ms: str, base: Column, out: str) -> DataFrame:
    """Adds a time of day: ms after base, null where the time is unknown."""
    return df.withColumn(out, add_ms(base, known_time(c(ms))))


def catalogue(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Catalogues one under another, with missing columns empty and their name in `source`."""
    out = None
    for name, part in parts.items():
        part = part.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
