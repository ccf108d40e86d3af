"""Joins with small tables that say what a code means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def fan_out(events: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each event once for every different row of the table with its keys; without one it goes."""
    return events.join(table.distinct(), list(keys))


def without(events: DataFrame, listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Events whose keys aren't listed."""
    return events.join(listed.select(*keys).distinct(), list(keys), "left_anti")


def only(events: DataFrame, listed: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Events whose keys are listed; all, if no list is given."""
    return events if listed is None else events.join(listed.select(*keys).distinct(), list(keys), "left_semi")


def relabelled(events: DataFrame, table: DataFrame, key: str, label: str, out: str) -> DataFrame:
    """Adds the table's label of each key, or the key itself where it has none."""
    return events.join(table.select(key, c(label).alias("__label")), key, "left").withColumn(out, F.coalesce("__label", c(key).cast("string"))).drop("__label")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join in which a null key matches a null key; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def accounted(events: DataFrame, vocabulary: DataFrame, keys: Sequence[str], emit: str, kept: Column) -> DataFrame:
    """What a join with a vocabulary would do, in one row: rows, matched, unmatched, not emitted, out of phase, left."""
    joined = events.withColumn("__kept", F.coalesce(kept, F.lit(False))).join(vocabulary.select(*keys, c(emit).alias("__emit")).withColumn("__there", F.lit(True)), list(keys), "left")
    there, emitted = F.col("__there").isNotNull(), F.coalesce("__emit", F.lit(False))
    return joined.agg(
        F.count("*").alias("n_rows"), F.count_if(there).alias("n_matched"), F.count_if(~there).alias("n_unmatched"), F.count_if(there & ~emitted).alias("n_not_emitted"),
        F.count_if(there & emitted & ~F.col("__kept")).alias("n_out_of_phase"), F.count_if(there & emitted & F.col("__kept")).alias("n_left"),
    )


def overwritten(state: DataFrame, changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """The state with the fields of `changes` (one row a key) in place of its own, where there is a change, null or not."""
    renamed = changes.select(c(key), *[c(f).alias(f"__{f}") for f in fields], F.lit(True).alias("__hit"))
    joined = state.join(renamed, key, "left")
    return joined.select(*[(F.when(F.col("__hit"), F.col(f"__{f}")).otherwise(c(f)).alias(f) if f in fields else c(f)) for f in state.columns])


def candidates(source: DataFrame, rules: Sequence[tuple[Mapping[str, str], DataFrame, str, int]], key: str) -> DataFrame:
    """Candidate targets of each source row by several rules (source column -> table column, table with
    `target`, method's name, specificity), one under another."""
    parts = []
    for columns, table, method, specificity in rules:
        renamed = table.select(*[c(r).alias(f"__{i}") for i, r in enumerate(columns.values())], "target").distinct()
        on = reduce(lambda a, b: a & b, [c(left) == F.col(f"__{i}") for i, left in enumerate(columns)])
        parts.append(source.join(renamed, on).select(key, "target", F.lit(method).alias("method"), F.lit(specificity).alias("specificity")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def compared(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A full outer comparison: keys, side (both, left_only, right_only) and for each value whether it differs."""
    a = left.select(*keys, *[c(v).alias(f"__a_{v}") for v in values], F.lit(True).alias("__a"))
    b = right.select(*keys, *[c(v).alias(f"__b_{v}") for v in values], F.lit(True).alias("__b"))
    side = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "left_only").otherwise("right_only")
    return a.join(b, list(keys), "full_outer").select(*keys, side.alias("side"), *[(~F.col(f"__a_{v}").eqNullSafe(F.col(f"__b_{v}"))).alias(f"{v}_differs") for v in values])


def paired_within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, before: int, after: int) -> DataFrame:
    """Per key the first left and the first right time, where the right one lies from `before` before the
    left one to `after` after it."""
    a = left.groupBy(key).agg(F.min(left_time).alias("first_left"))
    b = right.groupBy(key).agg(F.min(right_time).alias("first_right"))
    return a.join(b, key).filter((F.col("first_right") - F.col("first_left")).between(-before, after))


def any_pair_within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, before: int, after: int) -> DataFrame:
    """Keys with any left and right time so near: after each left time less `before` the next right time
    is looked up along the key's sorted times, so no pairs are made."""
    a = left.select(key, (c(left_time) - before).alias("__t"), F.lit(None).cast("long").alias("__u"))
    b = right.select(key, c(right_time).alias("__t"), c(right_time).cast("long").alias("__u"))
    # From the end backward, right times before left ones of the same place, so that the last seen is the next.
    w = Window.partitionBy(key).orderBy(F.desc("__t"), F.asc_nulls_last("__u")).rowsBetween(Window.unboundedPreceding, 0)
    met = a.unionByName(b).filter("__t is not null").withColumn("__next", F.last("__u", ignorenulls=True).over(w))
    return met.filter(F.col("__u").isNull() & (F.col("__next") <= F.col("__t") + before + after)).select(key).distinct()
