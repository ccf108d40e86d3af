"""Checks of whole tables: fingerprints, leakage, keys, density, one-hots, orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def fingerprint(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n_rows, h0, h1): a count and two sums of row hashes, the same whatever the rows' order.

    Hashes are of the values' text with the columns' places, so a null in one column isn't a null in
    another; columns should be numbers or texts.
    """
    text = F.concat_ws("|", *[F.concat(F.lit(f"{i}="), F.coalesce(c(x).cast("string"), F.lit("\\N"))) for i, x in enumerate(columns)])
    part = lambda seed: F.sum(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 12), 16, 10).cast("decimal(38,0)"))
    aggs = [F.count("*").alias("n_rows"), part(0).alias("h0"), part(1).alias("h1")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of keys with several rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def leaking(df: DataFrame, unit: str, split: str) -> DataFrame:
    """(unit, n_splits) of units in more than one split."""
    return df.groupBy(unit).agg(F.countDistinct(split).alias("n_splits")).filter("n_splits > 1")


def gaps_in_hours(grid: DataFrame, key: str, hour: str) -> DataFrame:
    """(key, n, last) of keys whose hours aren't 0, 1, ... without holes."""
    return grid.groupBy(key).agg(F.count("*").alias("n"), F.countDistinct(hour).alias("__d"), F.min(hour).alias("__lo"), F.max(hour).alias("last")).filter("n <> __d or __lo <> 0 or last <> n - 1").select(key, "n", "last")


def not_exclusive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of which not exactly one of the columns is 1."""
    total = sum((F.coalesce(c(x), F.lit(0)) for x in columns), F.lit(0))
    return df.filter(total != 1)


def out_of_order(df: DataFrame, group: Sequence[str], seq: str, time: str) -> DataFrame:
    """Rows whose time lies before that of the row before."""
    before = F.lag(time).over(Window.partitionBy(*group).orderBy(seq))
    return df.withColumn("__b", before).filter(c(time) < F.col("__b")).drop("__b")


def collisions(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Keys that occur in more than one of the tables."""
    out = None
    for i, p in enumerate(parts):
        one = p.select(key).distinct().withColumn("__i", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return out.groupBy(key).agg(F.count("*").alias("n_tables")).filter("n_tables > 1")
