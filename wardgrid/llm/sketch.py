"""Percentiles of very large numeric columns: counts in signed logarithmic buckets.

A sketch is a table (group..., bucket, n). Bucket k > 0 or k < 0 holds the values of that sign whose
size lies in (gamma^(|k| - OFFSET - 1), gamma^(|k| - OFFSET)], with gamma = (1 + error) / (1 - error);
bucket 0 holds zeros, and the outermost buckets the infinities. Sketches of days or partitions are
combined by adding counts of equal buckets, so any order of combination gives the same percentiles.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative error of a percentile's value, unless told otherwise.
ERROR = 0.005
#: Added to the size's exponent, so that every double but 0 has a bucket of its sign: with an error of
#: 1e-4 or more the exponents stay below it.
OFFSET = 4_000_000
INFINITE = 10_000_000


def _gamma(error: float) -> float:
    if not 1e-4 <= error < 1:
        raise ValueError("the relative error must be at least 0.0001 and below 1")
    return (1 + error) / (1 - error)


def bucket(value: Column, error: float = ERROR) -> Column:
    """The signed bucket of a number."""
    exponent = F.ceil(F.log(F.abs(value)) / F.lit(math.log(_gamma(error)))).cast("int") + F.lit(OFFSET)
    size = F.when(F.abs(value) == F.lit(float("inf")), F.lit(INFINITE)).otherwise(exponent)
    return F.when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size)


def bucket_value(b: Column, error: float = ERROR) -> Column:
    """The value that stands for a bucket: no value in it is further off than the error times its size."""
    gamma = _gamma(error)
    k = (F.abs(b) - F.lit(OFFSET)).cast("double")
    # Of the topmost bucket the plain middle would overflow: its lower end times a factor below gamma.
    size = F.when(F.abs(b) >= INFINITE, F.lit(float("inf"))).otherwise(F.pow(F.lit(gamma), k - 1) * F.lit(2 * gamma / (gamma + 1)))
    return F.when(b == 0, F.lit(0.0)).when(b > 0, size).otherwise(-size)


def sketch(df: DataFrame, groups: Sequence[str | Column], value: str, error: float = ERROR) -> DataFrame:
    """Counts by group and bucket (`bucket`, `n`), of values that are neither null nor NaN.

    Null groups are groups of their own; repeated rows count each; an empty table gives an empty
    sketch. Counting starts on the map side: a hot group shuffles at most one row a bucket and task.
    """
    cols = [F.col(f"`{g}`") if isinstance(g, str) else g for g in groups]
    rows = df.select(*cols, F.col(f"`{value}`").cast("double").alias("__v")).filter("__v is not null and not isnan(__v)")
    names = [c for c in rows.columns if c != "__v"]
    return rows.withColumn("bucket", bucket(F.col("__v"), error)).groupBy(*[F.col(f"`{c}`") for c in names], "bucket").agg(F.count("*").alias("n"))


def combine(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The sketches combined into those of coarser (or the same) groups."""
    return sketches.groupBy(*[F.col(f"`{g}`") for g in groups], "bucket").agg(F.sum("n").alias("n"))


def percentiles(sketches: DataFrame, groups: Sequence[str], at: dict[str, float], error: float = ERROR) -> DataFrame:
    """One row per group: n and, for each name in `at`, the value whose rank is floor(q * (n - 1)), lowest
    value first: off by at most `error` times its size (infinities and zeros exactly).

    sketches has one row a group and bucket (see combine). A group's buckets are at most 2 * OFFSET and
    in practice a few thousand; they are summed along the group in one sorted pass, never collected.
    """
    for q in at.values():
        if not 0 <= q <= 1:
            raise ValueError("a percentile's rank is between 0 and 1")
    keys = [F.col(f"`{g}`") for g in groups]
    along = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    rows = sketches.withColumns({"__upto": F.sum("n").over(along), "__all": F.sum("n").over(Window.partitionBy(*keys))})
    picks = [F.min(F.when(F.col("__upto") > F.floor(F.lit(q) * (F.col("__all") - 1)), F.col("bucket"))).alias(name) for name, q in at.items()]
    found = rows.groupBy(*keys).agg(F.max("__all").alias("n"), *picks)
    return found.select(*keys, "n", *[bucket_value(F.col(name), error).alias(name) for name in at])
