"""Corrections and filters of values by tables of rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import affine, c, fraction_to_percent, within
from wardgrid.operators.quantiles import percentiles


def bounded(df: DataFrame, bounds: DataFrame, key: str, value: str, low: str = "low", high: str = "high") -> DataFrame:
    """Rows whose value lies within their key's bounds, ends included; keys without bounds pass, even with a null."""
    table = bounds.select(key, c(low).cast("double").alias("__lo"), c(high).cast("double").alias("__hi"), F.lit(True).alias("__has"))
    joined = df.join(table, key, "left")
    return joined.filter(F.col("__has").isNull() | within(c(value), F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi", "__has")


def below_ceiling(df: DataFrame, ceilings: DataFrame, key: str, value: str, ceiling: str = "ceiling") -> DataFrame:
    """Rows with 0 <= value <= their key's ceiling; keys without one need only be at least 0."""
    joined = df.join(ceilings.select(key, c(ceiling).cast("double").alias("__c")), key, "left")
    return joined.filter((c(value) >= 0) & F.coalesce(c(value) <= F.col("__c"), F.lit(True))).drop("__c")


def longer_than(df: DataFrame, least: DataFrame, key: str, duration: str, minimum: str = "minimum") -> DataFrame:
    """Rows whose duration is above their key's minimum (0 without one)."""
    joined = df.join(least.select(key, c(minimum).alias("__m")), key, "left")
    return joined.filter(c(duration) > F.coalesce("__m", F.lit(0))).drop("__m")


def corrected(df: DataFrame, rules: DataFrame, key: str, value: str) -> DataFrame:
    """Values set right by one table of rules, a row a key: exclude (boolean), sentinel (a value that means
    nothing), percent (boolean: fractions are hundredths), a and b (affine; a alone is a factor), low and high.

    In this order: excluded keys go, sentinels go, fractions become percents, a * x + b, what lies outside
    the bounds goes. Any rule may be null; keys without rules pass unchanged.
    """
    names = ("exclude", "sentinel", "percent", "a", "b", "low", "high")
    joined = df.join(rules.select(key, *[c(n).alias(f"__{n}") for n in names]), key, "left")
    kept = joined.filter(~F.coalesce("__exclude", F.lit(False)) & ~F.coalesce(c(value) == F.col("__sentinel"), F.lit(False)))
    scaled = F.when(F.coalesce("__percent", F.lit(False)), fraction_to_percent(c(value))).otherwise(c(value))
    kept = kept.withColumn(value, affine(scaled, F.col("__a"), F.col("__b")))
    no_bounds = F.col("__low").isNull() & F.col("__high").isNull()
    return kept.filter(no_bounds | within(c(value), F.col("__low"), F.col("__high"))).drop(*[f"__{n}" for n in names])


def rated(df: DataFrame, rate: str, dose: str, minutes: str, formula: str, factor: str, out: str) -> DataFrame:
    """Adds a rate by the row's formula: raw, per_minute (dose / minutes), per_hour (that times 60) or
    milli_per_minute (that times 1000), times its factor; no time gives null."""
    per_minute = F.when(c(minutes) > 0, c(dose) / c(minutes))
    by = {"raw": c(rate), "per_minute": per_minute, "per_hour": per_minute * 60, "milli_per_minute": per_minute * 1000}
    value: Column = F.lit(None).cast("double")
    for name, expression in by.items():
        value = F.when(c(formula) == name, expression).otherwise(value)
    return df.withColumn(out, value * F.coalesce(c(factor), F.lit(1.0)))


def outlier_bounds(df: DataFrame, key: str, value: str, k: float = 3.0, mad_k: float = 3.5) -> DataFrame:
    """Per key: interquartile, median-deviation and percentile bounds (percentiles linear between values)."""
    q = percentiles(df, [key], value, (0.25, 0.5, 0.75, 0.01, 0.99)).withColumnRenamed("p", "__q")
    off = df.join(q.select(key, F.col("__q")[1].alias("__m")), key).withColumn("__off", F.abs(c(value) - F.col("__m")))
    dev = percentiles(off, [key], "__off", (0.5,)).select(key, F.col("p")[0].alias("__d"))
    iqr = F.col("__q")[2] - F.col("__q")[0]
    return q.join(dev, key).select(
        key, "n", (F.col("__q")[0] - k * iqr).alias("iqr_low"), (F.col("__q")[2] + k * iqr).alias("iqr_high"),
        (F.col("__q")[1] - mad_k * 1.4826 * F.col("__d")).alias("mad_low"), (F.col("__q")[1] + mad_k * 1.4826 * F.col("__d")).alias("mad_high"),
        F.col("__q")[3].alias("p01"), F.col("__q")[4].alias("p99"),
    )


def spiky_values(df: DataFrame, key: str, value: str, share: float = 0.05, least: int = 10) -> DataFrame:
    """Values that a suspicious share of a key's rows have: key, value, n, share."""
    per = df.filter(c(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    total = per.groupBy(key).agg(F.sum("n").alias("__all"))
    return per.join(total, key).withColumn("share", F.col("n") / F.col("__all")).filter((F.col("share") >= share) & (F.col("n") >= least)).drop("__all")


def profile(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Per key: rows, and of each value the missing share, mean and population skewness."""
    out = [F.count("*").alias("n_rows")]
    for v in values:
        out += [F.avg(F.col(v).isNull().cast("double")).alias(f"{v}_missing"), F.avg(v).alias(f"{v}_mean"), F.skewness(v).alias(f"{v}_skewness")]
    return df.groupBy(key).agg(*out)
