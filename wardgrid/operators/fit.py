"""Parameters fitted once on training rows and kept as tables, then applied to every split."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c, finite, quantile_bin, rank_share, sanitized, zscore
from wardgrid.operators.lookups import null_safe
from wardgrid.operators.quantiles import evenly, nearest_ranks, percentiles

#: Knots of a rank transform.
KNOTS = 1000


def fit_moments(train: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mean, std, n) of the finite values, std of the population."""
    return train.filter(finite(c(value))).groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count("*").alias("n"))


def scaled(df: DataFrame, moments: DataFrame, key: str, value: str, out: str, least: int = 10) -> DataFrame:
    """Adds the z-score by the key's moments; unscaled with fewer than `least` values or no fit."""
    joined = df.join(moments.select(key, "mean", "std", "n"), key, "left")
    return joined.withColumn(out, F.when(F.col("n").isNull(), c(value)).otherwise(zscore(c(value), F.col("mean"), F.col("std"), F.col("n"), least))).drop("mean", "std", "n")


def fit_ranks(train: DataFrame, key: str, value: str, knots: int = KNOTS) -> DataFrame:
    """(key, knots): evenly spaced quantiles of the positive values, linear between values."""
    return evenly(train.filter(finite(c(value)) & (c(value) > 0)), [key], value, knots).select(key, F.col("p").alias("knots"))


def ranked(df: DataFrame, ranks: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Adds the value's place among its key's knots, 0 to 1; 0 and less are 0, null stays null."""
    joined = df.join(ranks.select(key, "knots"), key, "left")
    return joined.withColumn(out, F.when(c(value).isNotNull() & F.col("knots").isNotNull(), rank_share(c(value), F.col("knots")))).drop("knots")


def fit_quantiles(train: DataFrame, keys: Sequence[str], value: str, bins: int = 10) -> DataFrame:
    """(keys, n, q1 ... q(bins-1)): nearest-rank quantiles of the finite values.

    Ranks are found by counts, so no task holds or sorts the values of a key.
    """
    found = nearest_ranks(train.filter(finite(c(value))), keys, value, bins)
    return found.select(*keys, "n", *[F.col("values")[i - 1].alias(f"q{i}") for i in range(1, bins)])


def coded(df: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str, out: str, bins: int = 10, how: str = "inner") -> DataFrame:
    """Adds the number of the bin by the fitted bounds; rows without bounds go, or have none if how is left
    (null keys match null keys)."""
    table = bounds.select(*keys, F.array(*[F.col(f"q{i}") for i in range(1, bins)]).alias("__q"))
    return null_safe(df, table, keys, how).withColumn(out, quantile_bin(c(value), F.col("__q"))).drop("__q")


def frequencies(df: DataFrame, keys: Sequence[str], ms: str) -> DataFrame:
    """(keys, frequency): 1 / the mean gap above 0 between a group's successive times."""
    gap = c(ms) - F.lag(ms).over(Window.partitionBy(*keys).orderBy(ms))
    return df.filter(c(ms).isNotNull()).withColumn("__gap", gap).filter("__gap > 0").groupBy(*keys).agg((F.lit(1.0) / F.avg("__gap")).alias("frequency"))


def confidence(df: DataFrame, key: str, value: str, z: float) -> DataFrame:
    """(key, n, mean, sd, low, high): a normal interval of the mean, from groups of two or more."""
    out = df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    half = F.lit(z) * F.col("sd") / F.sqrt(F.col("n"))
    return out.withColumns({"low": F.col("mean") - half, "high": F.col("mean") + half})


def dense_signals(df: DataFrame, group: str, signal: str, ms: str, gap_ms: int, z: float = 1.96, rare_groups: int = 2, rare_rows: int = 500_000) -> DataFrame:
    """Each signal's frequency interval over groups and whether it is dense: the whole interval above one
    reading in gap_ms, or with too few groups for an interval many rows at such a mean frequency."""
    freq = frequencies(df, [group, signal], ms)
    ci = confidence(freq, signal, "frequency", z)
    rows = df.groupBy(signal).agg(F.count("*").alias("n_rows"))
    bar = F.lit(1.0 / gap_ms)
    rare = (F.col("n") <= rare_groups) & (F.col("n_rows") >= rare_rows) & (F.col("mean") > bar)
    status = F.when(F.coalesce(F.col("low") > bar, F.lit(False)), "dense").when(F.coalesce(rare, F.lit(False)), "rare_dense").when(F.coalesce(F.col("high") < bar, F.lit(False)), "sparse").otherwise("unsettled")
    return rows.join(ci, signal, "left").withColumn("status", status).withColumn("is_dense", F.col("status").isin("dense", "rare_dense"))


def cohort_weights(n: Mapping[str, int]) -> dict[str, float]:
    """Each cohort's weight, the root of its size over the sum of the roots."""
    total = sum(math.sqrt(v) for v in n.values())
    return {k: math.sqrt(v) / total for k, v in n.items()} if total else {k: 0.0 for k in n}


def cohort_weight_table(sizes: DataFrame, size: str = "n") -> DataFrame:
    """sizes (a row a cohort) with `weight`, as cohort_weights; null sizes count as 0."""
    root = F.sqrt(F.coalesce(c(size).cast("double"), F.lit(0.0)))
    total = sizes.agg(F.sum(root)).first()[0] or 0.0
    return sizes.withColumn("weight", root / F.lit(total) if total else F.lit(0.0))


def pooled_moments(parts: DataFrame, key: str, weight: str) -> DataFrame:
    """(key, mean, std) pooled over cohorts' rows (key, mean, std, weight): variance within and between.
    Weights are taken relative to those of the cohorts that have the key."""
    share = F.sum(c(weight) * F.col("mean")) / F.sum(weight)
    second = F.sum(c(weight) * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / F.sum(weight)
    return parts.groupBy(key).agg(share.alias("mean"), second.alias("__s")).select(key, "mean", F.sqrt(F.greatest(F.col("__s") - F.col("mean") * F.col("mean"), F.lit(0.0))).alias("std"))


def pooled_percentiles(df: DataFrame, key: str, value: str, copies: str, at: Sequence[float]) -> DataFrame:
    """Percentiles in which each value counts `copies` times."""
    found = percentiles(df, [key], value, at, c(copies))
    return found.select(key, *[F.col("p")[i].alias(f"p{round(100 * q)}") for i, q in enumerate(at)])


def one_hot(df: DataFrame, column: str, categories: Sequence[str], prefix: str, missing: str = "missing") -> DataFrame:
    """One 0/1 column a category, and one for what is missing or unknown. Two categories whose names come
    out alike are an error."""
    names = [f"{prefix}_{sanitized(x)}" for x in categories] + [f"{prefix}_{missing}"]
    if len(set(names)) != len(names):
        raise ValueError(f"categories of {column} share a column name")
    known = F.coalesce(c(column).isin(list(categories)), F.lit(False))
    made = {n: F.coalesce(c(column) == x, F.lit(False)).cast("int") for n, x in zip(names, categories)}
    return df.withColumns(made | {names[-1]: (~known).cast("int")})
